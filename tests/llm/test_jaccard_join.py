import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarnwork.llm import jaccard_join as jj
from tarnwork.llm.components import components

SPACE = " \t\n\x0b\x0c\r"


def shingle_set(text, size=5):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in SPACE:
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, percent=75):
    """Size and component of each row."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    names = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            names[root(i)] = min(names.get(root(i), doc_id), doc_id)
    return [(r[0], len(s), names.get(root(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets, strict=True))]


def corpus(seed, n=160, families=12):
    """Families of near copies whose distances straddle the bound, passages in common, copies, short and empty texts."""
    rng = random.Random(seed)
    word = lambda: "w" + str(rng.randrange(400))
    passage = [word() for _ in range(25)]
    bases, rows = [[word() for _ in range(rng.randint(5, 120))] for _ in range(families)], []
    for i in range(n):
        words = list(rng.choice(bases))
        kind = rng.random()
        if kind < 0.6:
            for _ in range(rng.randint(0, max(1, len(words) // 12))):
                words[rng.randrange(len(words))] = word()
            words = words[rng.randint(0, 3) : len(words) - rng.randint(0, 3)] or words
        elif kind < 0.8:
            words = [word() for _ in range(rng.randint(1, 40))]
            words[1:1] = passage
        elif kind < 0.9:
            words = [word() for _ in range(rng.randint(0, 7))]
        rows.append((1000 - i, rng.choice(SPACE).join(words).upper() if i % 5 == 0 else " ".join(words)))
    return rows


def found(df):
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    return sorted((tuple(r) for r in df.collect()), key=key)


def same(df, rows):
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert found(df) == sorted(brute(rows), key=key)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(frame, seed):
    rows = corpus(seed)
    same(jj.near_duplicates(frame(rows, "doc_id long, text string")), rows)


def test_a_chain_and_two_near_families(frame):
    # Members drift by one word each, so far ends are joined by steps only; the second family lies just beyond the bound.
    base = [f"b{i}" for i in range(60)]
    chain = [(i, " ".join(f"x{k}" if k < i else w for k, w in enumerate(base))) for i in range(30)]
    other = [(100 + i, " ".join(base[:44] + [f"o{k}" for k in range(16)] + [f"e{i}"])) for i in range(20)]
    rows = chain + other
    same(jj.near_duplicates(frame(rows, "doc_id long, text string")), rows)


def test_odd_rows(frame):
    copies = "one two three four five six"
    rows = [(1, None), (2, ""), (3, " \n"), (4, "Short Text"), (5, "short\ttext"), (6, "short text too"), (7, copies), (7, copies), (7, "another text under the same id here"), (8, copies.upper()), (None, copies), (None, "nobody knows this one at all"),
            (None, "nobody knows this one at all"), (9, "é É ü Ü ß"), (10, "é é ü ü ß"), (11, "a b c d e"), (12, "a b c d e a b c d e"), (13, "long " * 50_000), (14, "long long long long long")]
    df = frame([(*r, 3, "z") for r in rows], "doc_id long, text string, n long, cid string")
    same(jj.near_duplicates(df), rows)
    assert jj.near_duplicates(frame([], "doc_id long, text string")).collect() == []
    assert found(jj.near_duplicates(frame([(1, None)], "doc_id long, text string"))) == [(1, 0, 1)]


def test_frequent_shingles_change_no_result(frame):
    rows = corpus(7, 120, 4)
    df = frame(rows, "doc_id long, text string")
    for most in (0,):
        same(jj.near_duplicates(df, jj.Rule(common_most=most, common_from=2)), rows)


def test_first_shingles_meet_every_linked_set():
    rule = jj.Rule()
    for n in range(1, 60):
        for m in range(n, 80):
            least = -(-rule.percent * (n + m) // (100 + rule.percent))  # least intersection of linked sets
            if least <= n:
                assert rule.first(n) >= n - least + 1 and rule.first(m) >= m - least + 1


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, i) for i in range(5001, 5050)]
    labels = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    low = {}
    for a, b in edges:
        if a != b:
            low.setdefault(a, a), low.setdefault(b, b)
    for _ in range(len(low)):
        for a, b in edges:
            if a != b:
                low[a] = low[b] = min(low[a], low[b])
    assert labels == low


def test_all_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    result = jj.op5_jaccard_join(spark, sf_dir)
    same(result, rows)
    assert result.where(F.col("component_id") != F.col("doc_id")).count() > 0


def test_sketches_never_hide_a_link(frame):
    rng, rows, wanted = np.random.default_rng(5), [], {}
    for k in range(60):
        size = int(rng.integers(1, 3000))
        base = rng.integers(0, 1 << 62, size).astype(np.uint64)
        other = np.concatenate([base[: int(size * rng.uniform(0.3, 1))], rng.integers(0, 1 << 62, int(size * rng.uniform(0, 0.7))).astype(np.uint64)])
        sets = [np.unique(x) for x in (base, other)]
        common = len(np.intersect1d(*sets))
        wanted[2 * k, 2 * k + 1] = 1 - common / (len(sets[0]) + len(sets[1]) - common)
        rows += [(2 * k + i, len(x), jj.sketch(x)) for i, x in enumerate(sets)]
    classes = frame(rows, "cid long, n long, sketch array<long>")
    for reach in (0.25, 0.5):
        pairs = frame([(a, b, reach) for a, b in wanted], "a long, b long, reach double")
        kept = {(r.a, r.b) for r in jj.within(pairs, classes).collect()}
        assert {p for p, d in wanted.items() if d <= reach} <= kept
        assert len(kept) < 0.8 * len(wanted)


def test_regions_find_all_that_can_link():
    rng, rule = np.random.default_rng(8), jj.Rule()
    base = rng.integers(0, 1 << 62, 150).astype(np.uint64)
    sets = []
    for _ in range(700):
        kept = base[rng.random(150) < rng.uniform(0.6, 1)]
        sets.append(np.unique(np.concatenate([kept, rng.integers(0, 1 << 62, int(rng.integers(0, 40))).astype(np.uint64)])))
    sets += [np.unique(rng.integers(0, 1 << 62, 120).astype(np.uint64)) for _ in range(300)]
    sketches = np.array([(jj.sketch(x) + [0] * 16)[:16] for x in sets]).view(np.uint64)
    sizes, parts = np.array([len(x) for x in sets]), np.arange(len(sets)) // 2
    pairs = {(i, j) for leaf in (40,) for i, j in jj.Regions(sizes, parts, np.full(len(sets), 3), sketches, rule, leaf, 5).join(np.arange(len(sets)))}
    pairs = {tuple(sorted(p)) for p in pairs}
    linked = set()
    for i, x in enumerate(sets):
        for j in range(i):
            common = len(np.intersect1d(x, sets[j], assume_unique=True))
            if parts[i] != parts[j] and 100 * common >= rule.percent * (len(x) + len(sets[j]) - common):
                linked.add((j, i))
    assert linked and linked <= pairs and len(pairs) < 500 * 999


@pytest.mark.parametrize("few, block", [(0, 4)])
def test_blocks_and_rows_find_the_same(frame, few, block):
    rows = corpus(11, 90, 3)
    same(jj.near_duplicates(frame(rows, "doc_id long, text string"), jj.Rule(few=few, block=block)), rows)


class Workers:
    """Stands for a frame: gives what its workers would run."""

    def mapInArrow(self, run, schema):
        return run


def text_batches(texts, rows):
    for low in range(0, len(texts), rows):
        some = texts[low : low + rows]
        yield pa.RecordBatch.from_arrays([pa.array(range(low, low + len(some)), pa.int64()), pa.array(some, pa.string())], ["doc_id", "text"])


@pytest.mark.parametrize("counted", [1, 100, 1 << 21])
def test_repeated_shingles_are_counted_once_for_each_set(monkeypatch, counted):
    monkeypatch.setattr(jj, "COUNTED", counted)
    r = random.Random(3)
    texts = [" ".join(r.choices("abc", k=r.randint(0, 30))) for _ in range(60)] + [None, "", "a b c a b c a"] * 2
    out = [row for b in jj.describe(Workers(), jj.Rule())(text_batches(texts, 7)) for row in b.to_pylist()]
    assert [r["doc_id"] for r in out] == list(range(len(texts)))
    wanted, sets = Counter(), {}

    def flush():
        wanted.update({k: n for k, n in Counter(x for own in sets.values() for x in own.tolist()).items() if n > 1})
        sets.clear()

    for text in texts:
        own = jj.shingles(text, 5)
        sets[jj.identity(own)] = own
        if sum(map(len, sets.values())) >= counted:
            flush()
    flush()
    found = Counter()
    for row in out:
        for shingle, n in np.frombuffer(row["heavy"] or b"", np.uint64).reshape(-1, 2).tolist():
            found[shingle] += n
    assert found == wanted


def test_a_worker_holds_its_shingles_about_twice():
    texts = [" ".join(f"w{i}x{j}" for j in range(404)) for i in range(3000)]
    batches = list(text_batches(texts, 3000))
    tracemalloc.start()
    list(jj.describe(Workers(), jj.Rule())(iter(batches)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3.2 * 8 * 400 * 3000  # sketches and rows included; 6.7 times before, 2.5 now


def test_python_steps_get_few_rows_at_a_time(spark, frame, monkeypatch):
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    settle = jj.settle

    def settled(df, label):
        seen.append(int(spark.conf.get(key)))
        return settle(df, label)

    monkeypatch.setattr(jj, "settle", settled)
    before = spark.conf.get(key)
    jj.near_duplicates(frame([(1, "a b c d e f"), (2, "a b c d e f g")], "doc_id long, text string")).collect()
    assert max(seen) <= 1000 and spark.conf.get(key) == before


def test_each_range_of_shingles_is_a_task_of_its_own(frame):
    docs = frame([(1, "a b c d e f"), (2, "a b c d e f g")], "doc_id long, text string")
    near = jj.neighbourhoods(docs, jj.Rule(), np.zeros(0, np.uint64), 12)
    assert "direct_shuffle_partition_id(bucket" in near._jdf.queryExecution().analyzed().toString()
    assert near.count() == 2
