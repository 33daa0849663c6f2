import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwork.llm import fingerprints as fp


def jaccard(a, b):
    x, y = Counter(a.lower().split()), Counter(b.lower().split())
    words = set(x) | set(y)
    return sum(min(x[w], y[w]) for w in words) / sum(max(x[w], y[w]) for w in words) if words else 1.0


def test_quantiles_are_of_the_gamma_distribution():
    q = fp.gamma_quantiles()
    assert (np.diff(q) > 0).all() and q.mean() == pytest.approx(2, rel=0.01) and q.var() == pytest.approx(2, rel=0.03)


def test_agreement_is_generalised_jaccard(frame):
    rng, rows = random.Random(1), []
    for pair in range(40):
        vocabulary = [f"w{pair}_{i}" for i in range(rng.randint(2, 40))]
        left = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
        right = rng.sample(left, rng.randint(1, len(left))) + [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        rows.append((pair, " ".join(left), " ".join(right)))
    df = frame(rows, "k long, a string, b string")
    lanes = 512
    signed = [fp.signatures(df.select("k", fp.words(F.col(c)).alias("hashes")), ["k"], lanes=lanes).withColumnRenamed("lanes", c) for c in "ab"]
    found = {r.k: r.x for r in signed[0].join(signed[1], "k").select("k", fp.likeness(F.col("a"), F.col("b")).alias("x")).collect()}
    off = [found[k] - jaccard(a, b) for k, a, b in rows]
    assert max(map(abs, off)) < 4.5 * (0.25 / lanes) ** 0.5 and abs(np.mean(off)) < 0.01


def edited(rows):
    """doc_id, n_chars, digest of the edited text, next text; in order."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        k = len(text) // 3
        whole = text[: len(text) - k] + following[:k]
        out.append((doc_id, len(text), hashlib.sha256(whole.encode()).hexdigest(), text, whole, following))
    return out


def compare(found, rows, lanes):
    wanted = edited(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found), key=key) == sorted((w[:3] for w in wanted), key=key)
    by_key = {(r.doc_id, r.edited_sha256): r for r in found}
    far = []
    for doc_id, _, sha, text, whole, following in wanted:
        r = by_key[doc_id, sha]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        far += [r.near_edited - jaccard(text, whole), r.near_next - jaccard(text, following)]
    assert max(map(abs, far)) < 5 * (0.25 / lanes) ** 0.5 and (len(far) < 100 or abs(np.mean(far)) < 0.03)
    prints = {}
    for doc_id, _, sha, text, *_ in wanted:
        prints.setdefault(" ".join(text.lower().split()), set()).add(by_key[doc_id, sha].fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def test_odd_rows_and_slices(frame):
    rng = random.Random(2)
    rows = [(i * 7 % 401, " ".join(rng.choice("äb cd Ef gh 😀 kl".split()) for _ in range(rng.randint(0, 30)))) for i in range(401)]
    rows += [(None, "a b c"), (None, None), (500, None), (500, "x y z"), (500, "x y z"), (-3, " \n "), (-9, "long " * 20_000)]
    df = frame([(*r, 1, "z") for r in rows], "doc_id long, text string, slice int, id string")
    compare(fp.fingerprints(df, lanes=64).collect(), rows, 64)


@pytest.mark.parametrize("rows", [[], [(4, "one two three four")], [(None, "a"), (None, "b")], [(1, None), (2, "")]])
def test_few_rows(frame, rows):
    found = fp.fingerprints(frame(rows, "doc_id long, text string"), lanes=64).collect()
    assert len(found) == len(rows)
    if rows:
        compare(found, rows, 64)


def test_all_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    compare(fp.op8_fingerprints(spark, sf_dir).collect(), rows, 32)


def test_texts_are_shuffled_once(spark, sf_dir):
    plan = fp.op8_fingerprints(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan
