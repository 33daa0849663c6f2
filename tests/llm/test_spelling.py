import random
import re
import zlib
from collections import Counter

import pytest

from tarnwork.llm.spelling import Acceptors, op13_spelling_variants, spelling_variants, word_counts


def counted(rows, least=7):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                counts[run] += 1
    return counts


def brute(counts, times=10):
    """Near words by looking up every word at one edit, among the letters that occur."""
    letters = sorted({c for w in counts for c in w})
    out = {}
    for w, n in counts.items():
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))}
        edits |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters} | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        near = [x for x in edits - {w} if x in counts]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        form = best if best is not None and counts[best] >= times * n else None
        out[w] = [w, form, w, n, len(near), counts[form] if form else None]
    for row in out.values():
        while out[row[2]][1]:
            row[2] = out[row[2]][1]
    return sorted(map(tuple, out.values()), key=lambda r: r[0])


def found(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=lambda r: r[0])


def test_acceptor_shares_suffixes_and_finds_pairs():
    machine = Acceptors()
    root = machine.accept(sorted(["tapping", "topping", "tipping", "ripping"]))
    assert sorted(machine.common(root, root)) == ["ripping", "tapping", "tipping", "topping"]
    assert len(machine.arcs) < len("tapping") + 3
    assert sorted(machine.replaced(root)) == [("ripping", "tipping"), ("tapping", "tipping"), ("tapping", "topping"), ("tipping", "topping")]


@pytest.mark.parametrize("alphabet,seed,most", [("ab", 1, 2_000), ("abcé", 2, 3), ("aþÿ", 3, 12)])
def test_against_brute_force(frame, alphabet, seed, most):
    r = random.Random(seed)
    counts = {"".join(r.choices(alphabet, k=r.randint(1, 9))): r.choice([2, 3, 20, 25, 250, 2500]) for _ in range(400)}
    df = frame([(w, n, None) for w, n in counts.items()], "word string, n long, m string")
    assert found(spelling_variants(df, most=most)) == brute(counts)


def test_a_chain_of_forms_has_one_root(frame):
    counts = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "zzzzzzz": 5}
    assert found(spelling_variants(frame(list(counts.items()), "word string, n long"))) == brute(counts)


def test_ties_go_to_the_smallest(frame):
    counts = {"abcdefg": 2, "abcdefz": 20, "abcdefy": 20, "abcdef": 20}
    rows = dict((r[0], r[1]) for r in found(spelling_variants(frame(list(counts.items()), "word string, n long"))))
    assert rows["abcdefg"] == "abcdef"


ROWS = [
    (1, "Straße straße Führung führung führun"),
    (None, "Straßen, NULL-id straßen"),
    (2, None),
    (3, ""),
    (4, "x" * 30_000 + " " + "x" * 29_999),
    (4, "x" * 30_000 + " " + "x" * 29_999),
    (5, "ÄÖÜäöüß ÄÖÜäöüß İstanbul istanbul_istanbul \U0001d41aistanbul"),
] + [(i, "conventions convention conventional") for i in range(6, 80)]


def test_counts_and_long_words_against_brute_force(frame):
    df = frame([(*r, "x", 1) for r in ROWS], "doc_id long, text string, word string, n int")
    counts = counted(ROWS)
    words = word_counts(df)
    assert {r.word: r.n for r in words.collect()} == counts
    kept = {w: n for w, n in counts.items() if n >= 2}
    short = {w: n for w, n in kept.items() if len(w) < 100}
    rows = {r[0]: r for r in found(spelling_variants(words.where("n >= 2")))}
    assert [rows[w] for w in sorted(short)] == brute(short)
    assert {r[4] for w, r in rows.items() if len(w) > 100} <= {0, 1}


def test_empty_table(frame):
    assert found(spelling_variants(word_counts(frame([], "doc_id long, text string")))) == []


def test_refuses_forms_that_could_lead_in_a_circle(frame):
    with pytest.raises(ValueError):
        spelling_variants(frame([], "word string, n long"), times=1)


def test_whole_table_against_brute_force(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    counts = {w: n for w, n in counted(map(tuple, documents)).items() if n >= 2}
    assert found(op13_spelling_variants(spark, sf_dir)) == brute(counts)
