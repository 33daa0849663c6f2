import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tarnwork.llm import packing
from tarnwork.llm.packing import Shard, WordTokens, op11_packing, packed_sequences, powers_of_two

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
TRICKY = [
    "It's the THE, the. (the), 12.5 a1b2,, x$$$, y)., <|endoftext|> z", "", "<|ENDOFTEXT|>", "á, Á. é. K, ＡＢ，foo．bar  İI ß ſ Σς, ΣΑΣ", "foo'sbar, foo's. 's' 'S",
    "a" * 3000 + ".", "日本語、テスト。 the.The a\x1cb\x85c", "\x00 <| foo |>", "e̸, ≠ x≠.", " \t\n", "ª º ǅ, ʰ. ͅ",
]


@pytest.fixture(scope="module")
def tokens():
    return WordTokens(PATH)


def ids_of(tokens, text):
    return tokens.tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_ids_are_the_tokenizers(tokens):
    r = random.Random(1)
    letters = "aAbZé'’s.,;!?()<|>= \n\t̸́  日本０9²İſΣ\U0001f600$&#\x1f\x85"
    texts = TRICKY + ["".join(r.choices(letters, k=r.randint(0, 40))) for _ in range(2000)]
    for _ in range(2):  # once learning the words, once knowing them
        ids, starts = tokens.encode([t.encode() for t in texts], 1)
        assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:], strict=False)] == [ids_of(tokens, t) for t in texts]


def test_ids_after_the_words_were_forgotten(tokens, monkeypatch):
    monkeypatch.setattr(packing, "KEPT_WORDS", 3)
    for text in ["one two three four.", "two five, six", "five one"]:
        ids, _ = tokens.encode([text.encode()], 1)
        assert ids.tolist() == ids_of(tokens, text)


def test_rare_words_are_forgotten_first(monkeypatch):
    own = WordTokens(PATH)
    monkeypatch.setattr(packing, "KEPT_WORDS", 40)
    for i in range(60):
        text = "often more often " * 3 + f"rare{i} word{i},"
        ids, _ = own.encode([text.encode()], 1)
        assert ids.tolist() == ids_of(own, text)
    assert b"often" in own.number and len(own.number) < 60


def test_marks_make_no_new_words_and_copies_are_asked_for_once(monkeypatch):
    own, asked = WordTokens(PATH), []
    numbers = own.numbers
    monkeypatch.setattr(own, "numbers", lambda names: asked.extend(names) or numbers(names))
    text = "House, house. THE house,\n" * 50 + "'s x2. house"
    ids, starts = own.encode([text.encode(), b"", text.encode()], 1)
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:], strict=False)] == [ids_of(own, t) for t in (text, "", text)]
    assert len(asked) == len(set(asked)) and set(asked) - {b""} == {b"house", b"the", b"'s", b"x2.", b",", b"."}
    assert set(own.number) == set(asked)


def checked(tokens, rows, df, window):
    """Every id of every row lies in one piece, sequences are gapless, at most ``window`` long, and full or a power of two."""
    pieces = df.collect()
    wanted = Counter((doc_id, tuple(ids_of(tokens, text))) for doc_id, text in rows)
    parts, sequences = {}, {}
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(ids) == p["length"] > 0
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        parts.setdefault(p["doc_id"], []).append((p["start"], ids, p["doc_tokens"]))
    for cut in sequences.values():
        at = 0
        for offset, length in sorted(cut):
            assert offset == at
            at += length
        assert at == window or at < window and at & (at - 1) == 0
    if len(wanted) == len({d for d, _ in wanted}) == len(rows):
        for (doc_id, ids), _ in wanted.items():
            own = sorted(parts.pop(doc_id))
            assert [i for _, part, _ in own for i in part] == list(ids)
            assert [s for s, *_ in own] == np.cumsum([0] + [len(x) for _, x, _ in own])[:-1].tolist() and {n for *_, n in own} == {len(ids)}
        assert not parts
    assert Counter(i for own in parts.values() for _, ids, _ in own for i in ids) == (Counter(i for (_, ids), n in wanted.items() for i in ids for _ in range(n)) if parts else Counter())
    return sequences


@pytest.mark.parametrize("shard_tokens", [200, 1 << 19])
def test_all_ids_once(frame, tokens, shard_tokens):
    r = random.Random(shard_tokens)
    vocabulary = [f"word{i}" for i in range(80)]
    rows = [(i, " ".join(r.choices(vocabulary, k=r.choice([0, 1, 5, 30, 200])))) for i in range(150)] + [(i + 1000, t) for i, t in enumerate(TRICKY)] + [(None, None), (5000, "same words " * 3000)]
    df = frame([(*x, "x", 1) for x in rows], "doc_id long, text string, ids string, tokens int")
    checked(tokens, rows, packed_sequences(df, PATH, window=64, shard_tokens=shard_tokens), 64)


def test_repeated_rows_and_ids(frame, tokens):
    rows = [(1, "a b c d e f g")] * 50 + [(None, "a b c")] * 50 + [(2, None)] * 40 + [(2, "")] * 3
    checked(tokens, rows, packed_sequences(frame(rows, "doc_id long, text string"), PATH, window=32), 32)


def test_text_ids_and_empty_tables(frame, tokens):
    rows = [("a", "x y z"), ("b", "")]
    checked(tokens, rows, packed_sequences(frame(rows, "doc_id string, text string"), PATH), 2048)
    assert packed_sequences(frame([], "doc_id long, text string"), PATH).collect() == []


def test_neighbours_against_plain_bm25():
    r = np.random.default_rng(3)
    texts = [r.integers(0, 50, r.integers(1, 60)).astype("<u2") for _ in range(40)]
    idf = r.random(50).astype(np.float32)
    shard = Shard(texts, idf, 25.0)
    for seed in range(40):
        scores = []
        for t in texts:
            score = 0.0
            for term in set(texts[seed].tolist()):
                tf = int((t == term).sum())
                score += float(idf[term]) * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(t) / 25.0))
            scores.append(score)
        found = shard.neighbours(seed)
        assert sorted(found) == list(range(40))
        assert np.allclose(np.array(scores)[found], sorted(scores, reverse=True), rtol=1e-4)


def test_like_texts_share_windows():
    """Two subjects, mixed: each window holds one of them."""
    r = np.random.default_rng(5)
    texts = [r.integers(0, 100, 32) + 100 * (i % 2) for i in range(64)]
    for pieces in Shard(texts, np.ones(200, np.float32), 32.0).windows(128):
        assert len({text % 2 for text, *_ in pieces}) == 1


def test_last_window_is_cut_at_powers_of_two():
    pieces = [("a", 3, np.arange(5)), ("b", 0, np.arange(9))]
    cut = list(powers_of_two(pieces, 14))
    assert [[(t, s, len(x)) for t, s, x in c] for c in cut] == [[("a", 3, 5), ("b", 0, 3)], [("b", 3, 4)], [("b", 7, 2)]]


def test_whole_table(spark, sf_dir, tokens):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    wanted = {d.doc_id: ids_of(tokens, d.text) for d in documents}
    rows = op11_packing(spark, sf_dir).collect()
    sequences = {}
    for x in rows:
        ids = wanted[x.doc_id][x.start : x.start + x.length]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == x.ids_crc32 and x.doc_tokens == len(wanted[x.doc_id])
        sequences.setdefault(x.sequence_id, []).append((x.offset, x.length))
    assert sum(x.length for x in rows) == sum(map(len, wanted.values()))
    assert all((n := sum(k for _, k in s)) == 2048 or n & (n - 1) == 0 for s in sequences.values())
    assert all(sorted(s)[0][0] == 0 and all(a + k == b for (a, k), (b, _) in zip(sorted(s), sorted(s)[1:], strict=False)) for s in sequences.values())
