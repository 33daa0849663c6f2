import zlib

import numpy as np
import pytest

from tarnwork.llm import langid

WORDS = {"en": "the of and with there house water".split(), "fr": "le la des eau être maison où".split(), "de": "der die und Haus Wasser über ßig".split()}


def labelled(n=240):
    names = list(WORDS)
    rng = np.random.default_rng(1)
    return [(i, " ".join(rng.choice(WORDS[names[i % 3]], 12)), names[i % 3]) for i in range(n)]


def test_codewords_differ():
    for classes in (1, 2, 4, 7, 8, 40):
        book = langid.codebook(classes)
        assert len(book) == classes and set(np.unique(book)) <= {-1.0, 1.0}
        if classes > 2:
            distances = [(book[i] != book[j]).sum() for i in range(classes) for j in range(i)]
            assert min(distances) >= 2
    assert (langid.codebook(4)[:, None] != langid.codebook(4)[None]).sum(2)[~np.eye(4, dtype=bool)].tolist() == [4] * 12


def test_one_wrong_bit_is_corrected():
    codes = langid.codebook(4)
    model = langid.Model(list("abcd"), codes, np.eye(7, dtype=np.float32), np.zeros(7, np.float32), np.full((4, 7), 1 / 7, np.float32))
    for c in range(4):
        for bit in range(7):
            sent = codes[c] * 3
            sent[bit] *= -1
            assert model.losses(sent[None])[0].argmin() == c


def test_features_use_the_whole_text():
    assert np.linalg.norm(langid.features("x" * 100_000 + " ü")) == pytest.approx(1)
    assert not np.array_equal(langid.features("a" * 99_999), langid.features("a" * 99_999 + " ü"))
    assert np.array_equal(langid.features("The 12 HOUSE!"), langid.features("the house"))


def test_odd_rows_and_clashing_names(frame):
    odd = [(1000, None, "en"), (1001, "", None), (1002, "123 !!", "fr"), (None, "der Haus und die", None), (None, "der Haus und die", None), (1003, "le la " * 20_000, None)]
    rows = [(*r, "s", 1.0, "z") for r in labelled() + odd]
    df = frame(rows, "doc_id long, text string, lang string, source string, score double, lang_pred string")
    found = {(r.doc_id, r.held_out): r for r in langid.identify_documents(df).collect()}
    by_id = {k[0]: r for k, r in found.items()}
    assert [by_id[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and by_id[1000].score == 0.0
    assert by_id[None].lang_pred == "de" and by_id[1003].lang_pred == "fr"
    assert all(0 <= r.score <= 1 for r in by_id.values())
    assert {i: r.held_out for i, r in by_id.items() if i is not None} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in by_id if i is not None}


def test_without_labels_nothing_is_known(frame):
    schema = "doc_id long, text string, lang string"
    assert langid.identify_documents(frame([], schema)).collect() == []
    assert [r.lang_pred for r in langid.identify_documents(frame([(1, "text", None)], schema)).collect()] == ["und"]
    one = langid.identify_documents(frame([(1, "text", "en"), (3, "more", None)], schema)).collect()
    assert [(r.lang_pred, r.score, r.ambiguous) for r in one] == [("en", 1.0, False)] * 2


def test_held_out_accuracy(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = langid.op7_language_id(spark, sf_dir)
    rows = found.join(documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 30 and sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert found.count() == documents.count()


def test_labels_of_held_out_rows_are_not_used(frame):
    rows = labelled()
    wrong = [(i, t, "en" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    schema = "doc_id long, text string, lang string"
    answers = [sorted((r.doc_id, r.lang_pred, r.score) for r in langid.identify_documents(frame(x, schema)).collect()) for x in (rows, wrong)]
    assert answers[0] == answers[1]


def test_copies_take_no_place_in_the_sample(frame):
    rows = [(t, lang) for _, t, lang in labelled()] + [("le la des eau", "fr")] * 50_000 + [("water of the house", "en")] * 50_000
    seen = {}
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(langid, "fit", lambda texts, langs: seen.update(zip(texts, langs, strict=True)))
        langid.train(frame(rows, "text string, lang string"))
    assert seen == dict(rows)


def test_every_language_is_learned(frame):
    rows = [(f"{a}{b} {b}{a}{a}", f"{a}{b}") for a in "abcdefghijkl" for b in "mnopqrstuvw"] + [(". " * 30_000 + "über " * 30_000, "long")]
    seen = {}
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(langid, "fit", lambda texts, langs: seen.update(zip(langs, texts, strict=True)))
        langid.train(frame(rows * 2, "text string, lang string"))
    assert len(rows) == 133 and set(seen) == {lang for _, lang in rows} and seen["long"] == "über " * 10_000


def test_texts_without_letters_are_undetermined(frame):
    texts = ["½ ²", "5 ①", "Ⅷ", "٣ _ 12", "ª", "日"]
    rows = [(10_000 + i, t, None) for i, t in enumerate(texts)]
    found = {r.doc_id: r.lang_pred for r in langid.identify_documents(frame(labelled() + rows, "doc_id long, text string, lang string")).collect()}
    assert [found[i] == "und" for i, _, _ in rows] == [True, True, True, True, False, False]


def test_decoding_against_plain_loops():
    rng = np.random.default_rng(9)
    codes = langid.codebook(5)
    width = codes.shape[1]
    trust = rng.random((5, width)).astype(np.float32)
    model = langid.Model(list("abcde"), codes, rng.normal(size=(langid.DIMENSIONS, width)).astype(np.float32), rng.normal(size=width).astype(np.float32), trust)
    texts = ["the house of water", "über ßig", "a", "x y z " * 50]
    found = model.losses(np.stack([langid.features(t) for t in texts]))
    for t, losses in zip(texts, found, strict=True):
        raw = b" " + b" ".join(t.lower().encode().translate(langid.SPACED).split()) + b" "
        counts = np.zeros(langid.DIMENSIONS)
        for n, factor in langid.MIX.items():
            for i in range(len(raw) - n + 1):
                counts[((int.from_bytes(raw[i : i + n], "big") * factor) & 0xFFFFFFFF) >> int(langid.SHIFT)] += 1
        x = np.sqrt(counts) / np.sqrt(counts.sum())
        for c in range(5):
            loss = sum(float(trust[c, j]) * np.log1p(np.exp(-float(codes[c, j]) * (x @ model.weights[:, j] + model.bias[j]))) for j in range(width))
            assert losses[c] == pytest.approx(loss, rel=1e-3)


def test_few_whole_texts_are_sent_at_a_time(spark, frame):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for rows, wanted in (("10000", "1000"), ("500", "500")):
            spark.conf.set(key, rows)
            langid.identify_documents(frame(labelled(30), "doc_id long, text string, lang string"))
            assert spark.conf.get(key) == wanted
    finally:
        spark.conf.set(key, before)
