import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tarnwork.llm.decontam import TOKEN
from .test_decontam import brute as brute_leaks
from .test_jaccard_join import brute as brute_groups
from .test_mixing import brute_targets
from .test_sharding import brute as brute_shards

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"en": "the of and with there house water from this".split(), "fr": "le la des eau être maison où dans une".split(), "de": "der die und Haus Wasser über ßig nicht ein".split()}


def corpus():
    rng, rows = random.Random(4), []
    for i in range(240):
        lang = rng.choice(list(WORDS))
        words = [rng.choice(WORDS[lang]) + rng.choice(["", "", "s", "t"]) for _ in range(rng.randint(30, 90))]
        if i % 6 == 5:
            copied = rows[rng.randrange(len(rows))]
            lang, text = copied[2], copied[1].split() + ["end"]
            words = text if i % 12 == 5 else [w.upper() for w in text]
        if i % 10 == 9:
            words[3:3] = ITEMS[i % 3].split()
        rows.append((i, " ".join(words), lang, f"s{rng.choice([0, 0, 0, 1, 2, 3])}"))
    rows += [(900, None, "en", "s0"), (901, "", "en", "s1"), (902, "123 456 !!", "en", None), (903, " ".join(WORDS["en"] * 4), None, None)]
    return [(*r, len(r[1] or "")) for r in rows]


ITEMS = ["which river runs past seven old towns before it meets the northern sea", "name three metals that stay liquid under a pressure of ten bars", "how many moons of that planet were known when the century began"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after each stage over a small corpus."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(corpus(), SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(ITEMS)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), [corpus()]
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append([tuple(r) for r in docs.collect()])
        if name != "sharding":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(map(tuple, pipeline.run(spark, folder).collect())) == sorted(out[-1])
    return out


def test_order():
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "jaccard_join", "decontamination", "mixing", "sharding"]


def test_language_stage_drops_what_has_none(stages):
    assert {r[0] for r in stages[0]} - {r[0] for r in stages[1]} == {900, 901, 902}


def test_one_of_each_group_stays(stages):
    groups = brute_groups([r[:2] for r in stages[1]])
    assert sorted(r[0] for r in stages[2]) == sorted({g for _, _, g in groups}) and len(stages[2]) < len(stages[1])


def test_no_leak_stays_and_nothing_else_goes(stages):
    leaking = {d for d, _ in brute_leaks([r[:2] for r in stages[2]], list(enumerate(ITEMS)))}
    assert leaking and {r[0] for r in stages[3]} == {r[0] for r in stages[2]} - leaking


def test_mix_follows_the_weights(stages):
    before, after, size = {}, {}, {r[0]: len(r[1].split()) for r in stages[3]}
    for r in stages[3]:
        before[r[3]] = before.get(r[3], 0) + size[r[0]]
    for r in stages[4]:
        after[r[3]] = after.get(r[3], 0) + size[r[0]]
    targets = brute_targets(before)
    for source, target in targets.items():
        # Documents are taken whole, so each started one is counted whole.
        assert target - 64 <= after.get(source, 0) <= 2 * before[source]
        assert after.get(source, 0) <= target + before[source] * 0.6 + 64
    assert max(sum(r[0] == d for r in stages[4]) for d in size) <= 2


def test_shards(stages):
    assert sorted(stages[5]) == sorted(brute_shards([r[:2] for r in stages[4]], pipeline.N_SHARDS))


def test_empty_documents(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert pipeline.run(spark, folder).collect() == []


def test_repeated_and_missing_ids_and_more_columns(spark, tmp_path):
    text = " ".join(WORDS["en"] * 5)
    rows = [(1, text, "en", "s", 1, "a", 2), (1, text + " x", "en", "s", 1, "b", 3), (None, text, "en", "s", 1, "c", 4), (2, " ".join(WORDS["fr"] * 6), "fr", "s", None, None, 5)]
    docs = spark.createDataFrame(rows, SCHEMA + ", row string, place int")
    for _, stage in pipeline.STAGES[:2]:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.columns[-2:] == ["row", "place"]
    kept = sorted((r.doc_id is not None, r.doc_id or 0, r["row"]) for r in docs.collect())
    assert [k[1] for k in kept] == [0, 1, 2] and kept[1][2] == "a"
    mixed = pipeline.mix_sources(spark, docs, str(tmp_path))
    assert mixed.columns == docs.columns and 0 < mixed.count() <= 6
    assert mixed.where(F.length("text") == 0).count() == 0 and TOKEN.findall("a b") == ["a", "b"]


def test_stages_send_few_whole_texts_at_a_time(spark, sf_dir):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(5)
    try:
        for stage in (pipeline.identify_language, pipeline.drop_leaks):
            spark.conf.set(key, "10000")
            stage(spark, docs, sf_dir)
            assert spark.conf.get(key) == "1000"
    finally:
        spark.conf.set(key, before)
