"""From documents to shards: language, near copies, benchmark leaks, source mix, shards.

Each stage takes what its predecessor kept and returns documents with their
columns; the last one returns where every document goes. Stages whose Python workers read
whole texts lower the session's rows per Arrow batch to 1,000; it stays so, as their results are computed later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnwork.llm.common import table
from tarnwork.llm.decontam import without_leaks
from tarnwork.llm.jaccard_join import near_duplicates
from tarnwork.llm.langid import UNDETERMINED, held_out, identifier, train
from tarnwork.llm.mixing import whole_documents
from tarnwork.llm.sharding import balanced_shards
from tarnwork.session import limit_batches, scratch_dir

N_SHARDS = 40


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: texts that are NULL, empty, have no letter or agree with no language's codeword better than chance go.

    Without any labelled text to learn from, all texts with a letter stay. Equal rows are treated alike and all kept; other columns
    pass through, whatever they are called; an empty table gives no rows.
    """
    limit_batches(spark)
    model = train(docs.where(~held_out(F.col("doc_id"))))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))  # nothing to learn a language from
    found = identifier(spark, model)(F.col("text"))
    kept = docs.select(F.struct("*").alias("row"), found.alias("found")).where((F.col("found.lang") != UNDETERMINED) & F.col("found.fits"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Rows that share an id are one document: it stays if one of them stands for its group, as the row with the smallest text.
    Rows without an id stay, since nothing says which of them stands for a group. Texts without words are in no group and stay.
    An empty table gives no rows.
    """
    groups = near_duplicates(docs)
    stays = groups.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("id")).distinct()
    rows = docs.select("doc_id", F.struct("*").alias("row"))  # the text once, as it is shuffled
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("row.text"))
    kept = rows.join(stays, rows["doc_id"] == stays["id"], "left_semi").withColumn("place", place).where("place = 1")
    return kept.select("row").unionByName(rows.where("doc_id IS NULL").select("row")).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item, not even with a fifth of its words edited.

    NULL and empty texts contain none and stay, as do all rows without a benchmark; equal rows go or stay together, NULL ids are
    rows like others; an empty table gives no rows.
    """
    limit_batches(spark)
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, whole: each source's words come within half a document of what its seats give, which
    is its target to within a block.

    Sources weigh 5, 2, 1 in turn and share one and a half times all words, so some documents come twice, and
    those of sources beyond their share may not come at all. Texts without words are not taken; a NULL source is one of its own; rows
    equal in id and text are numbered and taken one by one; an empty table gives no rows.
    """
    return whole_documents(docs)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: contiguous shards of near equal bytes.

    NULL texts count as no bytes, rows that come twice get a slot each, NULL ids stand first; an empty table gives no rows.
    """
    return balanced_shards(docs, N_SHARDS)


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", place_in_shards),
]

#: The stages train a classifier, link sets, measure edit distances and draw blocks by hashes that SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
