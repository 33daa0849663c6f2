"""Mixing sources to target weights: Sainte-Laguë seats are blocks of equal token count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tarnwork.llm.common import col, global_prefix, shuffle_width, slices_for, table, word_count
from tarnwork.llm.registry import query
from tarnwork.session import settle

#: One of them divides no given number of blocks, so it steps through all of them.
STRIDES = (1_000_003, 1_000_033, 1_000_037)


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """Per source ``source, source_no, source_size, target`` from rows ``source, size``.

    Sources stand by code point, NULL last, and take ``weights`` in turn. They
    share ``share`` times all sizes by weight; a target stops at ``cap`` times its source's
    size, and what it leaves goes to the others by weight until none is above.
    """
    if share > cap:
        raise ValueError("the sources cannot give that much")
    named = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = global_prefix(named, [F.col("source").isNull(), F.col("source")], label="sources").withColumnRenamed("rank", "source_no")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    ranked = settle(ranked.withColumn("weight", weight), "sources")
    most = F.col("source_size") * cap
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, last = 0.0, -1.0  # words per unit of weight; rises as sources fill up
    while level != last:
        last = level
        full = most <= F.col("weight") * level
        given, open_weight = ranked.agg(F.sum(F.when(full, most)), F.sum(F.when(~full, F.col("weight")))).first()
        if not open_weight:
            break
        level = max(level, (share * total - (given or 0.0)) / open_weight)
    return ranked.select("source", "source_no", "source_size", F.least(most, F.col("weight") * F.lit(level)).alias("target"))


def sainte_lague(targets: DataFrame, seats: int, votes: str = "target", party: str = "source_no") -> DataFrame:
    """``targets`` with ``quota``: ``seats`` dealt out one by one to the highest quotient votes / (2k - 1).

    A larger divisor than the true one gives every party a lower bound of its
    seats, a smaller one an upper bound; only the few quotients between them are
    ranked, ties going to the smaller ``party``. Parties without votes get none.
    """
    n, total = targets.agg(F.count(F.lit(1)), F.sum(votes)).first()
    if not total or seats <= 0:
        return targets.withColumn("quota", F.lit(0).cast("long"))
    high = total / (seats - n / 2) if seats > n / 2 else None
    low = total / (seats + n / 2)
    sure = F.floor(F.col(votes) / high + 0.5) if high else F.lit(0).cast("long")
    bounds = settle(targets.withColumn("sure", sure.cast("long")).withColumn("possible", (F.ceil(F.col(votes) / low) + 1).cast("long")), "quotas")
    open_seats = seats - bounds.agg(F.sum("sure")).first()[0]
    offers = bounds.where(f"{votes} > 0").select(party, votes, F.explode(F.sequence(F.col("sure") + 1, F.col("possible"))).alias("seat"))
    offers = offers.withColumn("quotient", F.col(votes) / (2 * F.col("seat") - 1))
    won = global_prefix(offers, [-F.col("quotient"), F.col(party), F.col("seat")], label="quotients").where(F.col("rank") < open_seats)
    more = won.groupBy(party).agg(F.count(F.lit(1)).alias("more"))
    return bounds.join(more, party, "left").withColumn("quota", F.col("sure") + F.coalesce(F.col("more"), F.lit(0))).drop("sure", "possible", "more")


def place_of(key: Column, digest: Column, among: Column, seed: int) -> Column:
    """Where a row stands in its source's seeded order, by its key, text and number among equal rows."""
    return F.shiftrightunsigned(F.xxhash64(key, digest, among, F.lit(seed)), 1)


def equal_rows(rows: DataFrame, most: int = 10_000) -> DataFrame:
    """``rows`` with ``among``: 0, 1, ... among rows that are equal in all columns.

    Equal rows are counted map-side and then written out again, in pieces of ``most`` that are dealt to all tasks, so
    that many of them, such as all rows without an id, are no one task's work.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    pieces = counted.withColumn("piece", F.explode(F.expr(f"sequence(0, (copies - 1) div {most})")))
    several = pieces.where(f"copies > {most}").repartition(shuffle_width(rows.sparkSession), F.xxhash64(*rows.columns, "piece"))
    all_ = pieces.where(f"copies <= {most}").unionByName(several)
    among = F.explode(F.expr(f"sequence(piece * {most}, least(copies, (piece + 1) * {most}) - 1)"))
    return all_.withColumn("among", among).drop("copies", "piece")


def mix_plan(
    df: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    block_tokens: int = 32,
    n_shards: int = 8,
    least_blocks: int = 64,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    rows_per_slice: int = 50_000,
) -> DataFrame:
    """Per row of ``df``: ``id, source, size, source_size, target, blocks, taken, place, before, among``.

    A source's rows stand in an order seeded by their id and text and are cut into blocks of
    ``block_tokens`` words (the last may be shorter). Seats of the Sainte-Laguë
    apportionment are blocks. Sources of fewer than ``least_blocks`` blocks, for which a seat would be worth too much or more than it delivers, have blocks of
    one word and an apportionment of their own. A source with more seats than blocks takes all of them
    again, and the remaining seats pick blocks through a seeded permutation, so no block is ever
    moved or sorted to be chosen. Seats are dealt to the shards in turn, which gives whole
    quotas per shard and source. ``blocks`` lists the chosen pieces of the row as
    structs ``block, first_word, n_words, shard`` (one entry per repeat), and ``taken`` adds up
    their words. ``place`` is where the seed puts the row, and ``before`` counts its source's words up to there.

    A NULL text has no words, a NULL source is a source of its own, equal rows are told apart by a
    number and stand in different places, an empty table gives no rows; other columns are ignored.
    """
    rows = df.select(col(id_col).alias("id"), col(source_col).alias("source"), word_count(col(text_col)).alias("size"), F.xxhash64(col(text_col)).alias("digest"))
    rows = settle(equal_rows(rows), "sizes")
    targets = source_targets(rows, weights, share, cap)
    is_small = F.col("source_size") < least_blocks * block_tokens
    targets = settle(targets.withColumn("block_size", F.when(is_small, 1).otherwise(block_tokens).cast("long")), "targets")
    totals = dict(targets.groupBy("block_size").agg(F.sum("target")).collect())  # two sizes at most
    parts = [sainte_lague(targets.where(F.col("block_size") == b), round((totals.get(b) or 0) / b)) for b in sorted({1, block_tokens})]
    quotas = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    n_blocks = F.ceil(F.col("source_size") / F.col("block_size")).cast("long")
    quotas = quotas.withColumn("n_blocks", n_blocks).withColumn("quota", F.least(F.col("quota"), (F.col("n_blocks") * cap).cast("long")))
    quotas = global_prefix(quotas, [F.col("source_no")], ["quota"], "seats").drop("rank", "quota_total").withColumnRenamed("quota_before", "first_seat")
    stride = F.coalesce(*[F.when(F.col("n_blocks") % p != 0, F.lit(p)) for p in STRIDES], F.lit(1))
    quotas = settle(quotas.withColumn("stride", stride), "seats")

    slices = max(slices_for(rows.count(), rows_per_slice), shuffle_width(df.sparkSession))
    hashed = rows.withColumn("place", place_of(F.col("id"), F.col("digest"), F.col("among"), seed)).withColumn("slice", F.expr(f"place div {2**63 // slices + 1}"))
    known = hashed.join(quotas, hashed["source"].eqNullSafe(quotas["source"])).drop(quotas["source"])
    known = settle(known, "known")
    totals = known.groupBy("source_no", "slice").agg(F.sum("size").alias("slice_size"))
    earlier = Window.partitionBy("source_no").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("source_no", "slice", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)).alias("slice_offset"))
    within = Window.partitionBy("source_no", "slice").orderBy("place", "id", "size", "among").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lined = known.withColumn("local", F.sum("size").over(within) - F.col("size")).join(offsets, ["source_no", "slice"])
    lined = lined.withColumn("before", F.col("slice_offset") + F.col("local"))

    b = F.col("block_size")
    end = F.col("before") + F.col("size")

    def seats_of(block: Column) -> Column:
        """Seat numbers within the source that stand for the block."""
        seat = F.pmod(block * F.col("stride") + F.lit(seed), F.col("n_blocks"))
        more = F.col("quota") - 1 - seat
        rounds = F.floor(more / F.col("n_blocks")).cast("long")
        return F.when(more >= 0, F.transform(F.sequence(F.lit(0).cast("long"), rounds), lambda k: seat + k * F.col("n_blocks"))).otherwise(F.array().cast("array<bigint>"))

    def pieces(block: Column) -> Column:
        first = F.greatest(block * b, F.col("before"))
        n_words = F.least((block + 1) * b, end) - first
        return F.transform(
            seats_of(block),
            lambda seat: F.struct(
                block.alias("block"),
                (first - F.col("before")).alias("first_word"),
                n_words.alias("n_words"),
                ((F.col("first_seat") + seat) % n_shards).cast("int").alias("shard"),
            ),
        )

    spanned = F.sequence(F.floor(F.col("before") / b).cast("long"), F.floor((end - 1) / b).cast("long"))
    empty = F.array().cast("array<struct<block:bigint,first_word:bigint,n_words:bigint,shard:int>>")
    blocks = F.when((F.col("size") > 0) & (F.col("quota") > 0), F.flatten(F.transform(spanned, pieces))).otherwise(empty)
    planned = lined.withColumn("blocks", blocks)
    taken = F.aggregate("blocks", F.lit(0).cast("long"), lambda acc, x: acc + x["n_words"])
    return planned.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "blocks", taken.alias("taken"), "place", "before", "among")


def mixed_texts(df: DataFrame, plan: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mix itself: one row per chosen piece with its shard and words. Needs ids that are unique and not NULL."""
    words = F.regexp_extract_all(F.col("text"), F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    texts = df.select(col(id_col).alias(id_col), col(text_col).alias("text"))
    picked = plan.select(id_col, F.explode("blocks").alias("piece")).groupBy(id_col).agg(F.collect_list("piece").alias("pieces"))
    split = texts.join(picked, id_col).select(id_col, words.alias("words"), F.explode("pieces").alias("piece"))
    piece = F.slice("words", (F.col("piece.first_word") + 1).cast("int"), F.col("piece.n_words").cast("int"))
    return split.select(id_col, "piece.shard", "piece.block", F.array_join(piece, " ").alias("text"))


def whole_documents(df: DataFrame, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``df`` as often as a mix of whole rows takes them, with all their columns.

    The plan's seats say how many words a source gives: those of all its chosen blocks. Its rows are taken in the plan's seeded
    order, and from the first again after the last, as long as at least half of the next row lies within that number,
    so its words are off by half a row at most. A row's place in
    the order tells whether it is taken, so texts stay where they are; only rows equal in id and text are written aside to be
    numbered. Rows without words are not taken. NULL ids and sources and repeated rows are rows like others; an empty table gives none.
    """

    def digest() -> Column:
        return F.xxhash64(col(text_col))

    plan = mix_plan(df.select(col(id_col).alias("id"), col(source_col).alias("source"), col(text_col).alias("text")), seed=seed, id_col="id").where("size > 0")
    plan = settle(plan.drop("blocks"), "mix-plan")
    seated = plan.groupBy("source").agg(F.sum("taken").alias("seated")).withColumnRenamed("source", "seated_source")
    plan = plan.join(seated, F.col("source").eqNullSafe(F.col("seated_source")))
    rounds = F.floor(F.col("seated") / F.col("source_size")).cast("int")
    once_more = F.col("before") + F.col("size") / 2 <= F.col("seated") - F.col("rounds") * F.col("source_size")
    last = plan.withColumn("rounds", rounds).groupBy("source").agg(F.first("rounds").alias("rounds"), F.max(F.when(once_more, F.col("place"))).alias("last"))
    last = settle(last.withColumnRenamed("source", "of_source"), "last-places")
    rows = df.select(F.struct("*").alias("row"), col(id_col).alias("in_id"), col(source_col).alias("in_source"), digest().alias("in_digest"), (word_count(col(text_col)) > 0).alias("has_words"))
    rows = rows.where("has_words")
    # Equal rows, by id, source and text.
    like = df.select(col(id_col).alias("of_id"), col(source_col).alias("of_source"), digest().alias("of_digest")).groupBy("of_id", "of_source", "of_digest").agg(F.count(F.lit(1)).alias("copies"))
    like = settle(like.where("copies > 1").drop("copies"), "equal-rows")
    numbered = rows.withColumn("among", F.lit(0).cast("long"))
    if like.head(1):
        same = F.col("in_id").eqNullSafe(F.col("of_id")) & F.col("in_source").eqNullSafe(F.col("of_source")) & F.col("in_digest").eqNullSafe(F.col("of_digest"))
        aside = rows.join(like, same, "left_semi").withColumn("part_no", F.spark_partition_id()).withColumn("in_part", F.monotonically_increasing_id())
        aside = settle(aside, "equal-rows")
        key = ["in_id", "in_source", "in_digest"]
        counts = aside.groupBy("part_no", *key).agg(F.count(F.lit(1)).alias("n"))
        earlier = Window.partitionBy(*key).orderBy("part_no").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select(F.col("part_no").alias("p"), *[F.col(c).alias(f"o_{c}") for c in key], F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
        local = F.row_number().over(Window.partitionBy("part_no", *key).orderBy("in_part")) - 1
        met = (F.col("part_no") == F.col("p")) & F.col("in_id").eqNullSafe(F.col("o_in_id")) & F.col("in_source").eqNullSafe(F.col("o_in_source")) & F.col("in_digest").eqNullSafe(F.col("o_in_digest"))
        several = aside.withColumn("local", local).join(offsets, met).withColumn("among", (F.col("offset") + F.col("local")).cast("long")).select(*numbered.columns)
        numbered = numbered.join(like, same, "left_anti").unionByName(several)
    taken = numbered.join(last, F.col("in_source").eqNullSafe(F.col("of_source")))
    at = place_of(F.col("in_id"), F.col("in_digest"), F.col("among"), seed)
    times = F.col("rounds") + F.coalesce((at <= F.col("last")).cast("int"), F.lit(0))
    copies = taken.select(F.explode(F.array_repeat("row", times)).alias("row"))
    return copies.select(*[F.col("row").getField(c).alias(c) for c in df.columns])


@query("op6_mixing")
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed with weights 5, 2, 1 to one and a half times their words."""
    return mix_plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
