"""Document fingerprints by consistent weighted sampling; column expressions only.

A text is the bag of its lower-cased words. Each of a fingerprint's lanes draws, for
every word, r and c from Gamma(2, 1) and b from [0, 1) by hashing word and lane, so that all texts
use the same draws; with weight S the word offers

    t = floor(ln S / r + b)        a = c / (exp(r (t - b)) exp(r))

and the word with the least a, with its t, is the lane. Two texts agree in a
lane with a probability that is their generalised Jaccard similarity (sum of the smaller over sum of the larger weights).
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnwork.llm.common import col, shuffle_width, table
from tarnwork.llm.registry import query

SPACE = r"[\x20\x09-\x0D]+"
#: Lanes computed side by side; more make the generated code too long for the JVM's compiler.
WIDTH = 8
#: The gamma distribution is drawn from this many quantiles of equal weight.
QUANTILES = 1 << 11
NOTHING = 0


def words(text: Column) -> Column:
    """Hashes of the lower-cased words, in order of the hashes."""
    return F.sort_array(F.transform(F.filter(F.split(F.lower(text), SPACE), lambda w: w != ""), lambda w: F.xxhash64(w)))


def weighted(hashes: str) -> Column:
    """``term, log_weight`` of each run of equal numbers in a sorted array column."""
    h = F.col(hashes)
    places = F.when(F.size(h) > 0, F.sequence(F.lit(0), F.size(h) - 1)).otherwise(F.array().cast("array<int>"))
    starts = F.filter(places, lambda i: (i == 0) | (F.get(h, i) != F.get(h, i - 1)))
    return F.transform(starts, lambda i: F.struct(F.get(h, i).alias("term"), i.alias("start")))


def gamma_quantiles() -> np.ndarray:
    """Quantiles of Gamma(2, 1), the solutions of 1 - (1 + x) exp(-x) = p, by halving."""
    p = (np.arange(QUANTILES) + 0.5) / QUANTILES
    low, high = np.zeros(QUANTILES), np.full(QUANTILES, 64.0)
    for _ in range(80):
        middle = (low + high) / 2
        below = 1 - (1 + middle) * np.exp(-middle) < p
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return (low + high) / 2


def offers(lane: Column, r_of: Column, ln_c_of: Column) -> tuple[Column, Column]:
    """For a row ``term, log_weight``: ln a and the sample of the lane."""
    bits = F.xxhash64("term", lane)
    r = F.get(r_of, F.shiftrightunsigned(bits, 53).cast("int"))
    ln_c = F.get(ln_c_of, F.shiftrightunsigned(bits, 42).cast("int").bitwiseAND(QUANTILES - 1))
    b = bits.bitwiseAND((1 << 42) - 1) / float(1 << 42)
    t = F.floor(F.col("log_weight") / r + b)
    return ln_c - r * (t - b) - r, F.col("term").bitwiseXOR(F.shiftleft(t, 20))


def signatures(rows: DataFrame, keys: list[str], carried: list[str] = (), lanes: int = 32) -> DataFrame:
    """``keys, carried, lanes`` for rows ``keys, carried, hashes`` (see ``words``): an array of ``lanes`` 32-bit numbers, all 0 without words.

    ``carried`` columns must depend on the keys. If ``rows`` are already dealt out by one of the keys, nothing is shuffled.
    """
    if lanes % WIDTH:
        raise ValueError(f"lanes must be a multiple of {WIDTH}")
    quantiles = gamma_quantiles()
    r_of, ln_c_of = F.lit(quantiles), F.lit(np.log(quantiles))
    runs = rows.withColumn("n_words", F.size("hashes")).withColumn("runs", weighted("hashes")).drop("hashes")
    ends = F.transform("runs", lambda x, i: F.struct(x["term"].alias("term"), F.log((F.coalesce(F.get(F.col("runs"), i + 1)["start"], F.col("n_words")) - x["start"]).cast("double")).alias("log_weight")))
    each = runs.withColumn("runs", ends).select(*keys, *carried, F.explode_outer("runs").alias("x")).select(*keys, *carried, "x.term", "x.log_weight")
    wide = each.select("*", F.explode(F.array(*[F.lit(i) for i in range(lanes // WIDTH)])).alias("part"))
    made = [offers(F.col("part") * WIDTH + i, r_of, ln_c_of) for i in range(WIDTH)]
    offered = wide.select(*keys, *carried, "part", *[x.alias(f"{n}{i}") for i, pair in enumerate(made) for n, x in zip("as", pair, strict=True)])
    best = offered.groupBy(*keys, "part").agg(*[F.min_by(f"s{i}", f"a{i}").alias(f"s{i}") for i in range(WIDTH)], *[F.first(c).alias(c) for c in carried])
    lane = [F.when(F.col(f"s{i}").isNull(), F.lit(NOTHING).cast("long")).otherwise(F.xxhash64(f"s{i}").bitwiseAND((1 << 32) - 1)) for i in range(WIDTH)]
    parts = best.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("part", F.array(*lane).alias("lanes")))).alias("parts"), *[F.first(c).alias(c) for c in carried])
    return parts.select(*keys, *carried, F.flatten("parts.lanes").alias("lanes"))


def likeness(a: Column, b: Column) -> Column:
    """Share of the lanes in which two fingerprints agree; 1 for two texts without words."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x) / F.size(a)


def as_text(lanes: Column) -> Column:
    return F.array_join(F.transform(lanes, lambda x: F.lpad(F.hex(x), 8, "0")), "")


def in_slices(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows ``slice, id, text, borrowed`` in slices of contiguous ids, each slice ending in a copy of the row that follows it.

    Slices go by descending id, NULL ids last; after the last slice follows the first. Cuts are approximate quantiles of the
    ids, a few per shuffle partition; all rows of an id are in one slice.
    """
    spark = df.sparkSession
    rows = df.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text"))
    n = 4 * shuffle_width(spark)
    cuts = sorted(set(rows.stat.approxQuantile("id", [i / n for i in range(1, n)], 0.1 / n)))
    splits = [float("-inf"), *(cuts or [0.0]), float("inf")]
    cut = Bucketizer(splits=splits, inputCol="as_double", outputCol="cut")
    # NULL ids stand with the smallest.
    placed = cut.transform(rows.withColumn("as_double", F.coalesce(F.col("id").cast("double"), F.lit(float("-inf"))))).withColumn("slice", -F.col("cut").cast("int"))
    firsts = {r["slice"]: r["first_id"] for r in placed.groupBy("slice").agg(F.max("id").alias("first_id")).collect()}  # one row per slice
    order = sorted(firsts)
    before = dict(zip(order, [order[-1], *order[:-1]], strict=True)) if order else {}
    named = [i for i in firsts.values() if i is not None]
    is_first = F.col("id").isin(named) | (F.col("id").isNull() if None in firsts.values() else F.lit(False)) if order else F.lit(False)
    lookup = F.create_map(*[F.lit(x) for s in order for x in (s, before[s])]) if order else F.create_map().cast("map<int,int>")
    own = F.struct(F.col("slice"), F.lit(False).alias("borrowed"))
    lent = F.struct(F.element_at(lookup, F.col("slice")).alias("slice"), F.lit(True).alias("borrowed"))
    homes = F.when(F.coalesce(is_first, F.lit(False)), F.array(own, lent)).otherwise(F.array(own))
    return placed.select("id", "text", F.explode(homes).alias("home")).select("home.slice", "id", "text", "home.borrowed")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lanes: int = 32) -> DataFrame:
    """Per row its fingerprint, that of its edited text, and how alike they are and the next row's is.

    The next row is that of the next smaller id (NULL ids last; then by text; after the last row the
    first). The edited text has the last third of the code points replaced by as many of the next text.
    Result: ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    A NULL text is empty, and a text without words has the fingerprint of zeros. A
    single row is its own next. Repeated ids stand beside each other; an empty table gives no rows; other columns are ignored.
    The texts are shuffled once, by slice of ids, and everything after that stays within the slice.
    """
    rows = in_slices(df, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    order = Window.partitionBy("slice").orderBy("borrowed", F.desc_nulls_last("id"), "text")
    lined = rows.select("slice", "borrowed", "id", "text", F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("next_text"))
    n = F.length("text")
    kept = n - F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), kept), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), n - kept))
    pairs = lined.select("slice", "place", "borrowed", "id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    facts = pairs.select("slice", "place", "borrowed", "id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.array(F.col("text"), F.col("edited")).alias("both"))
    # The facts ride along as 64-bit numbers: fixed width keeps the grouping a hash aggregate, and no join is needed.
    digest = [F.conv(F.substring("edited_sha256", 1 + 8 * i, 8), 16, 10).cast("long").alias(f"d{i}") for i in range(8)]
    numbers = ["borrowed", "id", "n_chars", *[f"d{i}" for i in range(8)]]
    texts = facts.select("slice", "place", F.col("borrowed").cast("long").alias("borrowed"), "id", "n_chars", *digest, F.posexplode("both").alias("which", "own_text"))
    signed = signatures(texts.select("slice", "place", "which", *numbers, words(F.col("own_text")).alias("hashes")), ["slice", "place", "which"], numbers, lanes)
    variants = [F.max(F.when(F.col("which") == i, F.col("lanes"))).alias(name) for i, name in enumerate(("own", "edited"))]
    both = signed.groupBy("slice", "place").agg(*variants, *[F.first(c).alias(c) for c in numbers])
    following = Window.partitionBy("slice").orderBy("place")
    both = both.withColumn("next", F.lead("own").over(following)).where("borrowed = 0")
    sha = reduce(F.concat, [F.lpad(F.lower(F.hex(f"d{i}")), 8, "0") for i in range(8)])
    return both.select(
        F.col("id").alias(id_col),
        "n_chars",
        sha.alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )


@query("op8_fingerprints")
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints(table(spark, sf_dir, "documents"))
