"""Near-duplicate documents by an exact Jaccard join in the metric space of shingle sets.

Jaccard distance d is a metric, and a link is d <= r = 1 - similarity. Equal sets
are one point (class). The join goes from coarse to fine:

1. Neighbourhoods. Two linked sets share one of the first shingles of each (in one order over all
   shingles, the rare ones first; of n shingles the first n - ceil(similarity * n) + 1). Points that share none are at a
   distance over r from each other and need no comparison, and most points stay alone here.
2. Pivots. A point of each neighbourhood is its pivot; the others measure their exact distance to it. Links to pivots give
   components; a few rounds are made, each with other pivots, in neighbourhoods that still hold several components.
3. Regions. What may still link meets in a neighbourhood that holds several components. There the points are cut into
   Voronoi regions by pivots of the neighbourhood, a region's points meet each other (by recursion) and those points of
   other regions that the triangle inequality lets into its window, in the metric space of parity sketches (below). Pairs
   that can link leave the region and are measured exactly.

A parity sketch hashes the shingles into buckets and keeps the parity of each bucket's count. The number of differing
bits is a metric and never exceeds the number of shingles in which two sets differ, so no link is hidden. Pairs beyond
the bound by it are not measured.

Step 2 takes one measurement per point and pivot, so most of a large group of near copies is joined at a multiple of its
size. Step 3 sees what is left of it; its comparisons stay inside tasks of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import col, shuffle_width, table
from tarnwork.llm.components import components
from tarnwork.llm.registry import query
from tarnwork.session import settle, small_batches

#: Odd 64-bit numbers that tell a word's place in a shingle.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
#: Bits of a sketch per shingle, at least; sketches have powers of two from the least number of bits on.
SKETCH_RATE, SKETCH_LEAST = 4, 1024
#: Bits of the filter that keeps most unneeded texts out of a shuffle.
FILTER_BITS = 1 << 23
#: Shingles whose repeats a worker counts together, shingles that it deals out together, and bytes of one range of them; none changes a result.
COUNTED, DEALT, RANGE_BYTES = 1 << 21, 1 << 19, 4 << 20
META = "doc_id long, n long, cid long, proof long, sketch array<long>, heavy binary"


@dataclass(frozen=True)
class Rule:
    """Documents link where 100 * |A & B| >= ``percent`` * |A | B| over sets of ``size``-word shingles.

    ``common_most`` bounds the list of frequent shingles that is sent to the tasks; it only orders
    shingles, so that neighbourhoods stay small, and changes no result.
    """

    size: int = 5
    percent: int = 75
    common_most: int = 200_000
    common_from: int = 4
    few: int = 6
    block: int = 4096

    @property
    def radius(self) -> float:
        return 1 - self.percent / 100

    def first(self, n: int) -> int:
        """How many of a set's ``n`` shingles must be looked at to meet every linked set."""
        return n - -(-self.percent * n // 100) + 1


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of the whole text: words between ASCII white space, A-Z in lower case."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - size + 1
    total = hashed[:n] * PLACES[0]
    for k in range(1, size):
        total = total + hashed[k : n + k] * PLACES[k]
    return np.unique(mixed(total))


def identity(own: np.ndarray) -> tuple[int, int]:
    """Two independent signed 64-bit digests of a set."""
    raw = own.tobytes()
    return tuple(x - (1 << 64) if x >> 63 else x for x in (xxhash.xxh3_64_intdigest(raw), xxhash.xxh64_intdigest(raw, seed=1)))


def sketch(own: np.ndarray) -> list[int]:
    """Parity of the number of shingles per bucket, 64 buckets to a number. Twice the buckets fold into these by exclusive or of both halves."""
    bits = SKETCH_LEAST
    while bits < SKETCH_RATE * len(own):
        bits *= 2
    parity = np.bincount((own % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64).tolist()


def repeated(sets: list[np.ndarray]) -> bytes:
    """The shingles that several of the sets hold, and how many do. Empties the list, so that shingles are held once."""
    flat = np.concatenate(sets)
    sets.clear()
    flat.sort()
    same = np.zeros(len(flat) + 1, bool)  # as the one before
    np.equal(flat[1:], flat[:-1], out=same[1:-1])
    first, last = np.flatnonzero(same[1:] & ~same[:-1]), np.flatnonzero(same[:-1] & ~same[1:])
    return np.stack([flat[first], (last - first + 1).astype(np.uint64)], 1).tobytes()


def describe(docs: DataFrame, rule: Rule) -> DataFrame:
    """Per document its set's size and digests; a row of every ``COUNTED`` shingles also lists those that are frequent among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, known, held, waiting = [], set(), 0, None

        def made(ids, sizes, digests, proofs, sketches, heavy) -> pa.RecordBatch:
            columns = [ids, pa.array(sizes, pa.int64()), pa.array(digests, pa.int64()), pa.array(proofs, pa.int64()), pa.array(sketches, pa.list_(pa.int64())), pa.array(heavy, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "cid", "proof", "sketch", "heavy"])

        for batch in batches:
            if not batch.num_rows:
                continue
            if waiting:
                yield made(*waiting)
            sizes, digests, proofs, sketches, heavy = [], [], [], [], []
            for text in batch.column("text"):
                own = shingles(text.as_py(), rule.size)
                cid, proof = identity(own)
                sizes.append(len(own))
                digests.append(cid)
                proofs.append(proof)
                sketches.append(None if cid in known else sketch(own))
                heavy.append(None)
                if cid not in known:
                    known.add(cid)
                    sets.append(own)
                    held += len(own)
                if held >= COUNTED:
                    heavy[-1], held = repeated(sets), 0
                    known.clear()
            waiting = batch.column("doc_id"), sizes, digests, proofs, sketches, heavy
        if waiting:
            if sets:
                waiting[-1][-1] = repeated(sets)
            yield made(*waiting)

    return docs.mapInArrow(run, META)


def common_shingles(meta: DataFrame, rule: Rule) -> np.ndarray:
    """The most frequent shingles, from the rarest to the most frequent, by the workers' counts over all documents."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("heavy"):
                rows = np.frombuffer(blob.as_buffer(), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, 0])), pa.array(np.ascontiguousarray(rows[:, 1]))], ["shingle", "times"])

    counts = meta.where("heavy IS NOT NULL").select("heavy").mapInArrow(unpack, "shingle long, times long")
    often = counts.groupBy("shingle").agg(F.sum("times").alias("times")).where(F.col("times") >= rule.common_from)
    rows = often.orderBy(F.desc("times"), "shingle").limit(rule.common_most).collect()
    return np.array([r.shingle for r in reversed(rows)], np.int64).view(np.uint64)


def neighbourhoods(docs: DataFrame, rule: Rule, common: np.ndarray, buckets: int) -> DataFrame:
    """``place, cid``: the points that look at the same shingle first, for shingles that several points look at.

    A place is named by the sum of hashes of its points; if two sums were equal, the points would be compared as if they met.

    Tasks send packed arrays per range of shingles, not a row for every shingle, and a range is sorted where it arrives.
    """
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.argsort(shared.value, kind="stable")
        known, sent = shared.value[rank], set()
        tokens, owners, held = [], [], 0

        def dealt() -> pa.RecordBatch:
            rows = np.stack([np.concatenate(tokens), np.concatenate(owners).view(np.uint64)], 1)
            tokens.clear()
            owners.clear()
            bucket = (rows[:, 0] % np.uint64(buckets)).astype(np.int64)
            rows = rows[np.argsort(bucket, kind="stable")]
            ends = np.cumsum(np.bincount(bucket, minlength=buckets))
            blobs = [(b, rows[e - c : e].tobytes()) for b, (e, c) in enumerate(zip(ends, np.diff(ends, prepend=0), strict=True)) if c]
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in blobs], pa.int32()), pa.array([x for _, x in blobs], pa.binary())], ["bucket", "rows"])

        for batch in batches:
            for text in batch.column("text"):
                own = shingles(text.as_py(), rule.size)
                cid = identity(own)[0]
                if not len(own) or cid in sent:
                    continue
                sent.add(cid)
                order = mixed(own) >> np.uint64(1)
                if len(known):
                    spot = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    order = np.where(known[spot] == own, np.uint64(1 << 63) + rank[spot].astype(np.uint64), order)
                k = rule.first(len(own))
                first = own[np.argpartition(order, k - 1)[:k]] if k < len(own) else own
                tokens.append(first)
                owners.append(np.full(len(first), cid, np.int64))
                held += len(first)
                if held >= DEALT:
                    yield dealt()
                    held = 0
        if tokens:
            yield dealt()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[bytes] = []
        for batch in batches:
            got += batch.column("rows").to_pylist()
        rows = np.frombuffer(b"".join(got), np.uint64).reshape(-1, 2)
        del got
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        if len(rows):
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:] != rows[:-1]).any(1)
            rows = rows[new]
            begins = np.ones(len(rows), bool)
            begins[1:] = rows[1:, 0] != rows[:-1, 0]
            at = np.flatnonzero(begins)
            length = np.diff(np.append(at, len(rows)))
            # Near copies share many shingles; where the same points meet, one neighbourhood is enough.
            who = np.repeat(np.add.reduceat(mixed(rows[:, 1]), at), length)
            several = np.repeat(length > 1, length)
            rows = np.unique(np.stack([who[several], rows[several, 1]], 1), axis=0)
        for part in range(0, len(rows), 100_000):
            own = np.ascontiguousarray(rows[part : part + 100_000]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(own[:, 0]), pa.array(own[:, 1])], ["place", "cid"])

    packed = docs.select("text").mapInArrow(send, "bucket int, rows binary")
    # By number, not by its hash, which would put several ranges into one task.
    return packed.repartitionById(buckets, F.col("bucket")).mapInArrow(meet, "place long, cid long").distinct()


def folded(longer, other):
    """A sketch folded to half its size if it is longer than the other one."""
    half = F.floor(F.size(longer) / 2).cast("int")
    return F.when(F.size(longer) > F.size(other), F.zip_with(F.slice(longer, 1, half), F.slice(longer, half + 1, half), lambda x, y: x.bitwiseXOR(y))).otherwise(longer)


def within(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` (once each) whose distance can be ``reach`` at most, a column of ``pairs``, as far as sizes and sketches tell."""
    left = classes.select(F.col("cid").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    right = classes.select(F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    once = pairs.groupBy("a", "b").agg(F.max("reach").alias("reach"))
    sized = once.join(left.select("a", "n_a"), "a").join(right.select("b", "n_b"), "b")
    apart = F.abs(F.col("n_a") - F.col("n_b"))
    both = sized.join(left.select("a", "sketch_a"), "a").join(right.select("b", "sketch_b"), "b")
    for _ in range(2):
        both = both.withColumns({"sketch_a": folded(F.col("sketch_a"), F.col("sketch_b")), "sketch_b": folded(F.col("sketch_b"), F.col("sketch_a"))})
    odd = F.aggregate(F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    differ = F.greatest(F.coalesce(odd, F.lit(0)), apart)
    least = 2.0 * differ / (F.col("n_a") + F.col("n_b") + differ)
    return settle(both.where(least <= F.col("reach") + 1e-9).select("a", "b"), "pairs")


def texts_of(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``cid, text`` of the points in ``pairs``.

    A bitmap of hashed ids, of at most ``FILTER_BITS`` bits however many ids there are, keeps other texts out of the join's shuffle.
    """
    used = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    wanted = settle(used.join(classes.select("cid", F.col("name").alias("wanted_id")), "cid"), "wanted")

    def bit(doc_id: str):
        return F.pmod(F.xxhash64(doc_id), F.lit(FILTER_BITS)).cast("long")

    maps = wanted.select(bit("wanted_id").alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
    maps = maps.agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    placed = docs.withColumn("bit", bit("doc_id"))
    placed = placed.withColumns({"bucket": F.bitmap_bucket_number("bit"), "position": F.bitmap_bit_position("bit")})
    octet = F.conv(F.hex(F.expr("substring(bits, CAST(position div 8 AS INT) + 1, 1)")), 16, 10).cast("long")
    likely = placed.join(F.broadcast(maps), "bucket").where(F.getbit(octet, (F.col("position") % 8).cast("int")) == 1)
    return settle(likely.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id"))).select("cid", "text"), "texts")


def measured(pairs: DataFrame, docs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """``a, b, d, linked`` for pairs ``a, b`` of points: the exact distance of their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, other = None, None
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            out = []
            for x, y, left, right in zip(a, b, batch.column("text_a"), batch.column("text_b"), strict=True):
                if last != y:
                    own = shingles(right.as_py(), rule.size)
                    last, other = (y, own) if identity(own)[0] == y else (None, None)
                mine = shingles(left.as_py(), rule.size)
                # With repeated ids a text may be that of another point of the same id.
                if last is None or identity(mine)[0] != x:
                    continue
                common = len(np.intersect1d(mine, other, assume_unique=True))
                union = len(mine) + len(other) - common
                out.append((x, y, 1 - common / union, 100 * common >= rule.percent * union))
            columns = [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "d", "linked"])

    texts = texts_of(pairs, docs, classes)
    left = texts.select(F.col("cid").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("cid").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").sortWithinPartitions("b")
    return settle(rows.mapInArrow(run, "a long, b long, d double, linked boolean").distinct(), "measured")


def comparable(n, m, reach):
    """Whether sets of these sizes can be as near as ``reach``."""
    return F.abs(n - m) <= (reach + F.lit(1e-9)) * F.greatest(n, m)


def parity_distance(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of differing bits between all rows of two matrices of sketches: a metric that never exceeds the symmetric difference."""
    out = np.empty((len(left), len(right)), np.int64)
    step = max(1, (1 << 21) // max(1, right.size))
    for at in range(0, len(left), step):
        out[at : at + step] = np.bitwise_count(left[at : at + step, None, :] ^ right[None]).sum(2, dtype=np.int64)
    return out


class Regions:
    """Exact join of the points of one neighbourhood in the metric space of their parity sketches.

    Points stand as sizes, components, sides and sketches of one length. Links differ in at most
    (1 - s) / (1 + s) of the sum of their sizes, s being the similarity.
    """

    def __init__(self, sizes, parts, sides, sketches, rule: Rule, leaf: int = 768, pivots: int = 16):
        self.sizes, self.parts, self.sides, self.sketches = sizes, parts, sides, sketches
        self.slack = (100 - rule.percent) / (100 + rule.percent)
        # The farthest that a linked point can be from a point, whose partner has at most size / s shingles.
        self.window = self.slack * sizes * (1 + 100 / rule.percent)
        self.leaf, self.n_pivots = leaf, pivots

    def compare(self, left: np.ndarray, right: np.ndarray, ordered: bool) -> Iterator[tuple[int, int]]:
        apart = parity_distance(self.sketches[left], self.sketches[right])
        apart = np.maximum(apart, np.abs(self.sizes[left][:, None] - self.sizes[right][None]))
        good = apart <= self.slack * (self.sizes[left][:, None] + self.sizes[right][None]) + 1e-9
        good &= self.parts[left][:, None] != self.parts[right][None]
        good &= (self.sides[left][:, None] | self.sides[right][None]) == 3
        if ordered:
            good &= np.triu(np.ones(good.shape, bool), 1)
        for i, j in zip(*np.nonzero(good), strict=True):
            yield int(left[i]), int(right[j])

    def join(self, points: np.ndarray) -> Iterator[tuple[int, int]]:
        """Pairs that can link. Pivots cut the points into Voronoi regions; each region is joined with itself in
        the same way, and with the points of later regions that its triangle-inequality window lets in."""
        if len(points) <= self.leaf:
            yield from self.compare(points, points, True)
            return
        pivots = points[np.linspace(0, len(points) - 1, self.n_pivots).astype(int)]
        to = parity_distance(self.sketches[points], self.sketches[pivots])
        home = to.argmin(1)
        nearest = to[np.arange(len(points)), home]
        for region in range(self.n_pivots):
            own = points[home == region]
            if not len(own):
                continue
            if len(own) == len(points):  # all alike: nothing to cut
                for at in range(0, len(own), self.leaf):
                    yield from self.compare(own[at : at + self.leaf], own[at : at + self.leaf], True)
                    yield from self.compare(own[at : at + self.leaf], own[at + self.leaf :], False)
                return
            yield from self.join(own)
            # If x is at home here and y there, to(y, here) <= to(y, there) + 2 * distance(x, y).
            inside = (home > region) & (to[:, region] <= nearest + 2 * self.window[points] + 1e-9)
            guests = points[inside]
            for at in range(0, len(own), self.leaf):
                yield from self.compare(own[at : at + self.leaf], guests, False)


def fold(sketches: np.ndarray) -> np.ndarray:
    half = sketches.shape[1] // 2
    return sketches[:, :half] ^ sketches[:, half:]


def region_pairs(here: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs ``a, b`` of different components that meet in a place and can link, as far as sizes and sketches tell.

    A place's points are dealt into blocks of about ``rule.block``; every pair of blocks is one task's cell, so no
    task holds more than two blocks, and only pairs that can link leave it.
    """

    def cell(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lo, hi = key[1], key[2]
        found = []
        rows = rows.sort_values("cid")
        lengths = rows["sketch"].map(len).to_numpy()
        for length in np.unique(lengths):
            # Sets that can link differ by less than a factor of two, so their sketches by one fold at most.
            short, long = rows[lengths == length], rows[lengths == 2 * length]
            sketches = np.stack(short["sketch"].to_list()).view(np.uint64)
            if len(long):
                sketches = np.concatenate([sketches, fold(np.stack(long["sketch"].to_list()).view(np.uint64))])
            both = pd.concat([short, long])
            # Within a block all pairs count, else those across; longer ones meet each other in their own turn.
            side = np.full(len(both), 3) if lo == hi else np.where(both["block"] == lo, 1, 2)
            regions = Regions(both["n"].to_numpy(), both["part"].to_numpy(), side, sketches, rule)
            cids, met = both["cid"].to_numpy(), [frozenset(x.tolist()) for x in both["places"]]
            # A pair leaves the first of the places where it meets, and no other.
            found += [(cids[i], cids[j]) for i, j in regions.join(np.arange(len(both))) if min(i, j) < len(short) and min(met[i] & met[j]) == key[0]]
        low = [min(x) for x in found]
        return pd.DataFrame({"a": np.array(low, np.int64), "b": np.array([max(x) for x in found], np.int64)})

    blocks = F.ceil(F.col("crowd") / rule.block).cast("int")
    lists = here.groupBy("cid").agg(F.collect_set("place").alias("places")).join(classes.select("cid", "sketch"), "cid")
    placed = here.join(lists, "cid").withColumn("block", F.pmod(F.xxhash64("cid", "place"), blocks).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
    cells = dealt.select("place", "lo", "hi", "block", "cid", "n", "part", "sketch", "places").groupBy("place", "lo", "hi")
    return cells.applyInPandas(cell, "a long, b long").distinct()


def open_places(here: DataFrame) -> DataFrame:
    """Rows ``place, part, ...`` of the places that still hold several components."""
    several = here.groupBy("place").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("place")
    return settle(here.join(several, "place"), "open")


def merged(here: DataFrame, found: DataFrame) -> DataFrame:
    """``here`` with the components that links ``a, b`` (of components) leave."""
    labels = components(found)
    return here.join(labels, here["part"] == labels["node"], "left").withColumn("part", F.coalesce("label", "part")).drop("node", "label")


def links(near: DataFrame, docs: DataFrame, classes: DataFrame, rule: Rule, rounds: int = 4) -> DataFrame:
    """Links ``a, b`` whose components are those of all links. ``near``: ``place, cid``; ``classes``: ``cid, name, n, sketch``."""
    radius = F.lit(rule.radius)
    here = settle(near.join(classes.select("cid", "n"), "cid").withColumn("part", F.col("cid")), "near")
    tests = []
    # Pivots: a point of each place that still holds several components, another one in each round.
    for number in range(rounds):
        pivots = here.groupBy("place").agg(F.min_by(F.struct("cid", "n", "part"), F.xxhash64("cid", F.lit(number))).alias("p"))
        met = here.join(pivots, "place").where((F.col("part") != F.col("p.part")) & comparable(F.col("n"), F.col("p.n"), radius))
        pairs = met.select(F.col("cid").alias("a"), F.col("p.cid").alias("b"), F.col("part").alias("part_a"), F.col("p.part").alias("part_b")).distinct()
        pairs = settle(pairs, "to-pivots")
        tests.append(measured(within(pairs.select("a", "b", radius.alias("reach")), classes), docs, classes, rule))
        new = tests[-1].where("linked").join(pairs, ["a", "b"]).select(F.col("part_a").alias("a"), F.col("part_b").alias("b"))
        if not new.head(1):
            break
        here = open_places(merged(here, new))
    tested = reduce(DataFrame.unionByName, tests).where("linked").select("a", "b")
    # What may still link. Few points are paired as rows; more are joined by region inside tasks.
    crowds = here.groupBy("place").agg(F.count(F.lit(1)).alias("crowd"))
    here = settle(here.join(crowds, "place"), "crowds")
    few = here.where(F.col("crowd") <= rule.few)
    l, r = few.alias("l"), few.alias("r")
    meet = (F.col("l.place") == F.col("r.place")) & (F.col("l.cid") < F.col("r.cid")) & (F.col("l.part") != F.col("r.part")) & comparable(F.col("l.n"), F.col("r.n"), radius)
    rows = l.join(r, meet).select(F.col("l.cid").alias("a"), F.col("r.cid").alias("b"), radius.alias("reach"))
    pairs = within(rows.distinct(), classes).unionByName(region_pairs(here.where(F.col("crowd") > rule.few), classes, rule)).distinct()
    last = measured(settle(pairs, "pairs"), docs, classes, rule)
    return tested.unionByName(last.where("linked").select("a", "b"))


def near_duplicates(df: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``id, n_shingles, component_id``, the smallest id that links lead to.

    Texts with fewer words than a shingle have their whole sequence as the one shingle; NULL texts and texts without words
    have none and link with nothing. Equal texts link. Rows with a NULL id take part, and their
    component is named by its smallest id that is not NULL, if there is one; a repeated id is one
    name for several rows. An empty table gives no rows; other columns are ignored.
    """
    with small_batches(df.sparkSession):  # all Python steps are run in here; what is returned reads their results
        return grouped_documents(df, rule, id_col, text_col)


def grouped_documents(df: DataFrame, rule: Rule, id_col: str, text_col: str) -> DataFrame:
    spark = df.sparkSession
    docs = df.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    meta = settle(describe(docs, rule), "sets")
    facts = [F.min("doc_id").alias("name"), F.max("n").alias("n"), F.min("proof").alias("low"), F.max("proof").alias("high"), F.first("sketch", ignorenulls=True).alias("sketch")]
    classes = settle(meta.where("n > 0").groupBy("cid").agg(*facts), "classes")
    total, torn = classes.agg(F.sum("n"), F.count(F.when(F.col("low") != F.col("high"), 1))).first()
    if torn:
        raise RuntimeError(f"{torn} digests stand for several sets; use another seed")
    if not total:
        return meta.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    buckets = max(shuffle_width(spark), math.ceil(total * rule.radius * 16 / RANGE_BYTES))
    near = settle(neighbourhoods(docs, rule, common_shingles(meta, rule), buckets), "neighbourhoods")
    found = settle(links(near, docs, classes, rule), "links")
    named = classes.select("cid", "name")
    if found.head(1):
        labels = components(found)
        grouped = named.join(labels, named["cid"] == labels["node"], "left").select("cid", "name", F.coalesce("label", "cid").alias("part"))
        smallest = grouped.groupBy("part").agg(F.min("name").alias("component_id"))
        named = grouped.join(smallest, "part").select("cid", "component_id")
    else:
        named = named.withColumnRenamed("name", "component_id")
    rows = meta.join(named, "cid", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


@query("op5_jaccard_join")
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: five words, a similarity of 0.75 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"))
