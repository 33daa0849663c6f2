"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit distance.

Texts and items are sequences of lower-cased words, or of single characters in scripts without spaces. The CGK random walk copies a
sequence into a longer one, moving on after each step or not by a random bit of
step and symbol; sequences at a small edit distance then agree in many places,
so sampling a few places finds them. What is found is verified by the exact edit distance.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import col, table, word_count
from tarnwork.llm.registry import query
from tarnwork.session import settle

#: Characters of scripts that put no spaces between words, with their marks: Han, Kana, Thai, Lao, Myanmar, Khmer.
UNSPACED = (
    "\u3005\u3007\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff\u3041-\u3096\u3099\u309a\u309d-\u309f\u30a1-\u30fa\u30fc-\u30ff\u31f0-\u31ff\uff66-\uff9f"
    "\u0e01-\u0e3a\u0e40-\u0e4e\u0e81-\u0ebd\u0ec0-\u0ece\u0edc-\u0edf\u1000-\u103f\u1050-\u108f\u1780-\u17d3\u17dc\u17dd"
)
TOKEN = re.compile(rf"[{UNSPACED}]|[^\W{UNSPACED}]+")
FOUND = "array<struct<item:int,distance:int,n_words:int,start:int,end:int>>"


@dataclass(frozen=True)
class Search:
    """``max_edits`` is the share of an item's words that may be edited; items under ``least_words`` words are searched for word by word, without edits.

    A single word is not searched for, as it stands in any number of texts that hold no item.

    The number of LSH tables follows from ``recall``: a table compares ``samples`` places of an
    embedding, of which a share of ``differing`` differs at the edit bound (measured with random
    edits, see the tests). ``per_walk`` tables share a random walk.
    """

    max_edits: float = 0.2
    least_words: int = 5
    recall: float = 0.99
    samples: int = 3
    differing: float = 0.65
    per_walk: int = 8
    seed: int = 5

    @property
    def walks(self) -> int:
        tables = math.log(1 - self.recall) / math.log(1 - (1 - self.differing) ** self.samples)
        if tables > 62 * self.per_walk:
            raise ValueError("so many tables need more of them per walk")
        return math.ceil(tables / self.per_walk)

    def edits(self, n: int) -> int:
        return int(self.max_edits * n + 1e-9)


#: The walk's bits are drawn per step (in this period) and class of symbols, one bit of a word for each walk.
PERIOD, CLASSES = 512, 1024


@lru_cache(maxsize=2)
def coins(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, (PERIOD, CLASSES), dtype=np.int64)


def embed(symbols: np.ndarray, starts: np.ndarray, n: int, search: Search) -> np.ndarray:
    """CGK embeddings, shape (3n, walks, starts), of the windows of ``n`` symbols at ``starts``; past a window's end stands -1."""
    toss, walk = coins(search.seed), np.arange(search.walks)[:, None]
    windows = np.append(symbols, np.full(n + 1, -1))[starts[:, None] + np.arange(n + 1)]
    windows[:, n] = -1
    flat, base = windows.ravel(), (np.arange(len(starts)) * (n + 1))[None, :]
    at = np.repeat(base, search.walks, 0)
    stop = at + n
    out = np.empty((3 * n, search.walks, len(starts)), np.int64)
    for step in range(3 * n):
        now = out[step] = flat[at]
        at = np.minimum(at + ((toss[step % PERIOD][now & (CLASSES - 1)] >> walk) & 1), stop)
    return out


@lru_cache(maxsize=4096)
def places(n: int, search: Search) -> np.ndarray:
    """Places of an embedding that the tables compare, shape (walks, tables of a walk, samples)."""
    rng = np.random.default_rng((search.seed, n))
    return rng.integers(0, 3 * n, (search.walks, search.per_walk, search.samples))


def keys(embedded: np.ndarray, n: int, search: Search) -> np.ndarray:
    """Keys, shape (walks, tables of a walk, samples, windows): the sampled symbols themselves."""
    return embedded[places(n, search), np.arange(search.walks)[:, None, None]]


def best_match(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of ``item`` to any part of ``text``, and that part's start and end; the first such end counts."""
    ramp = np.arange(len(text) + 1)

    def last_row(a: np.ndarray, b: np.ndarray, free: bool) -> np.ndarray:
        row = np.zeros_like(ramp) if free else ramp[: len(b) + 1].copy()
        steps = ramp[: len(b) + 1]
        for i, symbol in enumerate(a):
            new = np.empty_like(row)
            new[0] = i + 1
            new[1:] = np.minimum(row[:-1] + (b != symbol), row[1:] + 1)
            row = np.minimum.accumulate(new - steps) + steps
        return row

    row = last_row(item, text, True)
    end = int(row.argmin())
    back = last_row(item[::-1], text[:end][::-1], False)
    return int(row[end]), end - int(back.argmin()), end


class Items:
    """A block of items, ready to search texts for."""

    def __init__(self, texts: list[str], search: Search):
        self.search, self.words, self.symbols = search, {}, []
        for text in texts:
            words = TOKEN.findall(text.lower())
            self.symbols.append(np.array([self.words.setdefault(w, len(self.words) + 1) for w in words], np.int64))
        self.base = len(self.words) + 1
        self.kept = [i for i, s in enumerate(self.symbols) if len(s) >= max(2, search.least_words)]
        self.short: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))  # items by their words' hash, by size
        for i, s in enumerate(self.symbols):
            if 2 <= len(s) < search.least_words:
                self.short[len(s)][int(self.hashes(s, len(s))[0])].append(i)
        postings, self.tables = defaultdict(list), {}
        self.needs, self.counts, sizes = {}, {}, defaultdict(list)
        for i in self.kept:
            n, grams = len(self.symbols[i]), self.grams(self.symbols[i])
            # An edit spoils two pairs of neighbours at most, so this many remain in a match.
            self.needs[i] = max(1, n - 1 - 2 * search.edits(n))
            sizes[n].append(i)
            self.counts[i] = Counter(grams.tolist())
            for g in self.counts[i]:
                postings[g].append(i)
        self.postings = dict(postings)
        self.pairs = np.array(sorted(postings), np.int64)
        for n, members in sizes.items():
            for i in members:
                self.tables[i] = keys(embed(self.symbols[i], np.zeros(1, np.int64), n, search), n, search)
        if self.kept:
            self.margin = max(n + search.edits(n) for n in sizes)
            self.reach = min(n + search.edits(n) for n in sizes)
            self.least = min(math.ceil(self.needs[m[0]] / math.ceil((n + search.edits(n)) / self.reach)) for n, m in sizes.items())

    def grams(self, symbols: np.ndarray) -> np.ndarray:
        return symbols[:-1] * self.base + symbols[1:]

    def hashes(self, symbols: np.ndarray, n: int) -> np.ndarray:
        """A hash of each window of ``n`` symbols."""
        total = np.zeros(len(symbols) - n + 1, np.int64)
        for k in range(n):
            total = total * 0x5851F42D4C957F2D + symbols[k : len(symbols) - n + 1 + k]
        return total

    def exact(self, symbols: np.ndarray) -> Iterator[tuple[int, int]]:
        """Items under ``least_words`` words that stand in the text as they are, and the first place of each."""
        for n, by_hash in self.short.items():
            if len(symbols) < n:
                continue
            codes = self.hashes(symbols, n)
            places = np.flatnonzero(np.isin(codes, np.fromiter(by_hash, np.int64, len(by_hash))))
            open_ = {code: list(items) for code, items in by_hash.items()} if len(places) else {}
            for code, at in zip(codes[places].tolist(), places.tolist(), strict=True):
                for i in open_[code]:
                    if np.array_equal(self.symbols[i], symbols[at : at + n]):
                        yield i, at
                open_[code] = [i for i in open_[code] if not np.array_equal(self.symbols[i], symbols[at : at + n])]

    def regions(self, hits: np.ndarray) -> Iterator[tuple[int, int]]:
        """Stretches of the text that can hold a match: somewhere in a match, ``reach`` places hold ``least`` pairs of some item."""
        total = np.concatenate([[0], np.cumsum(hits)])
        ends = np.minimum(np.arange(len(hits)) + self.reach, len(hits))
        dense = np.flatnonzero(total[ends] - total[:-1] >= self.least)
        if len(dense):
            for part in np.split(dense, np.flatnonzero(np.diff(dense) > 2 * self.margin + self.reach) + 1):
                yield max(0, int(part[0]) - self.margin), min(len(hits) + 1, int(part[-1]) + self.margin + self.reach)

    def shares(self, item: int, part: np.ndarray) -> bool:
        """Whether ``part`` has enough of the item's pairs, each as often as the item has it at most."""
        seen, times = np.unique(self.grams(part), return_counts=True)
        own = self.counts[item]
        return sum(min(own.get(g, 0), t) for g, t in zip(seen.tolist(), times.tolist(), strict=True)) >= self.needs[item]

    def find(self, text: str | None) -> list[dict]:
        """Best match per item, in words ``[start, end)`` of the text."""
        tokens = TOKEN.findall(text.lower()) if text and (self.kept or self.short) else []
        symbols = np.fromiter(map(self.words.get, tokens, repeat(0)), np.int64, len(tokens))
        if len(symbols) < 2:
            return []
        best: dict[int, tuple[int, int, int]] = {i: (0, at, at + len(self.symbols[i])) for i, at in self.exact(symbols)}
        if self.kept:
            self.near(symbols, best)
        return [{"item": i, "distance": d, "n_words": len(self.symbols[i]), "start": s, "end": e} for i, (d, s, e) in sorted(best.items())]

    def near(self, symbols: np.ndarray, best: dict[int, tuple[int, int, int]]) -> None:
        """Adds the best match of every item within its edits."""
        grams = self.grams(symbols)
        spot = np.minimum(np.searchsorted(self.pairs, grams), len(self.pairs) - 1)
        hits = self.pairs[spot] == grams
        if hits.sum() < self.least:
            return
        for low, high in self.regions(hits):
            shared = defaultdict(list)
            for at in np.flatnonzero(hits[low : high - 1]):
                for item in self.postings[int(grams[low + at])]:
                    shared[item].append(int(at))
            by_size = defaultdict(list)
            for item, at in shared.items():
                if len(at) >= self.needs[item]:
                    by_size[len(self.symbols[item])].append((item, np.array(at)))
            for n, items in by_size.items():
                for item, start, end, distance in self.matches(symbols[low:high], n, items):
                    if item not in best or (distance, low + start) < best[item][:2]:
                        best[item] = (distance, low + start, low + end)

    def matches(self, symbols: np.ndarray, n: int, items: list) -> Iterator[tuple[int, int, int, int]]:
        """LSH over all windows of ``n`` words that keep enough of an item's pairs, then the exact distance around those that collide."""
        edits = self.search.edits(n)
        for item, hits in items:
            starts = np.arange(max(1, len(symbols) - (n - edits) + 1))
            held = np.searchsorted(hits, starts + n + edits) - np.searchsorted(hits, starts)
            starts = starts[held >= self.needs[item]]
            runs = np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1) if len(starts) else []
            starts = np.concatenate([r for r in runs if self.shares(item, symbols[r[0] : r[-1] + n + edits])] or [np.zeros(0, np.int64)])
            for batch in np.array_split(starts, math.ceil(len(starts) / 256)) if len(starts) else []:
                own = keys(embed(symbols, batch, n, self.search), n, self.search)
                for group in np.split(near := batch[(own == self.tables[item]).all(2).any((0, 1))], np.flatnonzero(np.diff(near) > n) + 1):
                    if len(group):
                        low = max(0, int(group[0]) - edits)
                        part = symbols[low : int(group[-1]) + n + 2 * edits]
                        distance, start, end = best_match(self.symbols[item], part)
                        if distance <= edits:
                            yield item, low + start, low + end, distance


def finder(spark: SparkSession, texts: list[str], search: Search):
    """A function from a text column to the array of matches with ``texts`` (by position)."""
    shared = spark.sparkContext.broadcast((texts, search))

    @F.pandas_udf(FOUND)
    def find(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items = Items(*shared.value)
        for part in parts:
            yield pd.Series([items.find(t) for t in part], dtype=object)

    return find


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list]:
    """The items in blocks of about ``block_words`` words, so that what is sent to the tasks stays bounded."""
    items = benchmark.select(col(id_col).alias("item_id"), col(text_col).alias("text")).where(F.col("text").isNotNull())
    items = settle(items.withColumn("n", word_count(F.col("text")) + F.regexp_count("text", F.lit(f"[{UNSPACED}]"))), "items")
    blocks = max(1, math.ceil((items.agg(F.sum("n")).first()[0] or 0) / block_words))
    for block in range(blocks):
        yield items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    search: Search = Search(),
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = 200_000,
) -> DataFrame:
    """One row per document and item it contains: ``doc_id, item_id, distance, n_words, start_word, end_word``.

    An item is contained where some part of the document is within ``search.max_edits`` of it in
    words (upper case and all between words do not count); the best place is given, the first on a
    tie. Items under ``search.least_words`` words are found where they stand word by word. Whole texts are
    searched. NULL and empty texts contain nothing and NULL
    or one-word items are in nothing; copies of documents or items are reported one by one; empty
    tables give no rows; other columns are ignored.
    """
    spark, parts = docs.sparkSession, []
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    for items in item_blocks(benchmark, item_id_col, item_text_col, block_words):
        names = F.array(*[F.lit(i.item_id).cast("long") for i in items]).cast("array<bigint>")
        find = finder(spark, [i.text for i in items], search)
        hit = rows.select("doc_id", F.explode(find("text")).alias("hit"))
        parts.append(
            hit.select(
                "doc_id", F.element_at(names, F.col("hit.item") + 1).alias("item_id"), "hit.distance", "hit.n_words",
                F.col("hit.start").alias("start_word"), F.col("hit.end").alias("end_word"),
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def without_leaks(docs: DataFrame, benchmark: DataFrame, search: Search = Search(), text_col: str = "text", block_words: int = 200_000) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns."""
    for items in item_blocks(benchmark, "item_id", "text", block_words):
        find = finder(docs.sparkSession, [i.text for i in items], search)
        docs = docs.where(F.size(find(col(text_col))) == 0)
    return docs


@query("op10_decontamination")
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items, up to a fifth of an item's words edited."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
