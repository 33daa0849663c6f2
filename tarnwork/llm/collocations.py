"""Phrase collocations: Rabin-Karp fingerprints of all word n-grams, counted, checked against the text, and scored."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tarnwork.llm.common import col, shuffle_width, table
from tarnwork.llm.registry import query
from tarnwork.session import scratch_dir, settle

#: Modulus of the polynomials, a Mersenne prime: products of two remainders stay under 62 bits.
PRIME = np.uint64((1 << 31) - 1)
BITS = np.uint64(31)
#: What a byte is: 0 part of a word, 1 between words, 2 the end of a piece.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
#: Bytes of text taken together, and words hashed together; neither changes the result.
TAKEN_BYTES, HASHED_WORDS = 12_000_000, 1 << 17
#: Cells of the count table that travel in one row.
CELLS_PER_ROW = 1 << 15
#: Fingerprints that a task holds before it hands them on, and buckets for each shuffle partition.
HELD_PRINTS, BUCKETS = 2_000_000, 4
#: Start and length of an occurrence in one number.
SPAN = 1 << 31


def folded(x: np.ndarray) -> np.ndarray:
    """Remainders by the prime, for numbers under 2**62."""
    x = (x & PRIME) + (x >> BITS)
    x = (x & PRIME) + (x >> BITS)
    return np.where(x >= PRIME, x - PRIME, x)


class Polynomials:
    """Prefix polynomials over bytes to two bases; the powers are kept and grow with the longest stretch asked for."""

    def __init__(self, seed: int) -> None:
        r = np.random.default_rng(seed)
        self.of_byte = r.integers(1, int(PRIME), (2, 256), np.uint64)
        self.bases = [int(b) for b in r.integers(1 << 20, int(PRIME), 2)]
        self.powers = [[np.ones(1, np.uint64)] * 2 for _ in self.bases]

    def powers_to(self, which: int, length: int) -> list[np.ndarray]:
        """Powers of the base and of its inverse."""
        base = self.bases[which]
        for i, b in enumerate((base, pow(base, -1, int(PRIME)))):
            known = self.powers[which][i]
            while len(known) < length:
                known = np.concatenate([known, folded(known * np.uint64(pow(b, len(known), int(PRIME))))])
            self.powers[which][i] = known
        return self.powers[which]

    def prefixes(self, joined: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For both bases the sums of the first bytes' terms, and the powers of the inverse."""
        for which in range(2):
            power, inverse = self.powers_to(which, len(joined))
            sums = np.zeros(len(joined) + 1, np.uint64)
            np.cumsum(folded(self.of_byte[which][joined] * power[: len(joined)]), out=sums[1:])
            yield sums, inverse

    def stretches(self, joined: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """62-bit fingerprints of stretches of the bytes."""
        high, low = (folded(folded(sums[ends] - sums[starts]) * inverse[starts]) for sums, inverse in self.prefixes(joined))
        return (high << BITS) | low

    def ngrams(self, joined: np.ndarray, starts: np.ndarray, ends: np.ndarray, n_first: int, longest: int) -> Iterator[np.ndarray]:
        """For n of 1 to ``longest``: 62-bit fingerprints of the n-grams that begin at the first ``n_first`` words and end within them all."""
        prefixes = [(sums[ends], sums[starts[:n_first]], inverse[starts[:n_first]]) for sums, inverse in self.prefixes(joined)]
        for n in range(1, longest + 1):
            m = min(n_first, max(0, len(starts) - n + 1))
            high, low = (folded(folded(end[n - 1 : n - 1 + m] - start[:m]) * back[:m]) for end, start, back in prefixes)
            yield (high << BITS) | low


def spread(fingerprints: np.ndarray, salt: int) -> np.ndarray:
    """One to one, so that the upper bits depend on all."""
    x = fingerprints ^ np.uint64(salt)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of some texts: where they stand, their pieces, and the texts with one space after each word."""

    def __init__(self, texts: list[bytes]) -> None:
        data = np.frombuffer(b"\n".join([*texts, b""]).lower(), np.uint8)
        self.text_starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        kind = KIND[data]
        inside = kind == 0
        change = np.flatnonzero(np.diff(inside, prepend=False))
        self.starts, ends = change[::2], change[1::2]  # the last byte is a line's end
        self.lengths = ends - self.starts
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.starts]
        inside[ends] = True
        self.joined = np.where(kind == 0, data, np.uint8(0x20))[inside]
        self.joined_starts = np.cumsum(self.lengths + 1) - self.lengths - 1

    def __len__(self) -> int:
        return len(self.starts)

    def ngrams(self, polynomials: Polynomials, longest: int, salt: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``n``, the first words of n-grams within a piece, and their fingerprints."""
        for low in range(0, len(self), HASHED_WORDS):
            first = min(HASHED_WORDS, len(self) - low)
            all_ = slice(low, min(len(self), low + first + longest - 1))
            zero = self.joined_starts[low]
            starts = self.joined_starts[all_] - zero
            ends = starts + self.lengths[all_]
            hashes = polynomials.ngrams(self.joined[zero : zero + ends[-1]], starts, ends, first, longest)
            for n, found in enumerate(hashes, 1):
                at = np.arange(low, low + len(found))
                within = self.piece[at] == self.piece[at + n - 1]
                yield n, at[within], spread(found[within], salt)

    def fingerprints(self, polynomials: Polynomials, at: np.ndarray, n: np.ndarray, salt: int) -> np.ndarray:
        """Fingerprints of the n-grams of ``n`` words that begin at the words ``at``."""
        out, order = np.zeros(len(at), np.uint64), np.argsort(at, kind="stable")
        longest = int(n.max()) if len(n) else 0
        for low in range(0, len(self), HASHED_WORDS):
            some = order[slice(*np.searchsorted(at[order], [low, low + HASHED_WORDS]))]
            if len(some):
                zero, last = self.joined_starts[low], min(len(self), low + HASHED_WORDS + longest - 1) - 1
                starts, end = self.joined_starts[at[some]] - zero, at[some] + n[some] - 1
                ends = self.joined_starts[end] + self.lengths[end] - zero
                joined = self.joined[zero : self.joined_starts[last] + self.lengths[last]]
                out[some] = polynomials.stretches(joined, starts, ends)
        return spread(out, salt)

    def names(self, fingerprints: np.ndarray) -> np.ndarray:
        """A number for each word, the same for the same bytes only: words of one fingerprint are compared with the first of them."""
        _, first, name = np.unique(fingerprints, return_index=True, return_inverse=True)
        open_, n_names = np.arange(len(self)), len(first)
        while True:
            like = first[name[open_]]
            same = self.lengths[open_] == self.lengths[like]
            at, to = open_[same], like[same]
            lengths = self.lengths[at]
            step = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            differs = self.joined[np.repeat(self.joined_starts[at], lengths) + step] != self.joined[np.repeat(self.joined_starts[to], lengths) + step]
            wrong = np.zeros(len(open_), bool)
            wrong[~same] = True
            wrong[np.flatnonzero(same)[np.unique(np.repeat(np.arange(len(at)), lengths)[differs])]] = True
            if not wrong.any():
                return name
            # Another text under the same fingerprint: named after its own first one.
            open_ = open_[wrong]
            _, own, again = np.unique(name[open_], return_index=True, return_inverse=True)
            first = np.concatenate([first, open_[own]])
            name[open_] = n_names + again
            n_names += len(own)


def distinct_ngrams(names: np.ndarray, at: np.ndarray, n: np.ndarray, fingerprints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``which, count``: n-grams told apart by their words, each once (as a place in ``at``) with its number.

    N-grams of one fingerprint are compared word by word with the first of them; those that differ make up
    further n-grams with the same fingerprint.
    """
    open_ = np.argsort(fingerprints, kind="stable")
    while len(open_):
        new = np.flatnonzero(np.diff(fingerprints[open_], prepend=~fingerprints[open_[:1]]) != 0)
        sizes = np.diff(new, append=len(open_))
        like = np.repeat(open_[new], sizes)
        wrong = n[open_] != n[like]
        for k in range(int(n.max())):
            still = np.flatnonzero((n[open_] > k) & ~wrong)
            wrong[still] = names[at[open_[still]] + k] != names[at[like[still]] + k]
        yield open_[new], sizes - np.add.reduceat(wrong.astype(np.int64), new)
        open_ = open_[wrong]


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, list[bytes]]]:
    """``lang, row numbers, texts``, some megabytes at a time."""
    for batch in batches:
        langs, numbers = batch.column("lang").to_pylist(), batch.column("row_no").to_numpy()
        texts = [t.as_buffer().to_pybytes() for t in batch.column("text")]
        for lang in dict.fromkeys(langs):
            taken, size = [], 0
            own = [i for i, x in enumerate(langs) if x == lang]
            for i in own:
                taken.append(i)
                size += len(texts[i])
                if size >= TAKEN_BYTES or i == own[-1]:
                    yield lang, numbers[taken], [texts[j] for j in taken]
                    taken, size = [], 0


def _salt(lang: str) -> int:
    return int.from_bytes(lang.encode()[:64].ljust(8, b"\0"), "little") * 0x9E3779B97F4A7C15 & (1 << 64) - 1


def count_cells(texts: DataFrame, longest: int, least: int, bits: int, seed: int) -> tuple[DataFrame, bytes]:
    """Words per language, and a bitmap of the cells of a hashed count table that n-grams hit ``least`` times in all.

    Each task counts into a table of its own, stopping at ``least``; the tables are added up by stretches of cells,
    compressed to a few bits for each n-gram.
    """
    kind = np.min_scalar_type(least)
    stretch = min(CELLS_PER_ROW, 1 << bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        polynomials, cells, words = Polynomials(seed), np.zeros(1 << bits, kind), {}
        for lang, _, some in _by_language(batches):
            found = Words(some)
            words[lang] = words.get(lang, 0) + len(found)
            for _, _, fingerprints in found.ngrams(polynomials, longest, _salt(lang)):
                hit, times = np.unique((fingerprints >> np.uint64(64 - bits)).astype(np.uint32), return_counts=True)
                cells[hit] = np.minimum(cells[hit].astype(np.int64) + times, least)
        names = ["lang", "words", "stretch", "cells"]
        yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64()), pa.nulls(len(words), pa.int32()), pa.nulls(len(words), pa.binary())], names)
        rows = cells.reshape(-1, stretch)
        used = np.flatnonzero(rows.any(1))
        for low in range(0, len(used), 512):
            some = used[low : low + 512]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.string()), pa.nulls(len(some), pa.int64()), pa.array(some, pa.int32()), pa.array([pa.compress(rows[i].tobytes(), "zstd", asbytes=True) for i in some], pa.binary())], names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, cells in zip(batch.column("stretch").to_pylist(), batch.column("cells"), strict=True):
                counts = np.frombuffer(pa.decompress(cells.as_buffer(), stretch * kind.itemsize, "zstd"), kind).astype(np.int64)
                sums[i] = np.minimum(sums[i] + counts, least) if i in sums else counts
        full = {i: np.packbits(x >= least, bitorder="little").tobytes() for i, x in sums.items()}
        yield pa.RecordBatch.from_arrays([pa.array(list(full), pa.int32()), pa.array(list(full.values()), pa.binary())], ["stretch", "full"])

    counted = settle_small(texts.mapInArrow(count, "lang string, words long, stretch int, cells binary"), "cells")
    words = counted.where("words IS NOT NULL").groupBy("lang").agg(F.sum("words").alias("n"))
    parts = counted.where("words IS NULL").select("stretch", "cells").repartition(shuffle_width(texts.sparkSession), "stretch").mapInArrow(add, "stretch int, full binary")
    bitmap = bytearray(max(1, (1 << bits) // 8))
    for row in parts.toLocalIterator():  # 2**bits / 8 bytes in all, whatever the table holds
        bitmap[row.stretch * len(row.full) : (row.stretch + 1) * len(row.full)] = row.full
    return words, bytes(bitmap)


def added(parts: list[np.ndarray]) -> np.ndarray:
    """Columns print, check, count, row number and span, by print and check; counts of the same two are added, any one's pointer stays."""
    rows = np.concatenate(parts, axis=1)
    rows = rows[:, np.lexsort((rows[1], rows[0]))]
    new = np.flatnonzero((np.diff(rows[:2], prepend=~rows[:2, :1]) != 0).any(0))
    out = rows[:, new]
    out[2] = np.add.reduceat(rows[2], new) if len(new) else out[2]
    return out


def blocks(rows: np.ndarray, buckets: int) -> pa.RecordBatch:
    """``bucket, n_rows, rows``: sorted rows cut by their print into buckets, each compressed; prints as steps, of which few bytes are not 0."""
    bucket = (rows[0] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    first = np.flatnonzero(np.diff(bucket, prepend=~bucket[:1]) != 0)
    packed = []
    for x in np.split(rows, first[1:], axis=1):
        x = np.ascontiguousarray(x)
        x[0] = np.diff(x[0], prepend=np.uint64(0))
        # Bytes of one place lie together.
        packed.append(pa.compress(x.view(np.uint8).reshape(5, -1, 8).transpose(0, 2, 1).tobytes(), "zstd", asbytes=True))
    sizes = np.diff(first, append=rows.shape[1]).astype(np.int32)
    columns = [pa.array(bucket[first].astype(np.int32)), pa.array(sizes), pa.array(packed, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "n_rows", "rows"])


def unblocked(block: pa.Buffer, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(block, n * 40, "zstd"), np.uint8).reshape(5, 8, n).transpose(0, 2, 1)
    rows = np.ascontiguousarray(raw).view(np.uint64).reshape(5, n)
    rows[0] = np.cumsum(rows[0], dtype=np.uint64)
    return rows


def settle_small(df: DataFrame, label: str) -> DataFrame:
    """``settle`` with a stronger compression, for tables that are as large as the texts."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def phrase_counts(df: DataFrame, longest: int = 5, least: int = 100, lang_col: str = "lang", text_col: str = "text", cell_bits: int = 25, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """``lang, n`` (words of each language) and ``lang, phrase, f`` (phrases of 1 to ``longest`` words that occur at least ``least`` times).

    Texts are split at ``[.,;:!?]`` and line ends into pieces, those at spaces and tabs into words, A-Z in lower case; phrases stand within a piece.
    Prefix polynomials over the bytes give each n-gram's fingerprint. A first pass adds up how often cells of a
    hashed table are hit; n-grams of cells under ``least`` cannot be frequent, nor those that hold one. The second pass sends fingerprints of the others,
    counted per some megabytes of text, with a pointer to one occurrence. Before they are counted together there, n-grams of one
    fingerprint are compared word by word, and those of another text get a row of their own, told apart by a check to other
    bases (124 bits in all). The pointers of frequent fingerprints then fetch their phrases from the texts.

    ``2**cell_bits`` cells (by default 32 MB in a task, and a bitmap of 4 MB sent to all) decide how much is sent, not what is
    found: with more n-grams for each cell than ``least`` the table keeps all. Fingerprints travel in compressed blocks by bucket. NULL texts are empty, a NULL language is ``und``; repeated rows count each; an empty table gives none.
    """
    if longest < 1 or least < 1:
        raise ValueError("longest and least must be at least 1")
    spark = df.sparkSession
    texts = df.select(F.coalesce(col(lang_col), F.lit("und")).alias("lang"), col(text_col).cast("binary").alias("text"), F.monotonically_increasing_id().alias("row_no"))
    texts = settle_small(texts.where("text IS NOT NULL"), "texts")
    words, bitmap = count_cells(texts, longest, least, cell_bits, seed)
    full = spark.sparkContext.broadcast(bitmap)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        polynomials, others, hits = Polynomials(seed), Polynomials(seed + 1), np.frombuffer(full.value, np.uint8)
        held: list[np.ndarray] = []
        for lang, numbers, some in _by_language(batches):
            found, salt = Words(some), _salt(lang)
            at, n, prints, of_words, alive = [], [], [], [np.zeros(0, np.uint64)], np.zeros(0, bool)
            for size, where, fingerprints in found.ngrams(polynomials, longest, salt):
                if size == 1:
                    of_words.append(fingerprints)
                cell = fingerprints >> np.uint64(64 - cell_bits)
                kept = (hits[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1
                if size > 1:  # a frequent n-gram's two parts of one word less are frequent too
                    kept &= alive[where] & alive[where + 1]
                alive = np.ones(len(found) + 1, bool)  # also where the words of the next stretch are not seen yet
                alive[where] = kept
                at.append(where[kept])
                prints.append(fingerprints[kept])
                n.append(np.full(len(at[-1]), size, np.int8))
            if not sum(map(len, at)):
                continue
            at, n, prints = map(np.concatenate, (at, n, prints))
            names = found.names(np.concatenate(of_words))
            for which, count in distinct_ngrams(names, at, n, prints):
                first, last = found.starts[at[which]], at[which] + n[which] - 1
                text = np.searchsorted(found.text_starts, first, "right") - 1
                span = (first - found.text_starts[text]) * SPAN + found.starts[last] + found.lengths[last] - first
                checks = found.fingerprints(others, at[which], n[which], salt)
                held.append(np.stack([prints[which], checks, *(x.astype(np.uint64) for x in (count, numbers[text], span))]))
            if sum(x.shape[1] for x in held) >= HELD_PRINTS:
                yield blocks(added(held), buckets)
                held.clear()
        if held:
            yield blocks(added(held), buckets)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for bucket, rows, n in zip(batch.column("bucket").to_pylist(), batch.column("rows"), batch.column("n_rows").to_pylist(), strict=True):
                parts = held.setdefault(bucket, [])
                parts.append(unblocked(rows.as_buffer(), n))
                if len(parts) > 1 and sum(x.shape[1] for x in parts[1:]) > max(HELD_PRINTS // 4, parts[0].shape[1]):
                    parts[:] = [added(parts)]
        for parts in held.values():
            _, _, f, row_no, span = added(parts)
            often = f >= least
            yield pa.RecordBatch.from_arrays([pa.array(x[often].view(np.int64)) for x in (row_no, span, f)], ["of_row", "span", "f"])

    buckets = BUCKETS * shuffle_width(spark)
    sent = texts.mapInArrow(send, "bucket int, n_rows int, rows binary").repartition(shuffle_width(spark), "bucket")
    frequent = settle(sent.mapInArrow(add, "of_row long, span long, f long"), "frequent")
    read = texts.join(frequent, texts["row_no"] == frequent["of_row"])
    phrase = F.expr(f"CAST(substring(text, CAST(span div {SPAN} + 1 AS INT), CAST(span % {SPAN} AS INT)) AS STRING)")
    spaced = F.regexp_replace(F.translate(phrase, string.ascii_uppercase, string.ascii_lowercase), "[ \t]+", " ")
    counts = read.select("lang", spaced.alias("phrase"), "f")
    return words, settle(counts, "phrases")


def collocations(words: DataFrame, phrases: DataFrame, top: int = 2000, share: int = 100) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language by score, then count, then phrase.

    ``words`` (``lang, n``) and ``phrases`` (``lang, phrase, f``, with all parts of each phrase) come from ``phrase_counts``. A phrase
    that occurs a times, cut into parts that occur l and r times, scores floor(1000 a n / (l r)); the lowest cut counts, the
    earliest among equals. Phrases are dropped that stand in a longer one with at least ``share`` percent of their count.
    """
    listed = phrases.withColumn("word", F.split("phrase", " "))
    found = listed.where(F.size("word") >= 2)
    inner = F.expr("flatten(transform(sequence(2, size(word) - 1), k -> transform(sequence(1, size(word) - k + 1), i -> array_join(slice(word, i, k), ' '))))")
    longer = found.where(F.size("word") >= 3).select("lang", F.explode(inner).alias("part"), "f").groupBy("lang", "part").agg(F.max("f").alias("within"))
    cuts = found.select("lang", "phrase", F.col("f").alias("a"), "word", F.explode(F.expr("sequence(1, size(word) - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.expr("array_join(slice(word, 1, k), ' ')").alias("left_part"), F.expr("array_join(slice(word, k + 1, size(word)), ' ')").alias("right_part"))
    left = phrases.select(F.col("lang").alias("l_lang"), F.col("phrase").alias("l_phrase"), F.col("f").alias("l"))
    right = phrases.select(F.col("lang").alias("r_lang"), F.col("phrase").alias("r_phrase"), F.col("f").alias("r"))
    scored = cuts.join(left, (cuts["lang"] == left["l_lang"]) & (cuts["left_part"] == left["l_phrase"])).join(right, (cuts["lang"] == right["r_lang"]) & (cuts["right_part"] == right["r_phrase"]))
    scored = scored.join(words.select(F.col("lang").alias("n_lang"), F.col("n")), F.col("lang") == F.col("n_lang"))
    score = F.expr("(CAST(1000 AS DECIMAL(38, 0)) * a * n) div (CAST(l AS DECIMAL(38, 0)) * r)")
    lowest = scored.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    whole = lowest.join(longer.select(F.col("lang").alias("p_lang"), "part", "within"), (F.col("lang") == F.col("p_lang")) & (F.col("phrase") == F.col("part")), "left")
    whole = whole.where(F.col("within").isNull() | (100 * F.col("within") < share * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = whole.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


@query(
    "op12_collocations",
    r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
            unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents WHERE text IS NOT NULL
    ), worded AS (
        SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
    ), total AS (
        SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang
    ), placed AS (
        SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded
    ), grams AS (
        SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k FROM placed, range(1, 6) AS sizes(k) WHERE i + k - 1 <= len(w)
    ), counts AS (
        SELECT lang, phrase, k, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
    ), split AS (
        SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE k >= 2
    ), cuts AS (
        SELECT lang, phrase, f, k, w, unnest(range(1, k)) AS cut FROM split
    ), scored AS (
        SELECT c.lang, c.phrase, c.f AS a, l.f AS l, r.f AS r, t.n,
            ((1000::HUGEINT * c.f * t.n) // (l.f::HUGEINT * r.f))::BIGINT AS score, c.cut
        FROM cuts c
        JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.cut], ' ')
        JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')
        JOIN total t ON t.lang = c.lang
    ), lowest AS (
        SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
    ), parts AS (
        SELECT lang, f, w, k, unnest(range(2, k)) AS size FROM split WHERE k >= 3
    ), inner_parts AS (
        SELECT lang, f, w, size, unnest(range(1, k - size + 2)) AS i FROM parts
    ), within AS (
        SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(f) AS f FROM inner_parts GROUP BY ALL
    ), whole AS (
        SELECT lowest.* FROM lowest LEFT JOIN within USING (lang, phrase) WHERE within.f IS NULL OR 100 * within.f < 100 * a
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM whole QUALIFY rank <= 2000
    """,
)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of two to five words in all documents, by language."""
    return collocations(*phrase_counts(table(spark, sf_dir, "documents")))
