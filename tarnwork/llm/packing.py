"""Lexical retrieval packing: a sharded BM25 index finds each seed's unused neighbours, which fill its window."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, compress, count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import col, shuffle_width, table
from tarnwork.llm.registry import query
from tarnwork.session import scratch_dir

#: Words whose ids a worker keeps (it forgets rare ones beyond that), and bytes of text split at a time; neither changes the result.
KEPT_WORDS, TAKEN_BYTES = 1_000_000, 4_000_000
#: Marks of ASCII but the apostrophe, which begins words such as 's.
MARKS = rb"""!"#$%&()*+,-./:;<=>?@[\]^_`{|}~"""
LETTERS = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
#: Saturation and length normalisation of BM25.
K1, B = 1.5, 0.75
LEADS = ("lead_1", "lead_2", "lead_3")
#: Sequences of whole windows of one document are numbered from here, so that they meet no others.
OWN_FIRST = 1 << 62


def places(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of runs that begin at ``first``, one run after the other."""
    upto = np.cumsum(lengths)
    return np.repeat(first - upto + lengths, lengths) + np.arange(upto[-1] if len(upto) else 0)


def laid_out(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each string begins (and the last ends) in the bytes of all."""
    _, at, letters = strings.buffers()
    at = np.frombuffer(at, np.int32)[strings.offset : strings.offset + len(strings) + 1]
    return at, np.frombuffer(letters, np.uint8) if letters else np.zeros(0, np.uint8)


class WordTokens:
    """Ids of texts by a tokenizer that lower-cases, drops white space and never joins what white space parts.

    Distinct runs between ASCII white space are found by Arrow's dictionaries. Closing marks are cut off a run that ends in a
    letter, where such a tokenizer always cuts; each distinct part is encoded once and kept. Texts with a special token's name are encoded whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content.lower().encode() for t in special.values()]
        self.size = self.tokenizer.get_vocab_size()
        self.ends_word = np.zeros(self.size, bool)
        self.ends_word[[i for t, i in self.tokenizer.get_vocab(False).items() if t.endswith("</w>")]] = True
        self.begin()

    def begin(self) -> None:
        self.number: defaultdict[bytes, int] = defaultdict(count().__next__)  # names are numbered as they are first asked for
        self.first, self.length, self.seen = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(1, np.uint32)  # the first is the id of a text's end

    def forget(self) -> None:
        """Drops the names met once or twice; all of them, if that leaves too many."""
        kept = np.flatnonzero(self.seen > 2)
        if len(kept) > KEPT_WORDS // 2:
            return self.begin()
        names = list(self.number)
        self.number = defaultdict(count(len(kept)).__next__, zip([names[i] for i in kept], range(len(kept)), strict=True))
        lengths = self.length[kept]
        self.ids = np.concatenate([self.ids[:1], self.ids[places(self.first[kept], lengths)]])
        self.first, self.length, self.seen = 1 + np.cumsum(lengths) - lengths, lengths, self.seen[kept] // 2

    def encoded(self, names: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of names without white space one after the other, and how many each has."""
        texts = b"\n".join(names).decode().split("\n")
        plain = np.fromiter(map(str.isalpha, texts), bool, len(texts))
        runs = list(compress(texts, plain))
        found = self.tokenizer.encode_batch_fast([" ".join(runs[i : i + 1000]) for i in range(0, len(runs), 1000)], add_special_tokens=False)
        flat = np.fromiter(chain.from_iterable([x.ids for x in found]), np.uint32)
        last = np.flatnonzero(self.ends_word[flat])
        if len(last) != len(runs):  # some run of letters is more than one word
            plain, flat, last = np.zeros(len(texts), bool), flat[:0], last[:0]
        others = [x.ids for x in self.tokenizer.encode_batch_fast(list(compress(texts, ~plain)), add_special_tokens=False)]
        lengths = np.zeros(len(names), np.int64)
        lengths[plain] = np.diff(last, prepend=-1)
        lengths[~plain] = list(map(len, others))
        from_runs = np.repeat(plain, lengths)
        ids = np.zeros(len(from_runs), np.uint32)
        ids[from_runs] = flat
        ids[~from_runs] = np.fromiter(chain.from_iterable(others), np.uint32)
        return ids, lengths

    def numbers(self, names: list[bytes]) -> np.ndarray:
        """The numbers of names; those not met so far are learned."""
        known = len(self.number)
        found = np.fromiter(map(self.number.__getitem__, names), np.int64, len(names))
        if len(self.number) > known:
            ids, lengths = self.encoded(list(islice(self.number, known, None)))
            self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(lengths) - lengths])
            self.length, self.seen = np.concatenate([self.length, lengths]), np.concatenate([self.seen, np.zeros(len(lengths), np.int64)])
            self.ids = np.concatenate([self.ids, ids])
        return found

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, each text's with ``end_id`` behind, and where each text begins."""
        if len(self.number) > KEPT_WORDS:
            self.forget()
        self.ids[0] = end_id
        whole = [i for i, t in enumerate(texts) if b"<|" in t and any(s in t.lower() for s in self.special)]
        rest = texts.copy()
        for i in whole:
            rest[i] = b""
        strings = pa.Array.from_buffers(pa.string(), len(rest), pa.array(rest, pa.binary()).buffers())
        split = pc.ascii_split_whitespace(pc.ascii_lower(strings))
        found = split.flatten().dictionary_encode()  # only the distinct words are asked for one by one
        words, word = found.dictionary, found.indices.to_numpy()
        # A word is a name, or two of them: one ending in an ASCII letter, and the marks behind it.
        cores = pc.ascii_rtrim(words, MARKS.decode())
        (word_at, letters), (core_at, core_letters) = laid_out(words), laid_out(cores)
        sizes, core_sizes = np.diff(word_at), np.diff(core_at)
        cut = np.flatnonzero((0 < core_sizes) & (core_sizes < sizes))
        cut = cut[np.isin(core_letters[core_at[cut + 1] - 1], LETTERS)]
        is_cut = np.zeros(len(words), bool)
        is_cut[cut] = True
        tail_sizes = sizes[cut] - core_sizes[cut]
        tail_at = np.concatenate([[0], np.cumsum(tail_sizes)]).astype(np.int32)
        tails = pa.Array.from_buffers(pa.string(), len(cut), [None, pa.py_buffer(tail_at), pa.py_buffer(letters[places(word_at[cut] + core_sizes[cut], tail_sizes)])])
        named = pa.concat_arrays([pc.if_else(pa.array(is_cut), cores, words), tails]).dictionary_encode()
        names = pa.Array.from_buffers(pa.binary(), len(named.dictionary), named.dictionary.buffers(), offset=named.dictionary.offset)
        number = self.numbers(names.to_numpy(zero_copy_only=False).tolist())[named.indices.to_numpy()]
        front, behind = number[: len(words)], number[len(words) :]
        times = np.bincount(word, minlength=len(words))
        self.seen += np.bincount(number, np.concatenate([times, times[cut]]), len(self.seen)).astype(np.int64)
        # The ids of words of two names are put together behind the others; one more word is a text's end.
        both = np.stack([front[cut], behind], 1).ravel()
        first, length = np.append(self.first[front], 0), np.append(self.length[front], 1)
        length[cut] += self.length[behind]
        first[cut] = len(self.ids) + np.cumsum(length[cut]) - length[cut]
        ids = np.concatenate([self.ids, self.ids[places(self.first[both], self.length[both])]])
        ends = split.offsets.to_numpy()
        word = np.insert(word, ends[1:], len(words))
        lengths = length[word]
        starts = np.concatenate([[0], np.cumsum(lengths)])[ends + np.arange(len(ends))]
        ids = ids[places(first[word], lengths)]
        for i in reversed(whole):
            own = np.array(self.tokenizer.encode(texts[i].decode(), add_special_tokens=False).ids, np.uint32)
            ids = np.insert(ids, starts[i], own)
            starts[i + 1 :] += len(own)
        return ids, starts


_TOKENIZERS: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """The worker's tokenizer, with the words it has met."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokens(path)
    return _TOKENIZERS[path]


def distinct_terms(ids: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``text, term, how often`` for each text's distinct ids, by text."""
    kind = np.int32 if len(starts) * size < 2**31 else np.int64
    keys = np.repeat(np.arange(len(starts) - 1, dtype=kind) * kind(size), np.diff(starts))
    keys += ids.astype(kind)
    keys.sort()
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[new] // size, keys[new] % size, np.diff(new, append=len(keys))


def leads(text: np.ndarray, term: np.ndarray, times: np.ndarray, n: int) -> np.ndarray:
    """For each text its three terms of most weight, by how often and how late in the vocabulary, whose early ids are the common ones."""
    weight = times / (times + K1) * np.log1p(term)
    first, found = np.searchsorted(text, np.arange(n)), np.zeros((3, n), np.int32)
    for row in found:
        best = np.maximum.reduceat(weight, first)
        at = np.flatnonzero(weight == best[text])
        at = at[np.diff(text[at], prepend=-1) != 0]
        row[:] = term[at]
        weight[at] = -1
    return found


def tokenized(df: DataFrame, path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, row_no, tokens, ids, lead_1, lead_2, lead_3`` for each row (ids as little-endian numbers; see ``leads``), and one row
    for each task with ``terms`` and ``counts``: in how many of its texts they occur."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(path)
        kind = np.dtype("<u2") if tokens.size <= 1 << 16 else np.dtype("<u4")
        counts = np.zeros(tokens.size, np.int64)
        for batch in batches:
            texts, low, taken = [], 0, 0
            for i, text in enumerate(batch.column("text")):
                texts.append(text.as_buffer().to_pybytes())
                taken += len(texts[-1])
                if i == batch.num_rows - 1 or taken >= TAKEN_BYTES:
                    ids, starts = tokens.encode(texts, end_id)
                    distinct = distinct_terms(ids, starts, tokens.size)
                    counts += np.bincount(distinct[1], minlength=tokens.size)
                    at = pa.py_buffer((starts * kind.itemsize).astype(np.int32))
                    column = pa.Array.from_buffers(pa.binary(), len(texts), [None, at, pa.py_buffer(ids.astype(kind))])
                    some, n = batch.slice(low, len(texts)), len(texts)
                    empty = pa.nulls(n, pa.list_(pa.int32())), pa.nulls(n, pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("row_no"), pa.array(np.diff(starts)), column, *map(pa.array, leads(*distinct, n)), *empty], names)
                    low, texts, taken = low + n, [], 0
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), *[pa.nulls(1, pa.int32())] * 3, pa.array([used.astype(np.int32)]), pa.array([counts[used]])], names
        )

    from pyspark.sql.pandas.types import to_arrow_type

    names = ["doc_id", "row_no", "tokens", "ids", *LEADS, "terms", "counts"]
    rows = df.select(col(id_col).alias("doc_id"), F.coalesce(col(text_col), F.lit("")).cast("binary").alias("text"), F.monotonically_increasing_id().alias("row_no"))
    id_type = to_arrow_type(rows.schema["doc_id"].dataType)
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(encode, f"doc_id {kind}, row_no long, tokens long, ids binary, lead_1 int, lead_2 int, lead_3 int, terms array<int>, counts array<long>")
    out = scratch_dir(df.sparkSession, "tokens")
    found.write.option("compression", "zstd").parquet(out)
    return df.sparkSession.read.parquet(out)


@dataclass
class Shard:
    """Some texts' ids with a BM25 index over them; what of each is still unused begins at ``used``."""

    texts: list[np.ndarray]
    idf: np.ndarray
    mean: float
    used: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.sizes, self.used = sizes, np.zeros(len(sizes), np.int64)
        text, term, times = distinct_terms(np.concatenate(self.texts), np.concatenate([[0], np.cumsum(sizes)]), len(self.idf))
        weight = self.idf[term] * times * (K1 + 1) / (times + K1 * (1 - B + B * sizes[text] / self.mean))
        self.terms, self.term_first = term, np.searchsorted(text, np.arange(len(sizes) + 1))
        by_term = np.argsort(term, kind="stable")
        self.text_of, self.term_of, self.weight = text[by_term].astype(np.int64), term[by_term], weight[by_term]
        self.index()

    def index(self) -> None:
        """Where each term's texts begin; leaves out texts that are used up."""
        open_ = self.used < self.sizes
        self.open = int(open_.sum())
        kept = open_[self.text_of]
        self.text_of, self.term_of, self.weight = self.text_of[kept], self.term_of[kept], self.weight[kept]
        self.found_first = np.concatenate([[0], np.cumsum(np.bincount(self.term_of, minlength=len(self.idf)))])

    def neighbours(self, seed: int) -> np.ndarray:
        """Texts that are not used up by falling score with the seed's terms; equal ones, and those without a common term, in the shard's order."""
        terms = self.terms[self.term_first[seed] : self.term_first[seed + 1]]
        first = self.found_first[terms]
        lengths = self.found_first[terms + 1] - first
        at = np.repeat(first - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        scores = np.bincount(self.text_of[at], self.weight[at], len(self.sizes))
        open_ = np.flatnonzero(self.used < self.sizes)
        return open_[np.argsort(-scores[open_], kind="stable")]

    def windows(self, window: int) -> Iterator[list[tuple[int, int, int]]]:
        """``text, start, length`` of the pieces of each window; all windows but the last are full.

        A seed's neighbours go in whole as long as they fit, the best first; then the best that is left is cut to fill the window, and
        its rest is the next seed. Otherwise the next unused text is.
        """
        seed, after = 0, 0
        while after < len(self.sizes):
            if self.used[after] == self.sizes[after]:
                after += 1
                seed = after
                continue
            if self.used[seed] == self.sizes[seed]:
                seed = after
            room, pieces = window, []

            def put(text: int, most: int) -> int:
                length = min(most, int(self.sizes[text] - self.used[text]))
                pieces.append((text, int(self.used[text]), length))
                self.used[text] += length
                return length

            room -= put(seed, room)
            if np.count_nonzero(self.used < self.sizes) < 0.7 * self.open:
                self.index()
            order = self.neighbours(seed) if room else np.zeros(0, np.int64)
            left, at = self.sizes[order] - self.used[order], 0
            while room and len(fits := np.flatnonzero(left[at:] <= room)):
                at += int(fits[0])
                room -= put(int(order[at]), room)
                at += 1
            if room:
                rest = order[self.used[order] < self.sizes[order]]
                if len(rest):
                    seed = int(rest[0])
                    put(seed, room)
            yield pieces


def powers_of_two(pieces: list[tuple], length: int) -> Iterator[list[tuple]]:
    """The pieces of an open window, cut into sequences whose lengths are powers of two, the largest first."""
    pieces = pieces[::-1]
    for bit in reversed(range(length.bit_length())):
        room, out = length & 1 << bit, []
        while room:
            text, start, ids = pieces.pop()
            out.append((text, start, ids[:room]))
            if len(ids) > room:
                pieces.append((text, start + room, ids[room:]))
            room -= len(out[-1][2])
        if out:
            yield out


def packed_sequences(
    df: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, shard_tokens: int = 1 << 19, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of all rows' ids in sequences of at most ``window``: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    A row's ids are its text's by the tokenizer file (one that lower-cases and drops white space, see ``WordTokens``) and
    then ``end_id``; ``ids`` holds a piece's as little-endian 32-bit numbers. Whole windows of a long text are
    sequences of their own. The rest of each text is a unit. Units are sorted by the terms that weigh most in their text, so that like ones lie together, and each
    range of that order is a task, which cuts it into shards of ``shard_tokens`` ids. A shard has a BM25 index, weighted by
    document frequencies over all rows; each seed's unused neighbours fill its window. All sequences are full, but for each task's last
    window, which is cut at powers of two, so that nothing is padded.

    A NULL text is empty (its only id is ``end_id``), NULL and repeated ids and equal rows are packed row by row, an empty
    table gives no rows. Memory holds a shard, the terms' weights (one number for each id of the vocabulary) and the longest text.
    """
    spark = df.sparkSession
    read = tokenized(df, tokenizer, end_id, id_col, text_col)
    terms = read.where("ids IS NULL").select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).groupBy("t.terms").agg(F.sum("t.counts").alias("rows"))
    rows = read.where("ids IS NOT NULL")
    n, total = rows.agg(F.count(F.lit(1)), F.sum("tokens")).first()
    size = word_tokens(tokenizer).size
    width = 2 if size <= 1 << 16 else 4
    counts = np.zeros(size)
    for term, k in terms.collect():  # at most one row for each id of the vocabulary
        counts[term] = k
    weights = spark.sparkContext.broadcast((np.log1p((n - counts + 0.5) / (counts + 0.5)).astype(np.float32).tobytes(), (total or 0) / max(n, 1)))
    kind = f"<u{width}"
    id_kind = rows.schema["doc_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = np.frombuffer(weights.value[0], np.float32)
        number = TaskContext.get().partitionId() << 33
        units: list[tuple] = []  # doc_id, doc_tokens, start, ids
        out: list[tuple] = []
        held = 0

        def sequence(pieces: list[tuple]) -> None:
            nonlocal number
            offset = 0
            for unit, start, ids in pieces:
                out.append((unit[0], unit[2] + start, len(ids), ids.astype("<u4").tobytes(), unit[1], number, offset))
                offset += len(ids)
            number += 1

        def flush(last: bool) -> None:
            """Writes the full windows; the units of an open one stay for the next shard."""
            nonlocal units, held
            shard, open_ = Shard([u[3] for u in units], idf, weights.value[1]), []
            for pieces in shard.windows(window):
                cut = [(units[i], start, units[i][3][start : start + length]) for i, start, length in pieces]
                if sum(p[2] for p in pieces) == window:
                    sequence(cut)
                else:
                    open_ = cut
            if last:
                for cut in powers_of_two(open_, sum(len(c[2]) for c in open_)):
                    sequence(cut)
                open_ = []
            units = [(u[0], u[1], u[2] + start, ids) for u, start, ids in open_]
            held = sum(len(u[3]) for u in units)

        def sent() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            kinds = [None, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) if k else pa.array(c, id_type) for c, k in zip(columns, kinds, strict=True)], NAMES)

        for batch in batches:
            for doc_id, tokens, start, ids in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "tokens", "start", "ids")], strict=True):
                units.append((doc_id, tokens, start, np.frombuffer(ids, kind)))
                held += len(units[-1][3])
                if held >= shard_tokens:
                    flush(False)
                    yield sent()
        if units:
            flush(True)
            yield sent()

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (tokens, ids) in enumerate(zip(batch.column("tokens").to_pylist(), batch.column("ids"), strict=True)):
                ids = np.frombuffer(ids.as_buffer(), kind).astype("<u4")
                row = batch.slice(i, 1).column("doc_id").to_pylist()
                starts = np.arange(0, tokens - tokens % window, window)
                n = len(starts)
                for low in range(0, n, 1000):
                    some = starts[low : low + 1000]
                    pieces = pa.array([ids[s : s + window].tobytes() for s in some], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(row * len(some), id_type), pa.array(some), pa.array(np.full(len(some), window)), pieces, pa.array(np.full(len(some), tokens))], NAMES[:5])

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(rows.schema["doc_id"].dataType)
    schema = f"doc_id {id_kind}, start long, length long, ids binary, doc_tokens long"
    whole = rows.where(F.col("tokens") >= window).select("doc_id", "tokens", "ids").mapInArrow(own, schema)
    whole = whole.withColumn("sequence_id", F.lit(OWN_FIRST) + F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))

    start = F.col("tokens") - F.col("tokens") % window
    tails = rows.withColumn("start", start).where(F.col("start") < F.col("tokens"))
    tails = tails.select("doc_id", "row_no", "tokens", "start", *LEADS, F.expr(f"substring(ids, CAST(start * {width} + 1 AS INT))").alias("ids"))
    keys = [*LEADS, "row_no"]
    sorted_ = tails.repartitionByRange(shuffle_width(spark), *keys).sortWithinPartitions(*keys)
    filled = sorted_.select("doc_id", "tokens", "start", "ids").mapInArrow(pack, schema + ", sequence_id long, offset long")
    return filled.unionByName(whole)


NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


@query("op11_packing")
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2,048 tokens."""
    import public_tokenizers

    packed = packed_sequences(table(spark, sf_dir, "documents"), str(public_tokenizers.path("word_bpe_49k.json")))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
