"""Language identification by error-correcting output codes over byte n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import col, table
from tarnwork.llm.registry import query
from tarnwork.session import limit_batches, settle

DIMENSIONS = 8192
UNDETERMINED = "und"
#: What a letter is, always asked in the JVM, for learning, prediction and the pipeline alike: signs and numbers such as ½ or Ⅷ are none.
LETTER = r"\p{L}"
#: ASCII bytes that are no letters become spaces; bytes of other letters stay.
SPACED = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
#: Multipliers of the hash per n-gram length (odd 32-bit numbers).
MIX = {1: 0x9E3779B1, 2: 0x85EBCA77, 3: 0xC2B2AE3D}
SHIFT = np.uint32(32 - 13)


def features(text: str) -> np.ndarray:
    """Unit vector of square roots of hashed byte 1- to 3-gram counts of the whole text."""
    raw = np.frombuffer(b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(SPACED).split()) + b" ", np.uint8).astype(np.uint32)
    counts = np.zeros(DIMENSIONS, np.int64)
    for n, factor in MIX.items():
        if len(raw) >= n:
            gram = raw[: len(raw) - n + 1].copy()
            for k in range(1, n):
                gram = (gram << np.uint32(8)) | raw[k : len(raw) - n + 1 + k]
            counts += np.bincount((gram * np.uint32(factor)) >> SHIFT, minlength=DIMENSIONS)
    vector = np.sqrt(counts, dtype=np.float32)
    return vector / np.float32(np.linalg.norm(vector) or 1)


def codebook(classes: int, seed: int = 11) -> np.ndarray:
    """Codewords of -1 and 1, a row for each class: all splits for few classes, else the best spread of random ones."""
    if classes <= 7:
        width = max(1, 2 ** (classes - 1) - 1)
        splits = [[1] * width] + [[1 if (number >> k) & 1 else -1 for number in range(width)] for k in range(classes - 1)]
        return np.array(splits[:classes], np.float32)
    width, rng = 15 * int(np.ceil(np.log2(classes))) // 2, np.random.default_rng(seed)
    books = (rng.choice(np.array([-1, 1], np.float32), (classes, width)) for _ in range(200))  # one at a time, as languages may be many

    def nearest(book: np.ndarray) -> float:
        alike = book @ book.T
        np.fill_diagonal(alike, -width)
        return alike.max() + 1000 * (np.abs(book.sum(0)) == classes).sum()

    return min(books, key=nearest)


@dataclass(frozen=True)
class Model:
    """``weights`` and ``bias`` of a classifier per bit; ``trust`` weighs bit j for class i in the loss."""

    classes: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Trust-weighted logistic loss of each row against each codeword."""
        bits = x @ self.weights + self.bias
        return np.einsum("cl,ncl->nc", self.trust, np.logaddexp(0, -bits[:, None, :] * self.codes[None]))


def fit(texts: list[str], langs: list[str], steps: int = 150, rate: float = 0.3, penalty: float = 1e-6) -> Model | None:
    """Logistic regressions for all bits at once, by Adam on the whole sample; None without a language."""
    classes = sorted(set(langs))
    if not classes:
        return None
    x = np.stack([features(t) for t in texts])
    label = np.searchsorted(classes, langs)
    codes = codebook(len(classes))
    wanted = codes[label]
    share = (1 / np.bincount(label))[label][:, None] / len(classes)  # every language weighs the same
    w, b = np.zeros((DIMENSIONS, codes.shape[1]), np.float32), np.zeros(codes.shape[1], np.float32)
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
    for step in range(1, steps + 1):
        pull = (-wanted * share / (1 + np.exp(np.clip(wanted * (x @ w + b), -30, 30)))).astype(np.float32)
        for k, (value, slope) in enumerate(((w, x.T @ pull + penalty * w), (b, pull.sum(0)))):
            first, second = moments[2 * k], moments[2 * k + 1]
            first += 0.1 * (slope - first)
            second += 0.01 * (slope * slope - second)
            value -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    right = (x @ w + b) * wanted > 0
    trust = np.stack([right[label == c].mean(0) for c in range(len(classes))]).astype(np.float32) + 1e-6
    return Model(classes, codes, w, b, trust / trust.sum(1, keepdims=True))


def train(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_language: int = 300,
    max_rows: int = 3_000,
    max_chars: int = 50_000,
    least_rows: int = 30,
) -> Model | None:
    """Fit on a sample: about ``rows_per_language`` different texts of every language, or all there are, chosen by a hash of the text, so that reruns agree.

    With many languages each gives fewer, so that they are ``max_rows`` in all, but no fewer than ``least_rows``. Of a text over
    ``max_chars`` characters that many are learned from, from its first letter on.
    Rows without a text, a language or a letter are not learned from; copies of a text count once.
    """
    rows = df.select(col(text_col).alias("text"), col(lang_col).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(LETTER))
    stretch = F.regexp_extract("text", rf"(?s)\p{{L}}.{{0,{max_chars - 1}}}", 0)
    rows = rows.withColumn("text", F.when(F.length("text") <= max_chars, F.col("text")).otherwise(stretch))
    digests = rows.select("lang", F.xxhash64("text").alias("digest")).distinct()  # copies count once, here as in the sample
    counts = [tuple(r) for r in digests.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()]
    if not counts:
        return None
    wanted = min(rows_per_language, max(least_rows, max_rows // len(counts)))
    bounds = df.sparkSession.createDataFrame([(lang, min(1.0, wanted / n)) for lang, n in counts], "lang string, bound double")
    bounds = settle(bounds, "languages")  # read back it has a size, so that Spark can broadcast it and leave the texts where they are
    chance = F.pmod(F.xxhash64("text", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.join(bounds, "lang").where(chance < F.col("bound")).select("text", "lang").distinct().orderBy(F.xxhash64("text"), "lang").collect()
    return fit([r.text for r in sample], [r.lang for r in sample])


def identifier(spark: SparkSession, model: Model | None, margin: float = 0.15, batch: int = 128):
    """A function from a text column to a struct ``lang, score, ambiguous, fits``.

    The language is that of the codeword with the least loss; ``score`` is its share of exp(-loss) over
    all codewords, sharpened by the code's width; ``ambiguous`` marks texts whose second codeword's
    loss is nearer than ``margin`` times the sum of both, and ``fits`` those whose bits agree with the
    codeword better than coins would (a loss under ln 2). A text that is NULL or has no
    letter, or any text without a model, is ``und`` with score 0, ambiguous, and fits nothing.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, ambiguous boolean, fits boolean")
    def identify(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in parts:
            n = len(texts)
            lang, score, vague, fits = np.full(n, UNDETERMINED, object), np.zeros(n), np.ones(n, bool), np.zeros(n, bool)
            known = [i for i, t in enumerate(texts) if m and t]
            for start in range(0, len(known), batch):
                rows = known[start : start + batch]
                loss = m.losses(np.stack([features(texts.iloc[i]) for i in rows]))
                order = np.argsort(loss, 1, kind="stable")
                best = np.take_along_axis(loss, order[:, :1], 1)
                odds = np.exp(-(loss - best) * m.codes.shape[1])
                fits[rows] = best[:, 0] < np.log(2)
                lang[rows] = np.array(m.classes, object)[order[:, 0]]
                score[rows] = 1 / odds.sum(1)
                if len(m.classes) > 1:
                    second = np.take_along_axis(loss, order[:, 1:2], 1)
                    vague[rows] = ((second - best) < margin * (second + best))[:, 0]
                else:
                    vague[rows] = False
            yield pd.DataFrame({"lang": lang, "score": score, "ambiguous": vague, "fits": fits})

    return lambda text: identify(F.when(text.rlike(LETTER), text))


def held_out(doc_id: Column) -> Column:
    """A quarter of all ids, kept from learning; a NULL id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def identify_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``id, held_out, lang_pred, score, ambiguous`` per row, learned from the rows that are not held out.

    Empty tables give no rows, repeated rows equal answers; other columns are ignored. Leaves the session with
    small batches for Python workers, as the rows are computed later.
    """
    limit_batches(df.sparkSession)
    learn = df.where(~held_out(col(id_col)))
    identify = identifier(df.sparkSession, train(learn, text_col, lang_col))
    rows = df.select(col(id_col).alias(id_col), held_out(col(id_col)).alias("held_out"), identify(col(text_col)).alias("found"))
    return rows.select(id_col, "held_out", F.col("found.lang").alias("lang_pred"), "found.score", "found.ambiguous")


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents."""
    return identify_documents(table(spark, sf_dir, "documents"))
