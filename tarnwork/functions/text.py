"""Review texts put to a text model: one label, one short sentence, one score.

The model comes from the caller as ``load() -> answer(prompt, text)``, asked row by row, or as an ``AnswerTable``,
which asks several prompts at a time and each distinct one once. It is loaded once per Python worker and its answers travel
in Arrow batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarnwork import fixed_values as fv

Answer = Callable[[str, str], str]
Load = Callable[[], Answer]


def build_prompt(text: Column | str, task: str, sections: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """Task, review and headed lines; NULL for a missing review."""
    review = F.col(text) if isinstance(text, str) else text
    head, tail = prompt_frame(task, sections)
    return F.concat(F.lit(head), review, F.lit(tail))


def prompt_frame(task: str, sections: Sequence[tuple[str, Sequence[str]]]) -> tuple[str, str]:
    """What stands before the review in a prompt, and behind it."""
    return f"{task}\n{fv.REVIEW_HEADING}", "".join("\n" + line for heading, lines in sections for line in (heading, *lines))


def _bullets(lines: Sequence[str]) -> list[str]:
    return [f" * {line}" for line in lines]


def _classify(labels: Sequence[str]) -> tuple:
    return fv.CLASSIFY_TASK, [(fv.CLASSIFY_HEADING, labels), (fv.RULES_HEADING, _bullets(fv.CLASSIFY_RULES))]


def _summarize(max_chars: int) -> tuple:
    return fv.SUMMARIZE_TASK, [(fv.RULES_HEADING, _bullets([r.replace("30", str(max_chars)) for r in fv.SUMMARIZE_RULES]))]


def _score() -> tuple:
    return fv.SCORE_TASK, [(fv.SCORE_HEADING, _bullets(fv.SCORE_FORMAT)), (fv.RULES_HEADING, _bullets(fv.SCORE_RULES))]


def classify_prompt(text: Column | str, labels: Sequence[str] = fv.REVIEW_LABELS) -> Column:
    return build_prompt(text, *_classify(labels))


def summarize_prompt(text: Column | str, max_chars: int = 30) -> Column:
    return build_prompt(text, *_summarize(max_chars))


def score_prompt(text: Column | str) -> Column:
    return build_prompt(text, *_score())


def ask(prompt: Column, text: Column, load: Load, on_error: str = "null") -> Column:
    """``struct<result, errorMessage>`` per row.

    With ``on_error="null"`` a row whose answer fails gets a NULL result and
    the error text; with ``"raise"`` it fails the job. A NULL prompt is not asked.

    A model need not answer twice the same, so the answers count as not
    deterministic: a filter on them does not make Spark ask again.
    """
    if on_error not in ("null", "raise"):
        raise ValueError("on_error is 'null' or 'raise'")

    @F.pandas_udf("result string, errorMessage string")
    def answers(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        model = load()

        def one(prompt_text, review):
            if prompt_text is None:
                return None, None
            try:
                return str(model(prompt_text, review)), None
            except Exception as e:
                if on_error == "raise":
                    raise
                return None, f"{type(e).__name__}: {e}"

        for prompts, reviews in batches:
            yield pd.DataFrame(map(one, prompts, reviews), columns=["result", "errorMessage"], dtype=object)

    return answers.asNondeterministic()(prompt, text)


Answers = Callable[[Sequence[tuple[str, str]]], Sequence[str]]


def one_by_one(load: Load) -> Callable[[], Answers]:
    """A model that answers one prompt at a time, as one that takes several."""

    def load_all() -> Answers:
        model = load()
        return lambda pairs: [model(prompt, review) for prompt, review in pairs]

    return load_all


class AnswerTable:
    """Answers of one model, kept by the digest of their prompt, so that each prompt is asked once however often it comes.

    ``load() -> answers(pairs of prompt and review)`` is called once per Python worker and gets up to ``batch`` prompts
    that have no answer yet. A batch that fails is asked again one by one; what fails then has no result, is noted with its error and
    asked anew by the next call. Answers are appended to Parquet files under ``path``; another model needs another path.
    """

    def __init__(self, spark: SparkSession, path: str, load: Callable[[], Answers], batch: int = 32) -> None:
        self.spark, self.path, self.load, self.batch = spark, path, load, batch

    def known(self) -> DataFrame:
        """``digest, result, errorMessage, run`` of all answers and failures so far."""
        try:
            return self.spark.read.schema(ANSWER_DDL).parquet(self.path)
        except AnalysisException:
            return self.spark.createDataFrame([], ANSWER_DDL)

    def ask(self, df: DataFrame, text: str, frame: tuple[str, str], name: str = "_answer", on_error: str = "null") -> DataFrame:
        """``df`` with a struct ``result, errorMessage``, for the prompts that the frame and each text make; NULL texts are not asked.

        Reviews travel to the model without the frame, once for each distinct one.
        """
        if on_error not in ("null", "raise"):
            raise ValueError("on_error is 'null' or 'raise'")
        (head, tail), load, batch, run = frame, self.load, self.batch, uuid.uuid4().hex
        digest = F.sha2(F.concat(F.lit(head), F.col(text), F.lit(tail)), 256)
        digested = df.withColumn("_digest", digest)
        reviews = digested.where(F.col(text).isNotNull()).select(F.col("_digest").alias("digest"), F.col(text).alias("review")).distinct()
        unseen = reviews.join(self.known().where("errorMessage IS NULL").select("digest"), "digest", "left_anti")

        def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = None
            for rows in batches:
                model = model or load()
                for low in range(0, rows.num_rows, batch):
                    some = rows.slice(low, batch)
                    pairs = [(head + r + tail, r) for r in some.column("review").to_pylist()]
                    results, errors = [], [None] * len(pairs)
                    try:
                        results = [str(x) for x in model(pairs)]
                        if len(results) != len(pairs):
                            raise ValueError(f"{len(pairs)} prompts, {len(results)} answers")
                    except Exception:
                        if on_error == "raise":
                            raise
                        results = []
                        for i, pair in enumerate(pairs):
                            try:
                                results.append(str(model([pair])[0]))
                            except Exception as e:
                                results.append(None)
                                errors[i] = f"{type(e).__name__}: {e}"
                    columns = [some.column("digest"), pa.array(results, pa.string()), pa.array(errors, pa.string()), pa.array([run] * len(pairs))]
                    yield pa.RecordBatch.from_arrays(columns, ["digest", "result", "errorMessage", "run"])

        unseen.mapInArrow(answer, ANSWER_DDL).write.mode("append").parquet(self.path)
        # An older failure that was asked again counts as what this run made of it.
        answers = self.known().where(F.col("errorMessage").isNull() | (F.col("run") == run)).select(F.col("digest").alias("_of"), F.struct("result", "errorMessage").alias(name))
        return digested.join(answers, digested["_digest"] == answers["_of"], "left").drop("_digest", "_of")


ANSWER_DDL = "digest string, result string, errorMessage string, run string"
Model = Load | AnswerTable


def _with_answer(df: DataFrame, text: str, model: Model, frame: tuple, name: str, on_error: str) -> DataFrame:
    """The model's result as column ``name``."""
    if isinstance(model, AnswerTable):
        return model.ask(df, text, prompt_frame(*frame), "_answer", on_error).withColumn(name, F.col("_answer.result")).drop("_answer")
    return df.withColumn(name, ask(build_prompt(text, *frame), F.col(text), model, on_error)["result"])


def classify_text(
    df: DataFrame,
    text: str,
    load: Model,
    labels: Sequence[str] = fv.REVIEW_LABELS,
    name: str = "category",
    on_error: str = "null",
) -> DataFrame:
    """Add one of the labels per row; an answer that is none of them is NULL."""
    answered = _with_answer(df, text, load, _classify(labels), name, on_error).withColumn(name, F.trim(name))
    return answered.withColumn(name, F.when(F.col(name).isin(*labels), F.col(name)))


def summarize_text(
    df: DataFrame, text: str, load: Model, max_chars: int = 30, name: str = "summary", on_error: str = "null"
) -> DataFrame:
    """Add one sentence, for which the prompt asks for at most ``max_chars`` characters, and its length ``<name>_chars``.

    The answer is kept whole, also where the model was not brief.
    """
    return _with_answer(df, text, load, _summarize(max_chars), name, on_error).withColumn(f"{name}_chars", F.length(name))


def score_text(
    df: DataFrame, text: str, load: Model, name: str = "positive_score", on_error: str = "null"
) -> DataFrame:
    """Add a FLOAT between 0 and 1; an answer that is not a number is NULL."""
    return _with_answer(df, text, load, _score(), name, on_error).withColumn(name, F.col(name).try_cast("float"))
