import pytest
from pyspark.sql import functions as F

from tarnwork import fixed_values as fv
from tarnwork.functions import text, text_models


@pytest.fixture
def reviews(spark):
    texts = ["とても品質が良い。また買う", None, "店員が親切", ""]
    return spark.createDataFrame(list(enumerate(texts)), "id int, comment string")


def answers(df, column):
    return [r[column] for r in df.orderBy("id").collect()]


def test_prompt(reviews):
    prompt = answers(reviews.withColumn("p", text.classify_prompt("comment")), "p")
    assert prompt[1] is None
    lines = prompt[2].split("\n")
    assert lines[0].startswith("[指示]") and lines[1] == "[顧客レビュー]店員が親切"
    assert lines[2] == "[分類カテゴリ]" and lines[3:9] == fv.REVIEW_LABELS
    assert lines[9] == "[厳守事項]" and all(line.startswith(" * ") for line in lines[10:])
    summary = answers(reviews.withColumn("p", text.summarize_prompt("comment", 20)), "p")[2]
    assert "20文字以内" in summary and "30" not in summary
    assert "[出力形式]" in answers(reviews.withColumn("p", text.score_prompt("comment")), "p")[2]


def test_classify(reviews):
    load = text_models.keyword_classifier({"品質": ["品質"], "接客・サービス": ["店員"]}, "その他")
    assert answers(text.classify_text(reviews, "comment", load), "category") == ["品質", None, "接客・サービス", "その他"]
    # Only one of the given labels is taken for an answer.
    assert answers(text.classify_text(reviews, "comment", load, ["品質"]), "category") == ["品質", None, None, None]


def test_summarize(reviews):
    load = text_models.sentence_picker(9)
    assert answers(text.summarize_text(reviews, "comment", load, 9), "summary") == ["とても品質が良い", None, "店員が親切", ""]

    def long():
        return lambda prompt, review: "x" * 99

    assert answers(text.summarize_text(reviews, "comment", long), "summary")[0] == "x" * 99
    assert text_models.sentence_picker(3)()("", "abcdef. abcde") == "abcde"


def test_score(reviews):
    load = text_models.word_balance(["良い", "親切"], ["悪い"])
    found = text.score_text(reviews, "comment", load)
    assert dict(found.dtypes)["positive_score"] == "float"
    assert answers(found, "positive_score") == [1.0, None, 1.0, 0.5]
    assert text_models.word_balance(["a"], ["b"])()("", "abbbbbbb") == "0.13"

    def words():
        return lambda prompt, review: "pretty good"

    assert answers(text.score_text(reviews, "comment", words), "positive_score") == [None] * 4


def failing():
    def answer(prompt, review):
        if "店員" in review:
            raise RuntimeError("no answer")
        return "ok"

    return lambda: answer


def test_a_failing_row(reviews):
    found = reviews.withColumn("a", text.ask(text.score_prompt("comment"), F.col("comment"), failing()))
    assert [tuple(a) for a in answers(found, "a")] == [("ok", None), (None, None), (None, "RuntimeError: no answer"), ("ok", None)]
    with pytest.raises(Exception, match="no answer"):
        text.score_text(reviews, "comment", failing(), on_error="raise").collect()
    with pytest.raises(ValueError):
        text.ask(F.lit(""), F.lit(""), failing(), "ignore")


def test_the_model_is_loaded_once_per_task(spark, tmp_path):
    log = str(tmp_path / "loads")

    def load():
        with open(log, "a") as f:
            f.write("x")
        return lambda prompt, review: "0.5"

    df = spark.range(1000).repartition(2).selectExpr("id", "cast(id as string) AS comment")
    assert text.score_text(df, "comment", load).where("positive_score = 0.5").count() == 1000
    with open(log) as f:
        assert len(f.read()) == 2


def noting(log, fail=()):
    """A model for several prompts that notes each review it is asked."""

    def load():
        def answers(pairs):
            if any(review in fail for _, review in pairs):
                raise RuntimeError("no answer")
            with open(log, "a") as f:
                f.writelines(f"{review}\n" for _, review in pairs)
            return [f"{len(prompt)}:{review}" for prompt, review in pairs]

        return answers

    return load


def test_each_prompt_is_asked_once(spark, tmp_path):
    log, path = tmp_path / "log", str(tmp_path / "answers")
    df = spark.createDataFrame([(i, ["same", "other", None, "rare"][min(i % 5, 2) if i else 3]) for i in range(200)], "id int, comment string")
    frame = text.prompt_frame("Do.", [("[Form]", ["short"])])
    table = text.AnswerTable(spark, path, noting(log), batch=2)
    found = {(r.comment, r._answer and r._answer.result) for r in table.ask(df, "comment", frame).collect()}
    size = len("".join(frame))
    assert found == {(c, f"{size + len(c)}:{c}") for c in ("same", "other", "rare")} | {(None, None)}
    assert sorted(log.read_text().split()) == ["other", "rare", "same"]
    # The same again, and one that is new; another frame makes other prompts.
    more = df.union(spark.createDataFrame([(999, "new")], df.schema))
    assert text.AnswerTable(spark, path, noting(log)).ask(more, "comment", frame).count() == 201
    assert sorted(log.read_text().split()) == ["new", "other", "rare", "same"]
    table.ask(df, "comment", text.prompt_frame("Do otherwise.", []))
    assert len(log.read_text().split()) == 7


def test_failures_are_noted_and_asked_again(spark, tmp_path):
    log, path = tmp_path / "log", str(tmp_path / "answers")
    df = spark.createDataFrame([(i, c) for i, c in enumerate(["a", "bad", "b", "bad", "c"])], "id int, comment string").coalesce(1)
    frame = text.prompt_frame("Do.", [])
    first = text.AnswerTable(spark, path, noting(log, {"bad"}), 8).ask(df, "comment", frame)
    assert {r.comment: r._answer.errorMessage for r in first.collect()} == {"a": None, "b": None, "c": None, "bad": "RuntimeError: no answer"}
    with pytest.raises(Exception, match="no answer"):
        text.AnswerTable(spark, path, noting(log, {"bad"})).ask(df, "comment", frame, on_error="raise")
    second = text.AnswerTable(spark, path, noting(log)).ask(df, "comment", frame)
    assert second.where("_answer.result IS NULL").count() == 0 and second.count() == 5
    assert sorted(log.read_text().split()) == ["a", "b", "bad", "c"]


def test_labels_and_scores_by_an_answer_table(reviews, spark, tmp_path):
    load = text.one_by_one(text_models.keyword_classifier({"品質": ["品質"], "接客・サービス": ["店員"]}, "その他"))
    table = text.AnswerTable(spark, str(tmp_path / "labels"), load)
    assert answers(text.classify_text(reviews, "comment", table), "category") == ["品質", None, "接客・サービス", "その他"]
    scores = text.AnswerTable(spark, str(tmp_path / "scores"), text.one_by_one(text_models.word_balance(["良い", "親切"], ["悪い"])))
    assert answers(text.score_text(reviews, "comment", scores), "positive_score") == [1.0, None, 1.0, 0.5]


def test_a_model_that_answers_too_few(spark, tmp_path):
    def load():
        return lambda pairs: ["x"] * min(len(pairs), 1)

    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, comment string").coalesce(1)
    found = text.AnswerTable(spark, str(tmp_path / "t"), load).ask(df, "comment", ("", ""))
    assert [r._answer.result for r in found.collect()] == ["x", "x"]
