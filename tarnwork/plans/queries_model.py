"""Features, splits, classifier metrics and review texts over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnwork import fixed_values as fv
from tarnwork.functions import text, text_models
from tarnwork.ml import churn, evaluate, features, split, training
from tarnwork.plans import driver_tables as dt
from tarnwork.plans.registry import query
from tarnwork.session import scratch_dir
from tarnwork.sources.tables import load_tables

STATUSES = ["F", "O", "P"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _flags_sql(columns: dict[str, list[str]], start: int = 0) -> str:
    cells = [(c, v) for c, vs in columns.items() for v in vs[start:]]
    return ", ".join(f"CAST({c} = '{v}' AS BIGINT) AS \"{c}_{v}\"" for c, v in cells)


ORDER_CATEGORIES = {"o_orderstatus": STATUSES, "o_orderpriority": PRIORITIES}


@query("one_hot", f"SELECT o_orderkey, {_flags_sql(ORDER_CATEGORIES)} FROM orders")
def one_hot(spark, d):
    orders = load_tables(spark, d, "orders")[0].select("o_orderkey", *ORDER_CATEGORIES)
    return features.one_hot(orders, list(ORDER_CATEGORIES))


@query("onehot_drop_first", f"SELECT o_orderkey, {_flags_sql(ORDER_CATEGORIES, 1)} FROM orders")
def onehot_drop_first(spark, d):
    orders = load_tables(spark, d, "orders")[0].select("o_orderkey", *ORDER_CATEGORIES)
    return features.one_hot(orders, list(ORDER_CATEGORIES), drop_first=True)


def _churn_raw(spark, d):
    """Customers with a segment for each category and a text number that is at times "null"."""
    customer = load_tables(spark, d, "customer")[0]
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    return customer.select(
        F.col("c_custkey").alias("customerID"),
        (balance > 5000).cast("int").alias("seniorCitizen"),
        F.col("c_nationkey").alias("tenure"),
        balance.alias("monthlyCharges"),
        F.when(segment == "BUILDING", "null").otherwise(F.col("c_custkey").cast("string")).alias("totalCharges"),
        F.when(balance > 2000, "Yes").otherwise("No").alias("churnString"),
        *[segment.alias(c) for c in fv.CHURN_CATEGORIES],
    )


CHURN_FLAGS = ", ".join(
    f"CAST(c_mktsegment = '{v}' AS BIGINT) AS \"{c}_{v}\"" for c in fv.CHURN_CATEGORIES for v in SEGMENTS
)


@query(
    "churn_features",
    f"""SELECT c_custkey AS "customerID", CAST(c_acctbal > 5000 AS INT) AS "seniorCitizen", c_nationkey AS tenure,
      c_acctbal AS "monthlyCharges", CAST(c_custkey AS DOUBLE) AS "totalCharges", CAST(c_acctbal > 2000 AS INT) AS churn, {CHURN_FLAGS}
    FROM customer WHERE c_mktsegment <> 'BUILDING'""",
)
def churn_features(spark, d):
    return features.churn_features(_churn_raw(spark, d))


@query(
    "churn_score",
    """SELECT c_custkey AS "customerID", CAST(c_mktsegment = 'BUILDING' AS DOUBLE) AS prediction,
      CAST(c_mktsegment = 'BUILDING' AS INT) AS rounded FROM customer""",
)
def churn_score(spark, d):
    """Raw requests without a label, some without a number, scored by a model that was saved with its preprocessing."""
    raw = _churn_raw(spark, d)
    known = raw.withColumn("churnString", F.when(F.col("gender") == "BUILDING", "Yes").otherwise("No"))
    held_out = F.pmod(F.xxhash64("customerID"), F.lit(4)) == 0
    path = scratch_dir(spark, "churn")
    churn.save_churn_model(known.where(~held_out), known.where(held_out), path, {"maxIter": 5, "maxDepth": 3})
    scored = churn.score_churn(raw.drop("churnString"), path)
    return scored.select("customerID", "prediction", F.round("probability").cast("int").alias("rounded"))


@query(
    "feature_select",
    """SELECT CAST(c_acctbal > 5000 AS INT) AS "seniorCitizen", c_nationkey AS tenure,
      CAST(c_mktsegment = 'FURNITURE' AS BIGINT) AS "gender_FURNITURE" FROM customer WHERE c_mktsegment <> 'BUILDING'""",
)
def feature_select(spark, d):
    made = features.churn_features(_churn_raw(spark, d))
    wanted = ["seniorCitizen", "tenure", "gender_FURNITURE"]
    return made.select(*[c for c in features.feature_columns(made) if c in wanted])


@query(
    "impute_mean",
    """WITH t AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'A' THEN l_quantity END AS q FROM lineitem)
    SELECT l_orderkey, l_linenumber, COALESCE(q, (SELECT AVG(q) FROM t)) AS q FROM t""",
)
def impute_mean(spark, d):
    quantity = F.when(F.col("l_returnflag") != "A", F.col("l_quantity")).alias("q")
    line = load_tables(spark, d, "lineitem")[0].select("l_orderkey", "l_linenumber", quantity)
    return features.impute_mean(line, ["q"])


@query(
    "standardize",
    """SELECT l_orderkey, l_linenumber, ROUND((l_quantity - (SELECT AVG(l_quantity) FROM lineitem))
      / (SELECT stddev_pop(l_quantity) FROM lineitem), 6) AS l_quantity FROM lineitem""",
)
def standardize(spark, d):
    line = load_tables(spark, d, "lineitem")[0].select("l_orderkey", "l_linenumber", "l_quantity")
    return features.standardize(line, ["l_quantity"]).withColumn("l_quantity", F.round("l_quantity", 6))


@query(
    "stratified_split",
    """WITH r AS (SELECT o_orderkey, o_orderstatus,
        row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5('7|' || CAST(o_orderkey AS VARCHAR))) - 1 AS rank,
        COUNT(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
    SELECT o_orderkey, o_orderstatus, CASE WHEN rank < floor(n * 60 / 100) THEN 'train'
      WHEN rank < floor(n * 80 / 100) THEN 'validation' ELSE 'test' END AS split FROM r""",
)
def stratified_split(spark, d):
    orders = load_tables(spark, d, "orders")[0].select("o_orderkey", "o_orderstatus")
    return split.stratified_split(orders, "o_orderstatus", ["o_orderkey"], seed=7)


@query("confusion_matrix", dt.SCORED_SQL, "SELECT label, prediction, COUNT(*) AS n FROM scored GROUP BY label, prediction")
def confusion_matrix(spark, d):
    return evaluate.confusion_matrix(dt.scored(spark, d))


CURVE_SQL = """curve AS (
  SELECT probability AS threshold, SUM(SUM(label)) OVER w AS tp, SUM(SUM(1 - label)) OVER w AS fp
  FROM scored GROUP BY probability
  WINDOW w AS (ORDER BY probability DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
  totals AS (SELECT SUM(label) AS p, SUM(1 - label) AS n FROM scored)"""


@query(
    "roc_curve",
    dt.SCORED_SQL,
    CURVE_SQL,
    "SELECT threshold, CAST(fp AS DOUBLE) / n AS fpr, CAST(tp AS DOUBLE) / p AS tpr FROM curve, totals",
)
def roc_curve(spark, d):
    return evaluate.roc_curve(dt.scored(spark, d))


@query(
    "pr_curve",
    dt.SCORED_SQL,
    CURVE_SQL,
    'SELECT threshold, CAST(tp AS DOUBLE) / (tp + fp) AS "precision", CAST(tp AS DOUBLE) / p AS recall FROM curve, totals',
)
def pr_curve(spark, d):
    return evaluate.pr_curve(dt.scored(spark, d))


@query(
    "roc_auc",
    dt.SCORED_SQL,
    """per_score AS (SELECT probability, SUM(label) AS pos, SUM(1 - label) AS neg FROM scored GROUP BY probability),
    summed AS (SELECT pos, neg, SUM(pos) OVER (ORDER BY probability DESC ROWS UNBOUNDED PRECEDING) AS tp FROM per_score)""",
    "SELECT CAST(SUM(neg * (2 * tp - pos)) AS DOUBLE) / (2.0::DOUBLE * SUM(pos) * SUM(neg)) AS roc_auc FROM summed",
)
def roc_auc(spark, d):
    return evaluate.roc_auc(dt.scored(spark, d))


@query(
    "evaluate_classifier",
    dt.SCORED_SQL,
    """c AS (SELECT split, COUNT(*) AS n_rows, COUNT(*) FILTER (label = prediction) AS hits,
      COUNT(*) FILTER (label = 1 AND prediction = 1) AS tp, SUM(label) AS p, SUM(prediction) AS pp,
      AVG(-ln(CASE WHEN label = 1 THEN probability ELSE 1 - probability END)) AS log_loss FROM scored GROUP BY split),
    per_score AS (SELECT split, probability, SUM(label) AS pos, SUM(1 - label) AS neg FROM scored GROUP BY split, probability),
    summed AS (SELECT split, pos, neg, SUM(pos) OVER (PARTITION BY split ORDER BY probability DESC ROWS UNBOUNDED PRECEDING) AS tp FROM per_score),
    areas AS (SELECT split, CAST(SUM(neg * (2 * tp - pos)) AS DOUBLE) / (2.0::DOUBLE * SUM(pos) * SUM(neg)) AS roc_auc FROM summed GROUP BY split)""",
    """SELECT split, n_rows, CAST(hits AS DOUBLE) / n_rows AS accuracy, CAST(tp AS DOUBLE) / pp AS "precision",
      CAST(tp AS DOUBLE) / p AS recall, 2 * CAST(tp AS DOUBLE) / (pp + p) AS f1, ROUND(log_loss, 9) AS log_loss, roc_auc FROM c JOIN areas USING (split)""",
)
def evaluate_classifier(spark, d):
    return evaluate.evaluate_classifier(dt.scored(spark, d), by="split", with_auc=True).withColumn("log_loss", F.round("log_loss", 9))


MODEL_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
#: The label follows from one feature of few values, so the trees must learn it exactly.
LABEL_RULE = "l_discount >= 0.045"
PERFECT_SQL = "SELECT l_linestatus AS split, TRUE AS learned, 1.0::DOUBLE AS accuracy, 1.0::DOUBLE AS f1, COUNT(*) AS n_rows FROM lineitem GROUP BY 1"


def _labelled(spark, d):
    """Whether a line is a bargain follows from its discount."""
    line = load_tables(spark, d, "lineitem")[0]
    rows = line.select("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", *MODEL_FEATURES, F.expr(LABEL_RULE).cast("int").alias("bargain"))
    return split.stratified_split(rows, "bargain", ["l_orderkey", "l_linenumber", "l_partkey"])


def _trained(spark, d):
    rows = _labelled(spark, d)
    parts = [rows.where(F.col("split") == p) for p in ("train", "validation")]
    return rows, training.train_classifier(*parts, MODEL_FEATURES, "bargain", {"maxIter": 5, "maxDepth": 4})


def _learned(scored):
    """Metrics per line status over all parts; exact ones alone."""
    metrics = evaluate.evaluate_classifier(scored, "bargain", by="l_linestatus")
    return metrics.select(F.col("l_linestatus").alias("split"), (F.col("f1") == 1).alias("learned"), "accuracy", "f1", "n_rows")


@query("train_classifier", PERFECT_SQL)
def train_classifier(spark, d):
    rows, model = _trained(spark, d)
    return _learned(training.batch_score(rows, model, MODEL_FEATURES, ["l_linestatus", "bargain"]))


@query("tune", PERFECT_SQL.replace("COUNT(*) AS n_rows", "COUNT(*) AS n_rows, CAST(1 AS INT) AS max_depth"))
def tune(spark, d):
    """The best of three depths on the validation part (the first of equals), with its metrics on all rows."""
    rows = _labelled(spark, d)
    parts = [rows.where(F.col("split") == p) for p in ("train", "validation")]
    grid = [{"maxIter": 3, "maxDepth": depth} for depth in (1, 3, 5)]
    model, params, _ = training.tune(*parts, MODEL_FEATURES, grid, "bargain")
    scored = training.batch_score(rows, model, MODEL_FEATURES, ["l_linestatus", "bargain"])
    return _learned(scored).withColumn("max_depth", F.lit(params["maxDepth"]))


@query(
    "batch_score",
    f"SELECT l_orderkey, l_linenumber, CAST({LABEL_RULE} AS DOUBLE) AS prediction, CAST({LABEL_RULE} AS INT) AS rounded FROM lineitem",
)
def batch_score(spark, d):
    """All rows scored by a model read back from where it was saved."""
    rows, model = _trained(spark, d)
    path = scratch_dir(spark, "model")
    model.save(path)
    scored = training.batch_score(rows, path, MODEL_FEATURES, ["l_orderkey", "l_linenumber"])
    return scored.withColumn("rounded", F.round("probability").cast("int")).drop("probability")


@query(
    "feature_importance",
    "SELECT * FROM (VALUES ('l_discount', TRUE), ('l_extendedprice', FALSE), ('l_quantity', FALSE), ('l_tax', FALSE)) AS t(feature, matters)",
)
def feature_importance(spark, d):
    rows, model = _trained(spark, d)
    held_out = rows.where("split = 'validation'")
    ids = ["l_orderkey", "l_linenumber", "l_partkey"]
    found = training.permutation_importance(held_out, model, MODEL_FEATURES, "bargain", ids)
    return found.select("feature", (F.col("f1_drop") > 0.05).alias("matters"))


# Review texts. The model is a local stand-in; the prompts are the real ones.

LABEL_WORDS = {"有": ["tion", "ment"], "品質": ["sch"], "the": ["the"]}
LABELS = [*LABEL_WORDS, "その他"]


def answer_table(spark, load):
    return text.AnswerTable(spark, scratch_dir(spark, "answers"), text.one_by_one(load))


@query(
    "ai_asked_once",
    """SELECT COUNT(*) AS n_rows, COUNT(DISTINCT text) AS asked, CAST(0 AS BIGINT) AS asked_again, COUNT(text) AS answered FROM documents""",
)
def ai_asked_once(spark, d):
    """Prompts put to the model for all reviews, copies among them, and by a second run over the same."""
    docs, table = load_tables(spark, d, "documents")[0].select("doc_id", "text"), answer_table(spark, text_models.sentence_picker(30))
    text.summarize_text(docs, "text", table)
    asked = table.known().count()
    again = text.summarize_text(docs, "text", table)
    counts = again.agg(F.count("*").alias("n_rows"), F.count("summary").alias("answered"))
    return counts.select("n_rows", F.lit(asked).alias("asked"), F.lit(table.known().count() - asked).alias("asked_again"), "answered")


@query(
    "ai_classify",
    """SELECT doc_id, CASE WHEN contains(text, 'tion') OR contains(text, 'ment') THEN '有' WHEN contains(text, 'sch') THEN '品質'
      WHEN contains(text, 'the') THEN 'the' ELSE 'その他' END AS category FROM documents""",
)
def ai_classify(spark, d):
    docs = load_tables(spark, d, "documents")[0].select("doc_id", "text")
    model = answer_table(spark, text_models.keyword_classifier(LABEL_WORDS, "その他"))
    return text.classify_text(docs, "text", model, LABELS).drop("text")


@query(
    "ai_summarize",
    """WITH s AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '[.!?。！？\n]+'), lambda x: trim(x, ' ')),
        lambda x: x <> '') AS parts FROM documents),
      p AS (SELECT doc_id, parts, list_filter(parts, lambda x: length(x) <= 30) AS fitting FROM s)
    SELECT doc_id, CASE WHEN len(fitting) > 0
        THEN list_filter(fitting, lambda x: length(x) = list_max(list_transform(fitting, lambda y: length(y))))[1]
      ELSE COALESCE(list_filter(parts, lambda x: length(x) = list_min(list_transform(parts, lambda y: length(y))))[1], '')
      END AS summary, CAST(length(summary) AS INT) AS summary_chars FROM p""",
)
def ai_summarize(spark, d):
    docs = load_tables(spark, d, "documents")[0].select("doc_id", "text")
    return text.summarize_text(docs, "text", answer_table(spark, text_models.sentence_picker(30))).drop("text")


@query(
    "ai_score",
    """WITH c AS (SELECT doc_id, (length(text) - length(replace(text, 'the', ''))) // 3 AS good,
        (length(text) - length(replace(text, 'un', ''))) // 2 AS bad FROM documents)
    SELECT doc_id, CAST(CASE WHEN good + bad = 0 THEN 50 ELSE (200 * good + good + bad) // (2 * (good + bad)) END / 100.0 AS FLOAT)
      AS positive_score FROM c""",
)
def ai_score(spark, d):
    docs = load_tables(spark, d, "documents")[0].select("doc_id", "text")
    return text.score_text(docs, "text", answer_table(spark, text_models.word_balance(["the"], ["un"]))).drop("text")


def strict_reader():
    """A model that cannot read texts with a line break. Nested functions travel to workers by value."""

    def load():
        def answer(prompt: str, review: str) -> str:
            if "\n" in review:
                raise ValueError("line break")
            return str(len(review))

        return answer

    return load


@query(
    "ai_fail_soft",
    """SELECT conv_id, turn, CASE WHEN contains(text, chr(10)) THEN NULL ELSE CAST(length(text) AS VARCHAR) END AS result,
      CASE WHEN contains(text, chr(10)) THEN 'ValueError: line break' END AS "errorMessage" FROM conversations""",
)
def ai_fail_soft(spark, d):
    turns = load_tables(spark, d, "conversations")[0]
    answer = text.ask(text.score_prompt("text"), F.col("text"), strict_reader()).alias("a")
    return turns.select("conv_id", "turn", answer).select("conv_id", "turn", "a.result", "a.errorMessage")


@query(
    "prompt_build",
    """SELECT item_id, 'Pick one.' || chr(10) || '[顧客レビュー]' || text || chr(10) || '[Labels]' || chr(10) || 'good' || chr(10) || 'bad' AS prompt
    FROM benchmark""",
)
def prompt_build(spark, d):
    items = load_tables(spark, d, "benchmark")[0]
    return items.select("item_id", text.build_prompt("text", "Pick one.", [("[Labels]", ["good", "bad"])]).alias("prompt"))
