import math
import random

import pytest
from pyspark.sql import functions as F

from tarnwork import fixed_values as fv
from tarnwork.ml import evaluate, features, split, training

YES_NO = ("No", "Yes")
SERVICE = ("No", "No internet service", "Yes")
VALUES = {
    "gender": ("Female", "Male"),
    "partner": YES_NO,
    "dependents": YES_NO,
    "phoneService": YES_NO,
    "multipleLines": ("No", "No phone service", "Yes"),
    "internetService": ("DSL", "Fiber optic", "No"),
    **dict.fromkeys(
        ("onlineSecurity", "onlineBackup", "deviceProtection", "techSupport", "streamingTV", "streamingMovies"), SERVICE
    ),
    "contract": ("Month-to-month", "One year", "Two year"),
    "paperlessBilling": YES_NO,
    "paymentMethod": ("Bank transfer (automatic)", "Credit card (automatic)", "Electronic check", "Mailed check"),
}


def customers(spark, n=60):
    rows = []
    for i in range(n):
        total = "null" if i == 5 else str(20.5 * i)
        rows.append(
            (f"id-{i}", i % 2, i, 20.5, total, "Yes" if i % 3 == 0 else "No", *[v[i % len(v)] for v in VALUES.values()])
        )
    head = "customerID string, seniorCitizen int, tenure int, monthlyCharges double, totalCharges string, churnString string"
    return spark.createDataFrame(rows, head + "".join(f", {c} string" for c in VALUES))


def test_churn_features(spark):
    made = features.churn_features(customers(spark))
    assert made.columns[:6] == ["customerID", "seniorCitizen", "tenure", "monthlyCharges", "totalCharges", "churn"]
    assert len(made.columns) == 47 and made.count() == 59
    assert made.columns[-4:] == [
        "paymentMethod_Banktransfer-automatic", "paymentMethod_Creditcard-automatic",
        "paymentMethod_Electroniccheck", "paymentMethod_Mailedcheck",
    ]
    types = dict(made.dtypes)
    assert types["churn"] == "int" and types["gender_Male"] == "bigint" and types["totalCharges"] == "double"
    row = made.where("customerID = 'id-3'").first()
    assert (row["churn"], row["gender_Female"], row["gender_Male"], row["totalCharges"]) == (1, 0, 1, 61.5)
    names = features.feature_columns(made)
    assert len(names) == 45
    # Data with fewer values gets the training data's columns.
    levels = features.category_levels(customers(spark), fv.CHURN_CATEGORIES)
    assert features.churn_features(customers(spark, 2), levels).columns == made.columns


def test_one_hot_edges(spark, rows):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id int, c string")
    assert rows(features.one_hot(df, ["c"])) == [(1, 0, 1), (2, 1, 0), (3, 0, 0)]
    first_out = features.one_hot(df, ["c"], {"c": ["a", "b"]}, drop_first=True)
    assert first_out.columns == ["id", "c_b"]
    assert rows(first_out) == [(1, 1), (2, 0), (3, 0)]
    with pytest.raises(ValueError, match="more than 1 values in c"):
        features.category_levels(df, ["c"], max_levels=1)


def test_impute_and_standardize(spark, rows):
    df = spark.createDataFrame([(1.0, 7.0), (None, 7.0), (5.0, 7.0)], "x double, same double")
    assert rows(features.impute_mean(df, ["x"]).select("x")) == [(1.0,), (3.0,), (5.0,)]
    other = spark.createDataFrame([(None, 1.0)], "x double, same double")
    assert features.impute_mean(other, ["x"], fitted_on=df).first()["x"] == 3.0
    scaled = features.standardize(df.na.drop(), ["x", "same"])
    assert rows(scaled) == [(-1.0, 0.0), (1.0, 0.0)]


@pytest.mark.parametrize("digits", [1, 4])
def test_split_sizes_are_exact(spark, digits):
    df = spark.range(1000).selectExpr("id", "if(id % 7 = 0, 1, if(id % 2 = 0, null, 0)) AS y")
    bounds = split.split_bounds(df, "y", ["id"], split.PARTS, 3, digits)
    assert bounds.count() == 3
    parts = split.stratified_split(df, "y", ["id"], seed=3)
    assert parts.count() == 1000
    for y, n in [tuple(r) for r in df.groupBy("y").count().collect()]:
        sizes = dict(map(tuple, parts.where(F.col("y").eqNullSafe(y)).groupBy("split").count().collect()))
        train, rest = math.floor(n * 0.6), math.floor(n * 0.8)
        assert sizes == {"train": train, "validation": rest - train, "test": n - rest}
    again = split.stratified_split(df.repartition(7), "y", ["id"], seed=3)
    assert again.exceptAll(parts).isEmpty()
    other = split.stratified_split(df, "y", ["id"], seed=4)
    assert not other.exceptAll(parts).isEmpty()


def test_split_keeps_copies_together(spark):
    df = spark.range(900).selectExpr("if(id < 300, 0, id) AS id", "1 AS y")
    parts = split.stratified_split(df, "y", ["id"])
    assert parts.groupBy("id").agg(F.countDistinct("split").alias("n")).where("n > 1").isEmpty()
    assert parts.count() == 900


def test_split_of_few_rows_and_other_parts(spark):
    df = spark.range(1).selectExpr("id", "1 AS y")
    assert split.stratified_split(df, "y", ["id"]).first()["split"] == "test"
    halves = split.stratified_split(spark.range(10).selectExpr("id", "1 AS y"), "y", ["id"], {"a": 1, "b": 1})
    assert dict(map(tuple, halves.groupBy("split").count().collect())) == {"a": 5, "b": 5}


def scored_rows(n=500, seed=1):
    r = random.Random(seed)
    return [(int(r.random() < 0.4), round(r.random(), 2)) for _ in range(n)]


def test_curves_against_counting(spark):
    data = scored_rows()
    df = spark.createDataFrame(data, "label int, probability double")
    p = sum(y for y, _ in data)
    n = len(data) - p
    roc = {r["threshold"]: (r["fpr"], r["tpr"]) for r in evaluate.roc_curve(df).collect()}
    pr = {r["threshold"]: (r["precision"], r["recall"]) for r in evaluate.pr_curve(df).collect()}
    for t in {s for _, s in data}:
        tp = sum(1 for y, s in data if y and s >= t)
        fp = sum(1 for y, s in data if not y and s >= t)
        assert roc[t] == (fp / n, tp / p)
        assert pr[t] == (tp / (tp + fp), tp / p)
    pairs = sum((a > b) + (a == b) / 2 for y, a in data if y for z, b in data if not z)
    assert evaluate.roc_auc(df).first()["roc_auc"] == pytest.approx(pairs / (p * n), abs=1e-12)


def test_metrics_against_counting(spark):
    data = [(y, p, int(p >= 0.5)) for y, p in scored_rows()]
    df = spark.createDataFrame(data, "label int, probability double, prediction int")
    row = evaluate.evaluate_classifier(df).first()
    tp = sum(y and d for y, _, d in data)
    fp = sum((not y) and d for y, _, d in data)
    fn = sum(y and not d for y, _, d in data)
    assert row["accuracy"] == (len(data) - fp - fn) / len(data)
    assert (row["precision"], row["recall"]) == (tp / (tp + fp), tp / (tp + fn))
    assert row["f1"] == pytest.approx(2 * tp / (2 * tp + fp + fn))
    clip = [min(max(p, 1e-15), 1 - 1e-15) for _, p, _ in data]
    loss = -sum(math.log(c if y else 1 - c) for (y, _, _), c in zip(data, clip)) / len(data)
    assert row["log_loss"] == pytest.approx(loss)
    matrix = {(r["label"], r["prediction"]): r["n"] for r in evaluate.confusion_matrix(df).collect()}
    assert (matrix[1, 1], matrix[0, 1], matrix[1, 0]) == (tp, fp, fn)


def test_one_class_only(spark):
    df = spark.createDataFrame([(1, 0.5, 1)], "label int, probability double, prediction int")
    assert evaluate.roc_auc(df).first()["roc_auc"] is None
    assert evaluate.evaluate_classifier(df).first()["precision"] == 1.0


@pytest.fixture(scope="module")
def trained(spark):
    df = spark.range(2000).selectExpr(
        "id", "cast(pmod(id * 37, 100) as double) AS `a.x`", "cast(pmod(id * 71, 13) as double) AS noise",
        "cast(pmod(id * 37, 100) >= 40 as int) AS churn",
    )
    df = df.withColumn("noise", F.when(F.col("id") % 50 != 0, F.col("noise")))
    parts = split.stratified_split(df, "churn", ["id"])
    train, validation, test = (parts.where(F.col("split") == p) for p in split.PARTS)
    grid = [{"maxIter": 1, "maxDepth": 0}, {"maxIter": 3, "maxDepth": 2}]
    model, params, f1 = training.tune(train, validation, ["a.x", "noise"], grid)
    return model, params, f1, test


def test_tuning_takes_the_best(trained):
    _, params, f1, _ = trained
    assert params["maxDepth"] == 2 and f1 > 0.95


def test_scoring_with_a_saved_model(spark, trained, tmp_path):
    model, _, _, test = trained
    path = str(tmp_path / "model")
    model.save(path)
    scored = training.batch_score(test, path, ["a.x", "noise"], ["id", "churn"])
    assert scored.columns == ["id", "churn", "prediction", "probability"]
    assert evaluate.evaluate_classifier(scored, "churn").first()["accuracy"] > 0.95
    assert scored.where("(probability > 0.5) != (prediction = 1)").isEmpty()


def test_importance(spark, trained):
    model, _, _, test = trained
    found = training.permutation_importance(test, model, ["a.x", "noise"], "churn", ["id"]).collect()
    assert [r["feature"] for r in found] == ["a.x", "noise"]
    assert found[0]["f1_drop"] > 0.2 and abs(found[1]["f1_drop"]) < 0.05
    assert training.tree_importance(model, ["a.x", "noise"])[0][0] == "a.x"


def test_moving_keeps_every_value(spark):
    df = spark.range(1000).selectExpr("id", "if(id % 10 = 0, null, id) AS v")
    moved = training.shuffle_features(df, ["v"], ["id"], groups=10)
    assert moved.select("v_moved").exceptAll(df.select("v")).isEmpty()
    assert moved.where("v <=> v_moved").count() < 50


def most_rows(df):
    """Rows of the largest partition, as Spark runs it."""
    return max(df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())


def test_no_training_task_gets_many_rows(spark, monkeypatch):
    df = spark.range(6000, numPartitions=1).selectExpr("cast(id % 7 as double) AS x", "cast(id % 7 > 3 as int) AS churn")
    seen, plain = [], training.Pipeline.fit
    monkeypatch.setattr(training.Pipeline, "fit", lambda self, rows: seen.append(rows) or plain(self, rows))
    rows = training.training_rows(df, df.limit(600), ["x"], "churn")
    training.fit(rows, ["x"], {"maxIter": 1, "maxDepth": 1}, rows_per_task=500)
    assert rows.count() == 6600 and seen[0].rdd.getNumPartitions() == 14 and most_rows(seen[0]) <= 1000


def test_groups_of_moved_values_grow_with_the_rows(spark):
    df = spark.range(4000).selectExpr("id", "id AS v")
    groups = training.groups_for(df, rows_per_group=40)
    moved = training.shuffle_features(df, ["v"], ["id"], groups=groups)
    assert (groups, training.groups_for(df)) == (100, 16) and moved.rdd.getNumPartitions() == 100 and most_rows(moved) <= 400
    assert moved.select("v_moved").exceptAll(df.select("v")).isEmpty()


def test_unscored_rows_are_refused(spark):
    rows = [(1, 0.9), (0, 0.1), (1, None), (1, float("nan"))]
    scored = spark.createDataFrame(rows, "label int, probability double")
    for curve in (evaluate.roc_curve, evaluate.pr_curve, evaluate.roc_auc):
        with pytest.raises(ValueError, match="2 rows have no score"):
            curve(scored)


def test_auc_per_split(spark):
    rows = [("a", 1, 0.9), ("a", 0, 0.1), ("a", 1, 0.05), ("b", 1, 0.5), ("b", 0, 0.5), (None, 1, 0.2)]
    scored = spark.createDataFrame(rows, "part string, label int, probability double").withColumn("prediction", F.lit(1))
    found = {r.part: r.roc_auc for r in evaluate.evaluate_classifier(scored, by="part", with_auc=True).collect()}
    assert found == {"a": 0.5, "b": 0.5, None: None}
    assert evaluate.evaluate_classifier(scored.where("part = 'a'"), with_auc=True).first().roc_auc == 0.5


def test_raw_requests_are_scored_without_a_label(spark, tmp_path):
    from tarnwork.ml import churn

    def record(i, value, total):
        return (f"c{i}", i % 2, i, float(i), total, "Yes" if value == "a" else "No", *[value] * len(fv.CHURN_CATEGORIES))

    names = ["customerID", "seniorCitizen", "tenure", "monthlyCharges", "totalCharges", "churnString", *fv.CHURN_CATEGORIES]
    raw = spark.createDataFrame([record(i, "abc"[i % 3], "null" if i % 7 == 0 else str(i)) for i in range(120)], names)
    path = str(tmp_path / "m")
    churn.save_churn_model(raw.where("tenure < 90"), raw.where("tenure >= 90"), path, {"maxIter": 3, "maxDepth": 2})
    requests = raw.drop("churnString").limit(9).union(spark.createDataFrame([record(500, "new", "12d")], names).drop("churnString"))
    found = {r.customerID: r.prediction for r in churn.score_churn(requests, path).collect()}
    assert found == {f"c{i}": float(i % 3 == 0) for i in range(9)} | {"c500": 0.0}


def test_auc_of_many_parts_at_once(spark):
    """Each part's area as if it were alone; parts without one class have none."""
    r = random.Random(8)
    data = [(f"p{r.randint(0, 30)}" if r.random() < 0.6 else None, r.randint(0, 1), round(r.random(), 1)) for _ in range(900)] + [("ones", 1, 0.5), ("zeros", 0, 0.5), ("zeros", 0, 0.6)]
    scored = spark.createDataFrame(data, "part string, label int, probability double")
    found = {x.part: x.roc_auc for x in evaluate.roc_auc(scored, by="part").collect()}
    assert len(found) == len({d[0] for d in data})
    for part, area in found.items():
        ones = [p for g, y, p in data if g == part and y == 1]
        zeros = [p for g, y, p in data if g == part and y == 0]
        if not ones or not zeros:
            assert area is None
            continue
        wins = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros)
        assert area == pytest.approx(wins / (len(ones) * len(zeros)), abs=1e-12)
