"""From raw customer records to scores: category values, means and trees kept together in one folder."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame

from tarnwork import fixed_values as fv
from tarnwork.ml.features import category_levels, churn_features, feature_columns
from tarnwork.ml.training import batch_score, train_classifier


def save_churn_model(train: DataFrame, validation: DataFrame, path: str, params: Mapping | None = None) -> None:
    """Fit on raw labelled records and store what scoring needs: the values of each category, the features' order and the model.

    Rows that lack a number are learned from too; the model fills in the mean.
    """
    levels = category_levels(train, fv.CHURN_CATEGORIES)
    frames = [churn_features(df, levels, keep_unknown=True) for df in (train, validation)]
    features = feature_columns(frames[0])
    train_classifier(*frames, features, "churn", params).save(f"{path}/model")
    inputs = json.dumps({"levels": levels, "features": features}, ensure_ascii=False)
    train.sparkSession.createDataFrame([(inputs,)], "value string").coalesce(1).write.text(f"{path}/inputs")


def score_churn(raw: DataFrame, path: str) -> DataFrame:
    """``customerID, prediction, probability`` for each raw record, labelled or not; none is dropped.

    A category value that training has not seen counts as none of the known ones.
    """
    inputs = json.loads(raw.sparkSession.read.text(f"{path}/inputs").first()[0])
    rows = churn_features(raw.drop("churnString"), inputs["levels"], keep_unknown=True)
    return batch_score(rows, f"{path}/model", inputs["features"], ["customerID"])
