"""Boosted trees and the forecast's trend changes."""

import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from supplyscope.operators import models
from supplyscope.operators.boosting import Boosted, boost, flat_tree, leaf_values


@pytest.fixture(scope="module")
def points(spark):
    df = spark.range(500).select("id", *[((F.col("id") * m) % 997 / 997.0).alias(n) for n, m in (("a", 131), ("b", 577), ("c", 311))])
    y = F.when(F.col("a") + F.col("b") > 1.2, 2).when((F.col("c") > 0.5) & (F.col("a") < 0.7), 1).otherwise(0)
    return df.withColumn("y", y)


def test_boosting_beats_one_tree_and_repeats(spark, points):
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler
    train, test = points.where("id % 5 <> 0"), points.where("id % 5 = 0")
    model = boost(train, ["a", "b", "c"], "y", 3, rounds=12, depth=3)
    out = model.transform(test)
    assert out.where(F.abs(F.aggregate("probability", F.lit(0.0), lambda a, p: a + p) - 1) > 1e-9).count() == 0
    right = out.where("prediction = y").count()
    vec = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features")
    tree = DecisionTreeClassifier(labelCol="y", featuresCol="features", maxDepth=3, seed=42).fit(vec.transform(train))
    assert right >= tree.transform(vec.transform(test)).where("prediction = y").count() and right >= 85
    again = boost(train.repartition(5).orderBy("c"), ["a", "b", "c"], "y", 3, rounds=3, depth=3)
    assert again.trees == model.trees[:9]
    path = tempfile.mkdtemp(prefix="supplyscope-boost-", dir="/tmp")
    model.save(spark, path)
    same = Boosted.load(spark, path)
    assert same.trees == model.trees and same.features == model.features
    assert sorted(map(str, same.transform(test).collect())) == sorted(map(str, out.collect()))


def test_boosting_of_one_class_ends(spark, points):
    model = boost(points.withColumn("y", F.lit(1)).limit(5), ["a", "b"], "y", 3, rounds=50)
    assert len(model.trees) < 150
    assert model.transform(points.limit(5)).where("prediction <> 1").count() == 0


def test_incomplete_model_raises(spark):
    path = tempfile.mkdtemp(prefix="supplyscope-boost-", dir="/tmp")
    leaf = {"feature": [-1], "threshold": [0.0], "left": [-1], "right": [-1], "value": [1.0], "round": 0, "class": 0}
    Boosted(["a"], 1, 0.1, [leaf, leaf]).save(spark, path)
    spark.createDataFrame([(["a"], 1, 0.1, 3)], "features array<string>, classes int, rate double, trees int").write.mode("overwrite").parquet(f"{path}/model")
    with pytest.raises(ValueError, match="incomplete"):
        Boosted.load(spark, path)


def test_flat_tree():
    text = """DecisionTreeRegressionModel: uid=x, depth=2, numNodes=5, numFeatures=2
  If (feature 0 <= 1.5)
   Predict: -1.0E-4
  Else (feature 0 > 1.5)
   If (feature 1 <= -2.0)
    Predict: 2.0
   Else (feature 1 > -2.0)
    Predict: 3.0
"""
    x = np.array([[1.5, 0], [1.6, -2.0], [9, 5]])
    assert leaf_values(flat_tree(text), x).tolist() == [-1e-4, 2.0, 3.0]


def weekly(y, start="2015-01-05"):
    return pd.DataFrame({"product_name": "p", "ds": pd.date_range(start, periods=len(y), freq="7D").date, "y": y})


def straight(pdf, weeks=8):
    """Forecast of one line through the whole history."""
    t = np.arange(len(pdf))
    slope, base = np.polyfit(t, pdf["y"], 1)
    return base + slope * (len(pdf) - 1 + np.arange(weeks) + 6 / 7)


def test_trend_follows_a_known_break():
    rng = np.random.default_rng(3)
    t = np.arange(160.0)
    truth = 50 + 1.5 * t - 3.5 * np.maximum(t - 90, 0)
    pdf = weekly(truth + rng.normal(0, 2, len(t)) + 200)
    out = models._fit_one(pdf, 8, 20, 3)
    want = 250 + 1.5 * (159 + np.arange(8) + 6 / 7) - 3.5 * (159 + np.arange(8) + 6 / 7 - 90)
    error, plain = np.abs(out["yhat"] - want).mean(), np.abs(straight(pdf) - want).mean()
    assert len(out) == 8 and error < 0.15 * plain
    assert (np.diff(out["ci"]) >= 0).all() and out["ci"].iloc[-1] > out["ci"].iloc[0]
    assert (out["yhat"] == out["yhat"].round(1)).all()
    assert str(out["ds"].iloc[0]) == "2018-01-28" and pd.Timestamp(out["ds"].iloc[1]) - pd.Timestamp(out["ds"].iloc[0]) == pd.Timedelta(days=7)


def test_straight_series_keeps_its_line():
    rng = np.random.default_rng(4)
    pdf = weekly(100 + 2.0 * np.arange(60) + rng.normal(0, 1, 60))
    out = models._fit_one(pdf, 8, 20, 3)
    assert np.abs(out["yhat"] - straight(pdf)).max() < 4


def test_odd_series():
    assert models._fit_one(weekly([1.0] * 19), 8, 20, 3).empty
    flat = models._fit_one(weekly([5.0] * 30), 8, 20, 3)
    assert flat["yhat"].between(4.9, 5.1).all()
    assert models._fit_one(weekly([0.0] * 30), 8, 20, 3)["yhat"].eq(0).all()
    one_day = weekly([3.0] * 25)
    one_day["ds"] = one_day["ds"].iloc[0]
    assert len(models._fit_one(one_day, 8, 20, 3)) == 8
    assert (models._fit_one(weekly(np.maximum(60 - 2.0 * np.arange(40), 0)), 8, 20, 3)["yhat"] >= 0).all()
