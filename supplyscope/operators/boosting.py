"""Multinomial gradient boosting on MLlib trees (MLD6).

Each round fits one regression tree per class to the softmax gradients, weighted
by the second derivatives (a Newton step), on the margins of the rounds before.
Trees are kept as flat arrays: a model scores a batch of rows by indexing, and
is stored as one parquet row per tree.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyscope.session import written

NODE = re.compile(r"(?:(If|Else) \(feature (\d+) (<=|>) (\S+)\)|Predict: (\S+))")
TREE = "round int, class int, feature array<int>, threshold array<double>, left array<int>, right array<int>, value array<double>"
#: Rounds whose trees are applied on the fly before margins are written again.
WRITE_EVERY = 10
#: Bounds on a second derivative and on a Newton target.
LEAST_WEIGHT, MOST_TARGET = 1e-6, 4.0


def flat_tree(text: str) -> dict:
    """A tree from MLlib's description: parallel arrays by node; a leaf has
    feature -1 and its value."""
    lines = [m.groups() for m in NODE.finditer(text)]
    tree: dict = {"feature": [], "threshold": [], "left": [], "right": [], "value": []}

    def node(i: int) -> tuple[int, int]:
        """(node, next line) of the subtree described from line ``i`` on."""
        kind, feature, _, threshold, value = lines[i]
        me = len(tree["feature"])
        for k, x in (("feature", -1), ("threshold", 0.0), ("left", -1), ("right", -1), ("value", 0.0)):
            tree[k].append(x)
        if kind is None:
            tree["value"][me] = float(value)
            return me, i + 1
        tree["feature"][me], tree["threshold"][me] = int(feature), float(threshold)
        tree["left"][me], i = node(i + 1)
        tree["right"][me], i = node(i + 1)  # after the line of Else
        return me, i
    node(0)
    return tree


def leaf_values(tree: dict, x: np.ndarray) -> np.ndarray:
    """The tree's value for each row of features."""
    feature, threshold = np.array(tree["feature"]), np.array(tree["threshold"])
    left, right, value = np.array(tree["left"]), np.array(tree["right"]), np.array(tree["value"])
    at = np.zeros(len(x), np.int64)
    while (inner := np.flatnonzero(feature[at] >= 0)).size:
        n = at[inner]
        at[inner] = np.where(x[inner, feature[n]] <= threshold[n], left[n], right[n])
    return value[at]


def added(trees: list[dict], classes: int, rate: float, features: Column, margins: Column | None = None) -> Column:
    """Margins of each row with the trees' shares added."""
    @F.pandas_udf("array<double>")
    def run(x: pd.Series, before: pd.Series) -> pd.Series:
        rows = np.stack(x.to_numpy()) if len(x) else np.zeros((0, 1))
        out = np.stack(before.to_numpy()).astype(float) if len(x) else np.zeros((0, classes))
        for t in trees:
            out[:, t["class"]] += rate * leaf_values(t, rows)
        return pd.Series(list(out))
    return run(features, margins if margins is not None else F.array(*[F.lit(0.0)] * classes))


class Boosted:
    """A fitted model: margins, probabilities and class of rows."""

    def __init__(self, features: list[str], classes: int, rate: float, trees: list[dict]):
        self.features, self.classes, self.rate, self.trees = list(features), classes, rate, trees

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``probability`` (array) and ``prediction`` (the class, the
        smaller one of equals, a double)."""
        x = F.array(*[F.col(c).cast("double") for c in self.features])
        out = df.withColumn("_m", added(self.trees, self.classes, self.rate, x))
        top = F.array_max("_m")
        exps = F.transform("_m", lambda m: F.exp(m - top))
        total = F.aggregate(exps, F.lit(0.0), lambda a, e: a + e)
        return out.withColumns({"probability": F.transform(exps, lambda e: e / total),
                                "prediction": (F.array_position("_m", top) - 1).cast("double")}).drop("_m")

    def save(self, spark: SparkSession, path: str) -> str:
        rows = [(t["round"], t["class"], t["feature"], t["threshold"], t["left"], t["right"], t["value"]) for t in self.trees]
        spark.createDataFrame(rows, TREE).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
        spark.createDataFrame([(self.features, self.classes, self.rate, len(rows))],
                              "features array<string>, classes int, rate double, trees int").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> Boosted:
        m = spark.read.parquet(f"{path}/model").first()
        trees = [r.asDict() for r in spark.read.parquet(f"{path}/trees").orderBy("round", "class").collect()]
        if m is None or len(trees) != m.trees:
            raise ValueError(f"the model at {path} is incomplete")
        return Boosted(m.features, m.classes, m.rate, trees)


def boost(df: DataFrame, features, label: str, classes: int, rounds: int = 100, depth: int = 4, rate: float = 0.1,
          seed: int = 42, least_weight: float = 1.0) -> Boosted:
    """Fit ``rounds`` x ``classes`` trees of ``depth`` on numeric columns and a
    class code 0 .. classes-1.

    Rows are stored once with their margins, again every few rounds.  The
    trees of a round don't depend on each other and are fitted side by side; a
    leaf's weights (second derivatives) are at least ``least_weight`` in all.
    Rounds end early when no class's gradients can be split any more.  The
    driver holds the trees only: at most rounds x classes x 2^(depth+1) nodes."""
    vector = VectorAssembler(inputCols=list(features), outputCol="features")
    x = F.array(*[F.col(c).cast("double") for c in features])
    zero = F.array(*[F.lit(0.0)] * classes)
    rows = vector.transform(df).select("features", x.alias("x"), F.col(label).cast("int").alias("y"), zero.alias("m"))
    # the same rows in the same places, so that sums and so splits repeat
    state = written(rows.repartition("x", "y").sortWithinPartitions("x", "y"), "boost")
    trees: list[dict] = []
    fresh: list[dict] = []
    for r in range(rounds):
        if len(fresh) >= WRITE_EVERY * classes:
            state, fresh = written(state.withColumn("m", added(fresh, classes, rate, F.col("x"), F.col("m"))), "boost"), []
        now = state.withColumn("m", added(fresh, classes, rate, F.col("x"), F.col("m"))) if fresh else state
        exps = F.transform("m", lambda m: F.exp(m - F.array_max("m")))
        total = F.aggregate(exps, F.lit(0.0), lambda a, e: a + e)
        now = now.withColumn("p", F.transform(exps, lambda e: e / total)).persist()

        def fit(k: int, rows=now, r=r) -> dict:
            p = F.col("p")[k]
            h = F.greatest(p * (1 - p), F.lit(LEAST_WEIGHT))
            z = F.greatest(F.least(((F.col("y") == k).cast("double") - p) / h, F.lit(MOST_TARGET)), F.lit(-MOST_TARGET))
            data = rows.select("features", z.alias("z"), h.alias("h"))
            whole, pull = data.agg(F.sum("h"), F.sum(F.col("z") * F.col("h"))).first()
            if not whole or whole < 2 * least_weight:
                value = pull / whole if whole else 0.0
                return {"feature": [-1], "threshold": [0.0], "left": [-1], "right": [-1], "value": [value], "class": k, "round": r}
            tree = DecisionTreeRegressor(featuresCol="features", labelCol="z", weightCol="h", maxDepth=depth, seed=seed,
                                         minWeightFractionPerNode=min(0.49, least_weight / whole))
            return {**flat_tree(tree.fit(data).toDebugString), "class": k, "round": r}

        with ThreadPoolExecutor(classes) as pool:
            found = list(pool.map(fit, range(classes)))
        now.unpersist()
        trees, fresh = trees + found, fresh + found
        if all(len(t["feature"]) == 1 for t in found):
            break
    return Boosted(features, classes, rate, trees)
