"""Model jobs as table transforms (MLD1-8).

Exact forms (checked against SQL):
  * delivery score = late rate of the order's shipping mode (AGG21), 4 dp;
  * inventory class = the stock-status rule the label was made from (MLD6b);
  * demand forecast = per-product linear trend from aggregates (MLD4b).
Learned forms (rows checks): random forest by histograms, MLlib decision tree, and a
per-product least-squares trend + yearly-season fit in ``applyInPandas``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplyscope.functions.columns import dec_round, hash_id, status_code
from supplyscope.operators.boosting import Boosted, boost
from supplyscope.operators.forest import Forest, grow
from supplyscope.operators.ranks import first_rows
from supplyscope.operators.sampling import ITEM_KEY, hash_key, train_test_split
from supplyscope.schemas import PREDICTIONS, conform
from supplyscope.session import written

# Fixed values.
DELIVERY_FEATURES = ["shipping_mode_enc", "days_scheduled", "market_enc", "customer_segment_enc",
                     "department_enc", "quantity", "sales", "discount_rate", "order_month",
                     "order_dayofweek"]
INVENTORY_FEATURES = ["simulated_stock", "avg_daily_demand", "days_remaining", "reorder_threshold",
                      "total_sold", "avg_per_order", "product_price"]
INVENTORY_LABELS = {0: "safe", 1: "low", 2: "critical"}
FOREST_PARAMETERS = {"num_trees": 100, "max_depth": 10, "seed": 42}
BOOST_PARAMETERS = {"rounds": 100, "depth": 4, "rate": 0.1, "seed": 42}
LATE_THRESHOLD = 0.60
FORECAST_WEEKS = 8
MIN_HISTORY = 20
# Two-sided 80 % normal band: 2 x 1.2816 standard deviations.
BAND_Z = 1.2815515655446004


def _label_of(code) -> F.Column:
    m = F.create_map(*[x for k, v in INVENTORY_LABELS.items() for x in (F.lit(k), F.lit(v))])
    return m[code]


# ------------------------------------------------------------------ delivery

def mode_late_rates(features: DataFrame) -> DataFrame:
    """AGG21: late share per shipping mode (4 rows)."""
    return features.groupBy("shipping_mode").agg(
        F.avg("late_delivery_risk").alias("late_rate"), F.count(F.lit(1)).alias("orders"))


def rate_of_mode(rates: DataFrame, rate: str, mode) -> F.Column:
    """A mode's rate, looked up in a map that is one scalar subquery.

    The map has one entry per shipping mode (a fixed domain of four), so the
    lines are neither shuffled nor joined on a few-valued key."""
    one = rates.where(F.col("shipping_mode").isNotNull()).select(
        F.map_from_entries(F.collect_list(F.struct("shipping_mode", rate))).alias("m"))
    return F.element_at(one.scalar(), mode)


def delivery_rule_scores(features: DataFrame) -> DataFrame:
    """Late probability of each order line = its mode's late rate, 4 dp."""
    rates = mode_late_rates(features).select("shipping_mode", dec_round("late_rate", 4).alias("late_prob"))
    return features.withColumn("late_prob", rate_of_mode(rates, "late_prob", F.col("shipping_mode")))


def delivery_predictions(scored: DataFrame, run_ts: str, prob_col: str = "late_prob",
                         floor: float = LATE_THRESHOLD, top: int | None = None) -> DataFrame:
    """FLT7 + SNK6 rows: every score >= floor, in the predictions schema.

    ``top`` (TOP3) keeps only the highest scores (ties by item order), found by
    thresholds (``first_rows``); stored predictions are never cut."""
    p = F.col(prob_col)
    best = scored.where(p >= floor)
    if top is not None:
        keys = [-p, F.col("item_seq.order_id"), F.col("item_seq.line_number")]
        best = first_rows(best, keys, [p.desc(), F.col("item_seq").asc()], top)
    out = best.select(
        hash_id(F.lit("delivery"), *ITEM_KEY).alias("id"),
        F.lit(run_ts).alias("created_at"),
        F.lit("delivery").alias("prediction_type"),
        F.lit(None).cast("string").alias("product_name"),
        F.col("order_id"),
        p.alias("predicted_value"), p.alias("confidence_score"),
        F.lit("late").alias("label"))
    return conform(out, PREDICTIONS)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k x n_class) of a 0/1 label as ``weight``: one
    aggregate and a two-way choice, no join."""
    n = df.select(F.struct(F.count_if(F.col(label) == 0).cast("double").alias("zero"),
                           F.count_if(F.col(label) == 1).cast("double").alias("one")).alias("n")).scalar()
    k = F.greatest(F.lit(1), (n["zero"] > 0).cast("int") + (n["one"] > 0).cast("int"))
    own = F.when(F.col(label) == 1, n["one"]).otherwise(n["zero"])
    return df.withColumn("weight", (n["zero"] + n["one"]) / (k * own))


def split_lines(encoded: DataFrame, seed: int = 42) -> DataFrame:
    """SMP3: the features, label and ``draw`` (md5 of key and seed) of the lines
    with every feature and a label, ceil(20 %) of each class with ``is_test`` = 1.

    Stored, as counts, fit and report read them; a line's draw is made once."""
    lines = encoded.dropna(subset=DELIVERY_FEATURES + ["late_delivery_risk"]).select(
        *DELIVERY_FEATURES, "late_delivery_risk", F.unhex(hash_key(seed, *ITEM_KEY)).alias("draw"))
    return train_test_split(written(lines, "forest-lines", "zstd"), 0.2, seed, draw=F.lower(F.hex("draw")))


def train_delivery_forest(encoded: DataFrame, num_trees: int = 100, max_depth: int = 10,
                          seed: int = 42) -> tuple[Forest, DataFrame]:
    """MLD1: random forest with balanced class weights on the training side of
    the hash split.  Returns (model, split frame with ``is_test``)."""
    data = split_lines(encoded, seed)
    train = data.where("is_test = 0")
    weights = class_weights(train.select("late_delivery_risk"), "late_delivery_risk").distinct().collect()
    model = grow(train, DELIVERY_FEATURES, "late_delivery_risk", "draw", {r.late_delivery_risk: r.weight for r in weights}, num_trees, max_depth, seed)
    return model, data


def top_drivers(model, names=DELIVERY_FEATURES, k: int = 3) -> list[tuple[str, float]]:
    """MLD2: the ``k`` most important features and their percent."""
    imp = zip(names, model.featureImportances.toArray().tolist())
    best = sorted(imp, key=lambda x: (-x[1], x[0]))[:k]
    return [(n.removesuffix("_enc").replace("_", " "), round(v * 100, 1)) for n, v in best]


def score_delivery(model, encoded: DataFrame) -> DataFrame:
    """MLD2: probability of late for every line (training rows included),
    rounded to 4 dp, with the late/on_time label at 0.60 and the model's top
    drivers (label -> percent)."""
    out = model.transform(encoded.dropna(subset=DELIVERY_FEATURES))
    prob = dec_round("probability", 4)
    return out.withColumn("late_prob", prob).withColumn(
        "pred_label", F.when(F.col("late_prob") >= LATE_THRESHOLD, "late").otherwise("on_time")
    ).withColumn("drivers", F.create_map(*[F.lit(x) for d in top_drivers(model) for x in d])).drop("probability")


def save_model(model, path: str) -> str:
    """MLD8: persist a fitted model (any Hadoop filesystem)."""
    if isinstance(model, Forest):
        return model.save(SparkSession.active(), path)
    model.write().overwrite().save(path)
    return path


def load_forest(path: str):
    """MLD8: reload a saved delivery forest."""
    return Forest.load(SparkSession.active(), path)


def load_tree(path: str):
    """MLD8: reload a saved inventory tree."""
    from pyspark.ml.classification import DecisionTreeClassificationModel
    return DecisionTreeClassificationModel.load(path)


def feature_importances(spark, model, names=DELIVERY_FEATURES) -> DataFrame:
    """MLD3 + WIN6: importances with readable labels, ranked, percent.

    The vector has one entry per feature (bounded by the model), so it is
    read on the driver and returned as a small frame."""
    from pyspark.sql import Window
    imp = model.featureImportances.toArray().tolist()
    rows = [(n, n.removesuffix("_enc").replace("_", " "), float(v)) for n, v in zip(names, imp)]
    df = spark.createDataFrame(rows, "feature string, label string, importance double")
    w = Window.orderBy(F.desc("importance"), F.asc("feature"))
    return df.withColumns({"rank": F.row_number().over(w),
                           "percent": dec_round(F.col("importance") * 100, 1)})


# ------------------------------------------------------------------ inventory

def inventory_rule_predictions(inventory: DataFrame, run_ts: str) -> DataFrame:
    """MLD6b + MLD7: class code from the status rule (0 safe, 1 low,
    2 critical), one prediction row per product."""
    code = status_code("status")
    out = inventory.select(
        hash_id(F.lit("inventory"), "product_name").alias("id"),
        F.lit(run_ts).alias("created_at"),
        F.lit("inventory").alias("prediction_type"),
        "product_name",
        F.lit(None).cast("bigint").alias("order_id"),
        code.cast("double").alias("predicted_value"),
        F.lit(None).cast("double").alias("confidence_score"),
        _label_of(code).alias("label"))
    return conform(out, PREDICTIONS)


def split_products(inventory: DataFrame, seed: int = 42, test_fraction: float = 0.2) -> DataFrame:
    """Adds ``is_test``: 1 for ceil(``test_fraction`` x n) products, by hash."""
    return train_test_split(inventory, test_fraction, seed, ("product_name",), None)


def train_inventory_tree(inventory: DataFrame, seed: int = 42, max_depth: int = 4):
    """MLD6: decision tree on the 7 inventory features (zero-filled).  Rows
    with ``is_test`` = 1, if the column is there, are left out."""
    if "is_test" in inventory.columns:
        inventory = inventory.where("is_test = 0")
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler

    data = inventory.fillna(0, subset=INVENTORY_FEATURES).withColumn("status_enc", status_code("status"))
    vec = VectorAssembler(inputCols=INVENTORY_FEATURES, outputCol="features")
    dt = DecisionTreeClassifier(labelCol="status_enc", featuresCol="features", maxDepth=max_depth,
                                seed=seed)
    return dt.fit(vec.transform(data))


def delivery_held_out(model, data: DataFrame) -> DataFrame:
    """MLD1 + AGG24: the classification report of the split's test side."""
    from supplyscope.operators.reports import classification_report
    scored = score_delivery(model, data.where("is_test = 1"))
    return classification_report(scored.withColumn("_p", (F.col("pred_label") == "late").cast("int")), "late_delivery_risk", "_p")


def train_inventory_boosted(inventory: DataFrame, **parameters) -> Boosted:
    """MLD6: boosted trees for the three stock classes on the 7 inventory
    features (zero-filled).  Rows with ``is_test`` = 1, if the column is there,
    are left out."""
    if "is_test" in inventory.columns:
        inventory = inventory.where("is_test = 0")
    data = inventory.fillna(0, subset=INVENTORY_FEATURES).withColumn("status_enc", status_code("status"))
    return boost(data, INVENTORY_FEATURES, "status_enc", len(INVENTORY_LABELS), **(parameters or BOOST_PARAMETERS))


def _classified(model, inventory: DataFrame) -> DataFrame:
    """Products with the model's class as ``prediction``."""
    data = inventory.fillna(0, subset=INVENTORY_FEATURES)
    if isinstance(model, Boosted):
        return model.transform(data)
    from pyspark.ml.feature import VectorAssembler
    return model.transform(VectorAssembler(inputCols=INVENTORY_FEATURES, outputCol="features").transform(data))


def inventory_held_out(model, split: DataFrame) -> DataFrame:
    """MLD6 + AGG24: the classification report of the products held out."""
    from supplyscope.operators.reports import classification_report
    out = _classified(model, split.where("is_test = 1").withColumn("_y", status_code("status")))
    return classification_report(out.withColumn("_p", F.col("prediction").cast("int")), "_y", "_p")


def inventory_model_predictions(model, inventory: DataFrame, run_ts: str) -> DataFrame:
    """MLD7 with a learned model."""
    code = F.col("prediction").cast("int")
    res = _classified(model, inventory).select(
        hash_id(F.lit("inventory"), "product_name").alias("id"), F.lit(run_ts).alias("created_at"),
        F.lit("inventory").alias("prediction_type"), "product_name",
        F.lit(None).cast("bigint").alias("order_id"), code.cast("double").alias("predicted_value"),
        F.lit(None).cast("double").alias("confidence_score"), _label_of(code).alias("label"))
    return conform(res, PREDICTIONS)


# ------------------------------------------------------------------ demand

def _week_index(ds) -> F.Column:
    """Weeks since Monday 1970-01-05 (a double, integral on Mondays)."""
    return F.datediff(ds, F.lit("1970-01-05").cast("date")).cast("double") / 7.0


def linear_forecast(series: DataFrame, key: str = "product_name", y: str = "weekly_qty",
                    ds: str = "ds", weeks: int = FORECAST_WEEKS,
                    min_rows: int = MIN_HISTORY) -> DataFrame:
    """MLD4b: per key, least-squares line through (week index, y) from
    aggregates only (regr_slope / regr_intercept / var_pop), residual
    band from the residual population variance, ``weeks`` weekly steps on
    the Sundays after the last ds.  Keys with fewer than ``min_rows``
    rows are skipped (FLT10).  One shuffle: the per-key aggregate.
    """
    x = _week_index(F.col(ds))
    fit = (series.withColumn("_x", x).withColumn("_y", F.col(y).cast("double"))
           .groupBy(key).agg(
               F.count(F.lit(1)).alias("_n"),
               F.regr_slope("_y", "_x").alias("_b"),
               F.regr_intercept("_y", "_x").alias("_a"),
               F.var_pop("_y").alias("_vy"), F.var_pop("_x").alias("_vx"),
               F.avg("_y").alias("_my"),
               F.max(ds).alias("_last"))
           .where(F.col("_n") >= min_rows))
    steps = fit.withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(weeks))))
    fds = F.date_add(F.col("_last"), (F.lit(6) + (F.col("_k") - 1) * 7).cast("int"))
    steps = steps.withColumn("_fds", fds)
    b = F.coalesce(F.col("_b"), F.lit(0.0))
    yhat = F.coalesce(F.col("_a"), F.col("_my")) + b * _week_index(F.col("_fds"))
    resid_var = F.greatest(F.col("_vy") - b * b * F.col("_vx"), F.lit(0.0))
    band = F.lit(2 * BAND_Z) * F.sqrt(resid_var)
    return steps.select(
        F.col(key), F.col("_fds").alias("ds"),
        dec_round(F.greatest(yhat, F.lit(0.0)), 1).alias("yhat"),
        dec_round(F.greatest(band, F.lit(0.0)), 1).alias("ci"))


def demand_predictions(forecast: DataFrame, run_ts: str, key: str = "product_name") -> DataFrame:
    """Forecast rows in the predictions schema (label = ISO week date)."""
    out = forecast.select(
        hash_id(F.lit("demand"), key, "ds").alias("id"),
        F.lit(run_ts).alias("created_at"),
        F.lit("demand").alias("prediction_type"),
        F.col(key).alias("product_name"),
        F.lit(None).cast("bigint").alias("order_id"),
        F.col("yhat").alias("predicted_value"),
        F.col("ci").alias("confidence_score"),
        F.date_format("ds", "yyyy-MM-dd").alias("label"))
    return conform(out, PREDICTIONS)


FORECAST_SCHEMA = T.StructType([
    T.StructField("product_name", T.StringType()),
    T.StructField("ds", T.DateType()),
    T.StructField("yhat", T.DoubleType()),
    T.StructField("ci", T.DoubleType()),
])


#: Trend of the forecast: places where the slope may change, in the first part
#: of the history, and the scale of the (double exponential) prior of a change.
CHANGEPOINTS, CHANGE_RANGE, CHANGE_PRIOR = 25, 0.8, 0.1
#: Days of history from which on a yearly season is fitted.
SEASON_DAYS = 730


class TrendFit:
    """A piecewise-linear trend whose slope changes are shrunken, plus yearly
    Fourier terms, by penalised least squares.

    Time runs from 0 to 1 over the history and values are divided by their
    largest.  The prior of a slope change is double exponential: solved as a
    ridge whose weights follow the changes found so far, so that most shrink to
    nothing and the few that the data ask for stay."""

    def __init__(self, days: np.ndarray, y: np.ndarray, harmonics: int, prior: float):
        self.first, self.span = days.min(), max(float(np.ptp(days)), 1.0)
        self.scale = max(float(np.abs(y).max()), 1e-9)
        self.harmonics = harmonics if np.ptp(days) >= SEASON_DAYS else 0
        t = np.unique(days)
        inner = t[1:max(2, int(np.ceil(CHANGE_RANGE * len(t))))]
        count = min(CHANGEPOINTS, len(inner)) if len(t) > 2 else 0
        places = inner[np.round(np.linspace(0, len(inner) - 1, count)).astype(int)] if count else np.zeros(0)
        self.changes = (np.unique(places) - self.first) / self.span
        x, goal, k = self.design(days), y / self.scale, len(self.changes)
        gram, right = x.T @ x, x.T @ goal
        noise, change = float(np.var(goal)) + 1e-9, np.full(k, prior)
        for _ in range(30):
            weight = np.concatenate([np.full(2, 1 / 25.0), 1 / (prior * np.maximum(change, 1e-5)), np.full(x.shape[1] - 2 - k, 1 / 100.0)])
            self.coef = np.linalg.solve(gram + np.diag(noise * weight + 1e-12), right)
            change = np.abs(self.coef[2:2 + k])
            noise = max(float(np.mean((goal - x @ self.coef) ** 2)), 1e-9)
        self.noise, self.mean_change = noise, float(change.mean()) if k else 0.0

    def design(self, days: np.ndarray) -> np.ndarray:
        t = (days - self.first) / self.span
        cols = [np.ones_like(t), t, *(np.maximum(t - c, 0.0) for c in self.changes)]
        for k in range(1, self.harmonics + 1):
            angle = 2 * math.pi * k * days / 365.25
            cols += [np.sin(angle), np.cos(angle)]
        return np.column_stack(cols)

    def forecast(self, days: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value and width of the 80 % band.  Beyond the history the slope may
        go on changing as often and as much as it did: over a time h that adds
        a variance of (changes a unit of time) x 2 (mean change)^2 x h^3 / 3."""
        ahead = np.maximum((days - self.first) / self.span - 1.0, 0.0)
        spread = self.noise + len(self.changes) * 2 * self.mean_change ** 2 * ahead ** 3 / 3
        return self.design(days) @ self.coef * self.scale, 2 * BAND_Z * np.sqrt(spread) * self.scale


def _fit_one(pdf: pd.DataFrame, weeks: int, min_rows: int, harmonics: int, prior: float = CHANGE_PRIOR) -> pd.DataFrame:
    """One product's forecast; too short a history gives none."""
    pdf = pdf.dropna(subset=["ds", "y"])
    if len(pdf) < min_rows:
        return pd.DataFrame(columns=["product_name", "ds", "yhat", "ci"])
    ds = pd.to_datetime(pdf["ds"])
    zero, last = pd.Timestamp("1970-01-05"), ds.max()
    fit = TrendFit((ds - zero).dt.days.to_numpy(dtype=float), pdf["y"].to_numpy(dtype=float), harmonics, prior)
    fds = [last + pd.Timedelta(days=6 + 7 * i) for i in range(weeks)]
    yhat, band = fit.forecast(np.array([(d - zero).days for d in fds], dtype=float))
    return pd.DataFrame({
        "product_name": pdf["product_name"].iloc[0],
        "ds": [d.date() for d in fds],
        "yhat": np.round(np.maximum(yhat, 0.0), 1),
        "ci": np.round(np.maximum(band, 0.0), 1),
    })


def seasonal_forecast(series: DataFrame, key: str = "product_name", y: str = "weekly_qty",
                      ds: str = "ds", weeks: int = FORECAST_WEEKS, min_rows: int = MIN_HISTORY,
                      harmonics: int = 3, prior: float = CHANGE_PRIOR) -> DataFrame:
    """MLD4: per-product trend with slope changes and yearly season
    (``TrendFit``) in ``applyInPandas``; ``prior`` is the scale of a change.

    Input is already aggregated to weekly rows, so a group holds at most
    (weeks x categories x markets) rows of one product — bounded however
    large the order table grows.  Spark hash-partitions the products over
    the executors; Arrow moves the batches."""
    data = series.select(F.col(key).alias("product_name"), F.col(ds).alias("ds"),
                         F.col(y).cast("double").alias("y"))
    return data.groupBy("product_name").applyInPandas(
        lambda pdf: _fit_one(pdf, weeks, min_rows, harmonics, prior), FORECAST_SCHEMA)


def next_week_forecast(demand_preds: DataFrame) -> DataFrame:
    """JON1: each product's forecast row at its smallest week label
    (predictions joined to their per-product minimum; ties kept)."""
    d = demand_preds.where(F.col("prediction_type") == "demand")
    first = d.groupBy("product_name").agg(F.min("label").alias("label"))
    return d.join(first, ["product_name", "label"])
