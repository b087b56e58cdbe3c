"""Table maintenance (SNK1-13).

Two layers:
  * functional forms, DataFrame in -> DataFrame out (upsert, keyed alert
    replace, group replace, resolve, delete, freshness) — checked against
    SQL;
  * ``TableStore``: tables of Spark's catalog, written with ``INSERT``.
    Alerts are partitioned by (agent, category) and replaced with dynamic
    partition overwrite.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyscope.schemas import TABLE_SCHEMAS, conform
from supplyscope.session import staged, written
from supplyscope.sources.tables import table_exists

PARTITIONS = {"alerts": ("agent", "category")}
RESOLUTIONS = "id long, created_at string"


# ------------------------------------------------------------------ functional forms

def latest_per_key(df: DataFrame, keys, order_col: str) -> DataFrame:
    """Last write wins inside a batch: the row with the greatest
    ``order_col`` per key (one aggregate, no global sort)."""
    others = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(order_col)).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def upsert(base: DataFrame, new: DataFrame, keys, order_col: str | None = None) -> DataFrame:
    """SNK4: replace rows of ``base`` whose key appears in ``new``; add the
    rest of ``new``.  ``order_col`` (if given) picks the last of several
    new rows per key and is dropped."""
    if order_col:
        new = latest_per_key(new, keys, order_col).drop(order_col)
    return base.join(new.select(*keys), list(keys), "left_anti").unionByName(new.select(*base.columns))


def alert_key(df: DataFrame) -> DataFrame:
    """SNK7 key: order id when set and non-zero, else product name when
    non-empty, else the message."""
    by_order = F.col("order_id").isNotNull() & (F.col("order_id") != 0)
    by_product = F.col("product_name").isNotNull() & (F.col("product_name") != "")
    return df.withColumns({
        "key_kind": F.when(by_order, "order").when(by_product, "product").otherwise("message"),
        "key_value": F.when(by_order, F.col("order_id").cast("string"))
                      .when(by_product, F.col("product_name")).otherwise(F.col("message")),
    })


def insert_alerts_keyed(base: DataFrame, new: DataFrame, order_col: str) -> DataFrame:
    """SNK7: for each new alert, delete stored alerts of the same agent and
    category that share its key field (order id, else product, else
    message), then insert.  Among several new alerts with one key the last
    one (greatest ``order_col``, the batch sequence) wins.  Deletion is three anti-joins
    of the alerts whose agent and category the batch has; those groups are few and
    sent to the alerts, so that the others aren't shuffled.  The batch is stored once."""
    k = alert_key(new)
    k = written(latest_per_key(k, ["agent", "category", "key_kind", "key_value"], order_col), "keyed-alerts", "zstd")
    groups = F.broadcast(k.select("agent", "category").distinct())
    out = base.join(groups, ["agent", "category"], "left_semi").select(base.columns)
    for kind, col in (("order", "order_id"), ("product", "product_name"), ("message", "message")):
        keys = (k.where(F.col("key_kind") == kind)
                .select("agent", "category", F.col("key_value").alias("_kv")).distinct())
        cond = ((out["agent"] == keys["agent"]) & (out["category"] == keys["category"])
                & (out[col].cast("string") == keys["_kv"]))
        out = out.join(keys, cond, "left_anti")
    others = base.join(groups, ["agent", "category"], "left_anti")
    return out.unionByName(others.select(base.columns)).unionByName(k.select(*base.columns))


def replace_alert_groups(base: DataFrame, new: DataFrame) -> DataFrame:
    """SNK8: every (agent, category) present in ``new`` is replaced whole;
    an empty batch changes nothing.  Groups are as few as agents and
    categories, so they are sent to the alerts, which aren't shuffled on them."""
    groups = new.select("agent", "category").distinct()
    return base.join(F.broadcast(groups), ["agent", "category"], "left_anti").unionByName(new.select(*base.columns))


def resolve(alerts: DataFrame, resolutions: DataFrame) -> DataFrame:
    """SNK10: ``is_resolved`` = 1 for alerts listed in ``resolutions``, by id
    and, if given, created_at: a resolution of one run leaves the same alert
    of a later run open."""
    r = resolutions.select(*[F.col(c).alias(f"_r{c}") for c in ("id", "created_at") if c in resolutions.columns]).distinct()
    same = alerts["id"] == r["_rid"]
    if "_rcreated_at" in r.columns:
        same = same & (alerts["created_at"] == r["_rcreated_at"])
    j = alerts.join(r, same, "left")
    return j.withColumn("is_resolved", F.when(F.col("_rid").isNotNull(), F.lit(1))
                        .otherwise(F.col("is_resolved")).cast("int")).drop("_rid", "_rcreated_at")


def delete_where(df: DataFrame, pred) -> DataFrame:
    """SNK11: rows where the predicate is TRUE are removed (NULL keeps)."""
    return df.where(~F.coalesce(pred, F.lit(False)))


def freshness(loaded: DataFrame, source: DataFrame, cap: int = 6000) -> DataFrame:
    """SNK12: loaded rows vs. expected (all fraud + min(cap, non-fraud)),
    tolerance max(50, 5 % of expected); one row with a ``stale`` flag."""
    fraud = F.col("order_status") == "SUSPECTED_FRAUD"
    exp = source.select((F.count_if(fraud) + F.least(F.count_if(~fraud), F.lit(cap))).alias("e"))
    got = loaded.select(F.count(F.lit(1)).alias("loaded"))
    e = exp.select("e").scalar()
    return got.select(
        "loaded", e.alias("expected"),
        (F.abs(F.col("loaded") - e) > F.greatest(F.lit(50.0), e * 0.05)).alias("stale"))


def predictions_exist(predictions: DataFrame, prediction_type: str) -> DataFrame:
    """SNK13: does any prediction of the type exist (stops at the first)."""
    hit = predictions.where(F.col("prediction_type") == prediction_type).limit(1)
    return hit.select(F.count(F.lit(1)).alias("n")).select((F.col("n") > 0).alias("exists"))


# ------------------------------------------------------------------ table store

class TableStore:
    """Tables of Spark's catalog, in a database of their own whose files lie
    under ``root``.

    Tables are external parquet tables, so that a session with a new catalog
    finds them again by their place (``exists``).  A frame that is computed from
    the table it replaces is written elsewhere first."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = "supplyscope_" + hashlib.sha256(self.root.encode()).hexdigest()[:16]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.root}'")

    def _name(self, name: str) -> str:
        return f"{self.database}.{name}"

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        """SRC6: is the table in the catalog, or are its files under ``root``
        (then it is registered again)."""
        if table_exists(self.spark, self._name(name)):
            return True
        try:
            found = self.spark.read.parquet(self._path(name)).schema
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return False
        self._create(name, TABLE_SCHEMAS.get(name, found))
        return True

    def _create(self, name: str, schema) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = f" PARTITIONED BY ({', '.join(PARTITIONS[name])})" if name in PARTITIONS else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self._name(name)} ({columns}) USING parquet OPTIONS (compression 'zstd'){parts} LOCATION '{self._path(name)}'")
        if parts and self.spark.conf.get("spark.sql.catalogImplementation", "in-memory") == "hive":
            self.spark.catalog.recoverPartitions(self._name(name))

    def create_tables(self) -> None:
        """SNK2: each table with its fixed schema, if absent; one that is there
        keeps its rows."""
        for name, schema in TABLE_SCHEMAS.items():
            self._create(name, schema)

    def read(self, name: str) -> DataFrame:
        if not self.exists(name):
            raise FileNotFoundError(name)
        df = self.spark.table(self._name(name))
        if name == "alerts" and self.exists("resolutions"):
            df = resolve(df, self.spark.table(self._name("resolutions")))
        return conform(df, TABLE_SCHEMAS[name]) if name in TABLE_SCHEMAS else df

    def _insert(self, name: str, df: DataFrame, mode: str, partitions: str = "static") -> None:
        """Rows into a table that exists, by its columns' names.  Which
        partitions an overwrite replaces is a setting of the session."""
        setting, conf = "spark.sql.sources.partitionOverwriteMode", self.spark.conf
        before = conf.get(setting)
        conf.set(setting, partitions)
        try:
            columns = self.spark.table(self._name(name)).columns
            df.select(*columns).write.insertInto(self._name(name), overwrite=mode == "overwrite")
        finally:
            conf.set(setting, before)

    def overwrite(self, name: str, df: DataFrame) -> None:
        """SNK1 / SNK3 / SNK5: the table's whole content is replaced; a table
        that is absent, or has other columns, is made."""
        same = self.exists(name) and sorted(self.spark.table(self._name(name)).columns) == sorted(df.columns)
        with staged(df, name) as rows:
            if same:
                self._insert(name, rows, "overwrite")
                return
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(name)}")
            rows.write.mode("overwrite").option("compression", "zstd").option("path", self._path(name)).saveAsTable(self._name(name))

    def append(self, name: str, df: DataFrame) -> None:
        """SNK6: rows are added."""
        if self.exists(name):
            self._insert(name, df, "append")
        else:
            self.overwrite(name, df)

    def upsert(self, name: str, new: DataFrame, keys, order_col: str | None = None) -> None:
        """SNK4 on the stored table."""
        base = self.read(name) if self.exists(name) else new.limit(0)
        self.overwrite(name, upsert(base, new, keys, order_col))

    def write_alerts(self, new: DataFrame) -> None:
        """SNK8: replace the (agent, category) groups present in ``new``
        with dynamic partition overwrite (other partitions untouched; an
        empty batch writes nothing)."""
        self._create("alerts", TABLE_SCHEMAS["alerts"])
        with staged(conform(new, TABLE_SCHEMAS["alerts"]), "alerts") as rows:
            self._insert("alerts", rows, "overwrite", "dynamic")

    def clear_alerts(self) -> None:
        """SNK9: no alert is left, nor any resolution of one."""
        self._create("alerts", TABLE_SCHEMAS["alerts"])
        self._insert("alerts", self.spark.createDataFrame([], TABLE_SCHEMAS["alerts"]), "overwrite")
        if self.exists("resolutions"):
            self._insert("resolutions", self.spark.createDataFrame([], RESOLUTIONS), "overwrite")

    def resolve_alerts(self, ids: DataFrame) -> None:
        """SNK10: record resolutions of stored alerts by id and run stamp
        (append-only table, applied on read)."""
        wanted = ids.select(F.col("id").cast("bigint")).distinct()
        self.append("resolutions", self.spark.table(self._name("alerts")).join(wanted, "id", "left_semi").select("id", "created_at"))

    def delete_where(self, name: str, pred) -> None:
        """SNK11 on a stored table."""
        self.overwrite(name, delete_where(self.read(name), pred))
