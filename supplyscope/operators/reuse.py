"""Reuse of finished steps (MLD8, SNK13): a record of what was made from what.

A step's key is a digest of its input's content, its feature list and its
parameters.  A record is written after the step's result, so a step that was
broken off has none and is done again.  Records are plain parquet rows under
``<root>/run_records``, appended only.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = "step string, key string, path string, created_at string, detail string"


def content_digest(df: DataFrame, columns) -> str:
    """Digest of the rows' values in ``columns``, whatever their order and
    partitioning: count, sum and exclusive or of 64-bit row hashes, one pass
    with one row of result.  Repeated rows count."""
    cols = list(columns)
    row: Column = F.xxhash64(*[F.struct(F.col(c).alias("v")) for c in cols], *[F.col(c).isNull() for c in cols])
    r = df.select(F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(row), F.lit(0)).alias("x"),
                  F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("s")).first()
    types = [f"{c}:{df.schema[c].dataType.simpleString()}" for c in cols]
    return hashlib.sha256("|".join([str(r.n), str(r.x), r.s, *types]).encode()).hexdigest()


def step_key(step: str, digest: str, features, parameters: dict) -> str:
    """Key of a step: equal if and only if input, features and parameters are."""
    return hashlib.sha256(json.dumps([step, digest, list(features), parameters], sort_keys=True).encode()).hexdigest()


class Records:
    """The records under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/run_records"
        self.root = root.rstrip("/")

    def all(self) -> DataFrame:
        """Every record; none if no step was recorded yet.  Any other failure
        to read them is an error, not an empty list."""
        try:
            return self.spark.read.schema(RECORD).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], RECORD)

    def find(self, step: str, key: str):
        """The step's first record under this key, or None."""
        return self.all().where((F.col("step") == step) & (F.col("key") == key)).orderBy("created_at").first()

    def add(self, step: str, key: str, path: str, created_at: str, detail: dict | None = None) -> None:
        row = [(step, key, path, created_at, json.dumps(detail or {}, sort_keys=True))]
        self.spark.createDataFrame(row, RECORD).coalesce(1).write.mode("append").parquet(self.path)

    def model(self, step: str, key: str, created_at: str, load, fit, save, detail: dict | None = None):
        """MLD8: the recorded model, or a new one, saved under its own key and
        then recorded.  Returns (model, whether it was reused).

        A recorded model that can't be loaded raises: a storage error must not
        pass for a missing model and overwrite it."""
        found = self.find(step, key)
        if found is not None:
            return load(found.path), True
        model, path = fit(), f"{self.root}/models/{step}-{key[:24]}"
        save(model, path)
        self.add(step, key, path, created_at, detail)
        return model, False

    def rows(self, step: str, key: str, created_at: str, append) -> tuple[str, bool]:
        """SNK13: rows of a step are stored once per key: ``append()`` runs only
        without a record.  Returns (stamp of the stored rows, whether the step
        was skipped)."""
        found = self.find(step, key)
        if found is not None:
            return found.created_at, True
        append()
        self.add(step, key, "", created_at)
        return created_at, False

    def stored(self, table: DataFrame, stamps: dict[str, str]) -> DataFrame:
        """The rows of ``table`` (prediction_type, created_at) that the given
        steps stored: what a broken-off run left behind has no record."""
        hit = F.lit(False)
        for kind, stamp in stamps.items():
            hit = hit | ((F.col("prediction_type") == kind) & (F.col("created_at") == stamp))
        return table.where(hit)
