"""Shared helpers: written intermediate tables, Arrow batches, row packing."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplyscope.session import output_root

BATCH_BYTES = 8 << 20


def session(df: DataFrame) -> SparkSession:
    """The frame's session, with Arrow batches bounded by bytes and skewed
    join partitions split even where that costs a further shuffle."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


class Scope:
    """Folder of the written tables of the pipeline stage that runs."""

    current: str | None = None


def begin_stage(spark: SparkSession) -> None:
    """Give the tables of the stage that begins a folder of their own, and
    empty the folder of the stage before, whose result is written by now."""
    if Scope.current:
        spark.range(0).write.mode("overwrite").parquet(Scope.current)
    Scope.current = f"{output_root(spark, 'llm')}/stage-{uuid.uuid4().hex}"


def end_stages() -> None:
    """After the last stage: tables are written outside of any stage again."""
    Scope.current = None


def stash(df: DataFrame, name: str, keep: bool = False, file_rows: int = 0) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage with a table that survives the loss of executors.  Within
    a pipeline stage it lasts until the next stage begins, unless ``keep``.
    ``file_rows``, if given, bounds the rows of a file, for tables of wide rows."""
    spark = df.sparkSession
    root = output_root(spark, "llm")
    path = f"{root if keep or not Scope.current else Scope.current}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("maxRecordsPerFile", file_rows).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def merge_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Sort-merge join at every size: the right side grows with the data, so
    no plan that only a small input allows, and skewed keys can be split."""
    return left.join(right.hint("merge"), on, how)


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def named(df: DataFrame, name: str) -> Column:
    """The column of that very name, dots and all."""
    return df["`" + name.replace("`", "``") + "`"]


class Carried:
    """Rows as (id, carry, text): ``carry`` is a struct of the columns to keep
    (absent if there are none), so that no name can clash; ``text`` is a column
    of its own only if the struct doesn't hold it."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...]):
        self.inside = text_col if text_col in carry and docs.schema[text_col].dataType == T.StringType() else None
        cols = [docs[id_col].alias("id")]
        if carry:
            cols.append(F.struct(*(named(docs, c).alias(c) for c in carry)).alias("carry"))
        if not self.inside:
            cols.append(text_or_empty(docs[text_col]).alias("text"))
        self.rows = docs.select(*cols)
        self.kept = ["id", "carry"] if carry else ["id"]
        self.all = self.rows.columns

    @property
    def text(self) -> Column:
        return text_or_empty(F.col("carry")[self.inside]) if self.inside else F.col("text")

    @property
    def texts(self):
        """Function from a record batch to its texts; holds no frame."""
        inside = self.inside
        return lambda batch: batch.column("carry").field(inside) if inside else batch.column("text")

    def schema(self, more: str, frame: DataFrame | None = None) -> T.StructType:
        """The rows' fields followed by those of a DDL string."""
        return T.StructType([*(frame or self.rows).schema.fields, *T.StructType.fromDDL(more).fields])


def byte_view(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and the int64 offsets of its values;
    nulls are empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = (arr.fill_null("") if arr.null_count else arr).cast(pa.large_binary())
    off = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    if arr.buffers()[2] is None or not len(arr):
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    data = np.frombuffer(arr.buffers()[2], dtype=np.uint8)[off[0]:off[-1]]
    return data, off - off[0]


def slices(sizes, limit: int):
    """Ranges (i, j) of consecutive items of at most ``limit`` bytes in all;
    a larger item stands alone."""
    i, total = 0, 0
    for j, n in enumerate(sizes):
        if j > i and total + n > limit:
            yield i, j
            i, total = j, 0
        total += int(n)
    if i < len(sizes):
        yield i, len(sizes)
