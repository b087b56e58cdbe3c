"""Exact duplicates by distributed MSD radix partitioning (operator 8).

Rows are split by their texts' length and first bytes, then by longer and
longer byte prefixes, until a row stands alone or its text has ended; equality
is decided on the bytes themselves, never on a digest.  A digit is a whole
byte string and widths grow sixteenfold, so a group of equal texts of n bytes
is settled after about log16(n / 64) rounds.  Each round counts the rows of a
prefix (combined map-side, so a huge group costs one row a task) and joins the
counts back (a skewed join that Spark can split).  Texts of rows that are
alone after the first digit are never written again.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyscope.llm.work import Carried, byte_view, merge_join, session, stash

FIRST_BYTES = 64
WIDER = 16
#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


AZ, AZ_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def measured(texts_of, full: bool):
    """mapInArrow function: byte length and first bytes of the lower-cased
    text; with ``full`` all columns of the row and the text's SHA-256 before."""
    def run(batches):
        for b in batches:
            data, off = byte_view(texts_of(b))
            low = LOWER[data].tobytes()
            ends = off.tolist()
            texts = [low[i:j] for i, j in zip(ends, ends[1:])]
            cols, names = [], []
            if full:
                cols = [*b.columns, pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())]
                names = [*b.schema.names, "sha"]
            cols += [pa.array(np.diff(off), pa.int64()), pa.array([t[:FIRST_BYTES] for t in texts], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "nb", "head"])
    return run


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, ``carry`` (struct of those columns, if any),
    keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty.  The row with the largest id stays (a null id is the smallest; of
    rows that share id and text one stays).  An empty table gives no rows.
    """
    session(docs)
    c = Carried(docs, id_col, text_col, carry)
    heads = c.rows.mapInArrow(measured(c.texts, False), "nb long, head binary")
    counts = stash(heads.groupBy("nb", "head").agg(F.count("*").alias("n")).filter("n > 1"), "exact-heads")
    full = c.rows.mapInArrow(measured(c.texts, True), c.schema("sha string, nb long, head binary"))
    full = full.withColumn("row", F.monotonically_increasing_id())
    body = F.translate(c.text, AZ, AZ_LOWER).cast("binary")
    light = [*c.kept, "sha", "row", "nb"]
    first = stash(merge_join(full, counts, ["nb", "head"], "left").select(
        *light, F.when(F.col("n") > 1, body).alias("body")), "exact-rows")

    alone = [first.filter("body IS NULL")]
    open_rows, width = first.filter("body IS NOT NULL"), FIRST_BYTES
    while (longest := open_rows.agg(F.max("nb")).first()[0] or 0) > width * WIDER:
        width *= WIDER
        digits = open_rows.withColumn("digits", F.col("body").substr(1, width))
        counts = stash(digits.groupBy("nb", "digits").agg(F.count("*").alias("n")).filter("n > 1"), "exact-digits")
        step = stash(merge_join(digits, counts, ["nb", "digits"], "left").select(
            *light, F.when(F.col("n") > 1, F.col("body")).alias("body")), "exact-open")
        alone.append(step.filter("body IS NULL"))
        open_rows = step.filter("body IS NOT NULL")

    ended = open_rows.withColumn("who", F.struct("id", "row"))
    groups = stash(ended.groupBy("nb", "body").agg(F.max("who").alias("best"), F.count("*").alias("n")), "exact-groups")
    out = merge_join(ended, groups, ["nb", "body"]).select(
        *c.kept, F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("best.row") == F.col("row")).alias("kept"), F.col("sha").alias("text_sha256"))
    for part in alone:
        out = out.unionByName(part.select(
            *c.kept, F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
            F.lit(True).alias("kept"), F.col("sha").alias("text_sha256")))
    return out
