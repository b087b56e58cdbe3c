"""Seeded hash draws (SMP1-4).

Random draws cannot be replayed across a cluster, so every draw is a hash
of the row key and a seed: the same rows are picked on every run, on any
number of executors.  ``hash_unit`` gives a uniform value in [0, 1).
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyscope.operators.ranks import BAND
from supplyscope.sources.tables import ITEM_SEQ_FIELDS

# Key of an order line: the fields of its item_seq struct.
ITEM_KEY = tuple(f"item_seq.{f}" for f in ITEM_SEQ_FIELDS)


def hash_key(seed: int, *cols) -> Column:
    """md5 of the seed and key columns, as hex text (sortable draw order)."""
    parts = [F.lit(str(seed))] + [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def hash_unit(seed: int, *cols) -> Column:
    """Uniform draw in [0, 1) from the first 13 hex digits of the md5."""
    h = F.conv(F.substring(hash_key(seed, *cols), 1, 13), 16, 10).cast("bigint")
    return h.cast("double") / F.lit(float(16 ** 13))


def hash_cutoffs(df: DataFrame, draw: Column, wanted, groups=(), band: int = BAND) -> dict[tuple, str]:
    """For each group its ``k``-th smallest draw (hex text), k = ``wanted``'s
    value for the group: rows with ``draw <= cutoff`` are its first k.

    ``wanted(counts)`` maps rows per group to k per group; a group that it
    leaves out, or gives 0, has no cutoff.  Digits are refined three at a time:
    one aggregate counts the rows of each next prefix, combined map-side, and
    names the prefix that holds the k-th row, until at most ``band`` rows share
    it; those are ordered.  So a draw costs a few counts, and no row is
    shuffled or sorted but the last band's.  Groups (classes, strata) are few."""
    names = [f"g{i}" for i in range(len(groups))]
    rows = df.select(*[F.col(g).alias(n) for g, n in zip(groups, names, strict=True)], draw.alias("h"))
    digits, prefix, left, cutoffs = 3, {}, {}, {}

    def mine(keys) -> Column:
        """Rows under their group's prefix, for the groups in ``keys``."""
        hit = F.lit(False)
        for key in keys:
            same = F.col("h").startswith(prefix[key])
            for n, v in zip(names, key, strict=True):
                same = same & F.col(n).eqNullSafe(F.lit(v))
            hit = hit | same
        return hit

    counts = rows.groupBy(*names, F.substring("h", 1, digits).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    total: dict = {}
    for r in counts:
        key = tuple(r[n] for n in names)
        total[key] = total.get(key, 0) + r.n
    for key, k in wanted(total).items():
        if k >= total[key] > 0:
            cutoffs[key] = "g"  # past every hex digit
        elif k > 0:
            prefix[key], left[key] = "", k
    while prefix:
        small = []
        for key in prefix:
            under = sorted((r.p, r.n) for r in counts if tuple(r[n] for n in names) == key)
            for p, n in under:
                if left[key] <= n:
                    prefix[key] = p
                    if n <= band or digits >= 32:
                        small.append(key)
                    break
                left[key] -= n
        if small:
            nth = Window.partitionBy(*names).orderBy("h")
            ordered = rows.where(mine(small)).withColumn("rank", F.row_number().over(nth))
            at = F.lit(False)
            for key in small:
                same = F.col("rank") == left[key]
                for n, v in zip(names, key, strict=True):
                    same = same & F.col(n).eqNullSafe(F.lit(v))
                at = at | same
            cutoffs |= {tuple(r[n] for n in names): r.h for r in ordered.where(at).collect()}
            prefix = {key: p for key, p in prefix.items() if key not in small}
        if prefix:
            digits += 3
            counts = rows.where(mine(prefix)).groupBy(*names, F.substring("h", 1, digits).alias("p")).agg(
                F.count(F.lit(1)).alias("n")).collect()
    return cutoffs


def below_cutoff(cutoffs: dict[tuple, str], draw: Column, groups=()) -> Column:
    """Whether a row is among the first of its group."""
    hit = F.lit(False)
    for key, cut in cutoffs.items():
        same = draw <= cut
        for g, v in zip(groups, key, strict=True):
            same = same & F.col(g).eqNullSafe(F.lit(v))
        hit = hit | same
    return hit


def fraud_plus_sample(items: DataFrame, cap: int = 6000, seed: int = 42,
                      key=ITEM_KEY) -> DataFrame:
    """SMP1 + SET1: every fraud row plus exactly min(cap, n) non-fraud rows
    in hash order: one filter by a cutoff that counting finds."""
    flag, draw = F.col("order_status") == "SUSPECTED_FRAUD", hash_key(seed, *key)
    cut = hash_cutoffs(items.where(~flag), draw, lambda n: {k: cap for k in n})
    return items.where(flag | (~flag & below_cutoff(cut, draw)))


def stratified_sample(items: DataFrame, target: int = 4000, seed: int = 42,
                      stratum: str = "order_status", key=ITEM_KEY) -> DataFrame:
    """SMP2: all fraud rows plus, per non-fraud stratum, the first
    min(max(int(share x budget), 10), n) rows in hash order, where
    budget = max(target - fraud, 1000).

    Quotas come from the first count of ``hash_cutoffs``; the sample is one
    filter, so a hot stratum costs no more than any other.  Rows without a
    stratum belong to none."""
    flag, draw = F.col("order_status") == "SUSPECTED_FRAUD", hash_key(seed, *key)
    both = items.withColumn("_fraud", flag).where("_fraud IS NOT NULL")

    def quotas(counts):
        fraud = sum(n for (_, f), n in counts.items() if f)
        rest = sum(n for (_, f), n in counts.items() if not f)
        budget = max(target - fraud, 1000)
        return {(s, f): min(max(int(n / rest * budget), 10), n)
                for (s, f), n in counts.items() if not f and s is not None}

    cut = hash_cutoffs(both, draw, quotas, (stratum, "_fraud"))
    return both.where(F.col("_fraud") | below_cutoff(cut, draw, (stratum, "_fraud"))).drop("_fraud")


def train_test_split(df: DataFrame, test_fraction: float = 0.2, seed: int = 42,
                     key=ITEM_KEY, label: str | None = "late_delivery_risk", draw: Column | None = None) -> DataFrame:
    """SMP3: adds ``is_test``: 1 for exactly ceil(``test_fraction`` x n) rows of
    each class of ``label`` (of all rows without one), in hash order; ``draw``
    is that hash, if the rows hold it.

    Rows that share a key lie on the same side."""
    groups, draw = (label,) if label else (), hash_key(seed, *key) if draw is None else draw
    share = Fraction(str(test_fraction))
    cut = hash_cutoffs(df, draw, lambda counts: {g: math.ceil(share * n) for g, n in counts.items()}, groups)
    return df.withColumn("is_test", below_cutoff(cut, draw, groups).cast("int"))
