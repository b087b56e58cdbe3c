"""Exact quantiles, ranks and first rows that no single task has to hold the
data for."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyscope.session import written

#: Values of a column that may be ordered in one task at the end.
BAND = 65_536


class Search:
    """The search for one column's value at a place: it lies between ``low``
    and ``high``, and ``values`` bounds the distinct values between them."""

    def __init__(self, value: Column):
        self.value = value
        self.low = self.high = self.values = self.found = None

    def inside(self) -> Column:
        return (self.value > self.low) & (self.value < self.high)

    def bound(self, ends, rows: int, eps: float) -> None:
        """Take a sketch's ends for a place among ``rows`` rows."""
        self.low, self.high = ends
        self.values = math.ceil(3 * eps * rows) + 2
        if self.low == self.high:
            self.found = (self.low, self.low)

    def narrow(self, r, first: int, last: int, band: int) -> tuple[float, float] | None:
        """Use exact counts: settle the values at ranks ``first`` and ``last``
        (neighbours) if an end holds one of them, else give the places of both
        among the rows strictly inside."""
        begin = r["below"] + r["at_low"]
        end = begin + r["inside"]
        least, most = (r["least"], r["most"]) if r["inside"] else (self.high, self.low)
        if first >= begin and last < end:
            if r["inside"] <= band or least == most:
                self.low, self.high, self.values = least, most, r["inside"]
                if least == most:
                    self.found = (least, least)
                return None
            return (first - begin) / r["inside"], (last - begin + 1) / r["inside"]
        a = self.low if first < begin else most if first < end else self.high
        b = self.low if last < begin else least if last < end else self.high
        self.found = (a, b)
        return None


def _rows(df: DataFrame, searches: dict, make) -> dict:
    """One row of aggregates for each search, in one job."""
    names = list(searches)
    row = df.select(*[F.struct(*make(searches[n])).alias(f"s{i}") for i, n in enumerate(names)]).first()
    return {n: row[f"s{i}"] for i, n in enumerate(names)}


def values_at(df: DataFrame, values: dict[str, Column], ranks, accuracy: int = 10_000,
              band: int = BAND, share: float | None = None) -> dict[str, tuple[float, float, int]]:
    """For each named numeric column the values at two neighbouring ranks, and
    its number of values: (a, b, n); a column without values is left out.

    ``ranks(n)`` gives both ranks (from 0); ``share`` is about their part of n,
    if known, and saves a job.  Repeated range refinement: a sketch
    bounds the place (its rank error is at most 1 / ``accuracy`` of the rows it
    saw), exact counts below, at and between the bounds settle it or say where
    between them it lies, and the rows between are sketched in turn.  That ends
    when at most ``band`` distinct values are left, which one task orders; every
    job before returns one row."""
    eps = 2.0 / accuracy
    open_ = {n: Search(v.cast("double")) for n, v in values.items()}

    def around(a: float, b: float) -> list[float]:
        return [max(0.0, a - eps), min(1.0, b + eps)]

    def seen(s):
        n = F.count(s.value).alias("n")
        return [n] if share is None else [n, F.percentile_approx(s.value, around(share, share), accuracy).alias("ends")]

    first = _rows(df, open_, seen)
    size = {n: r["n"] for n, r in first.items()}
    open_ = {n: s for n, s in open_.items() if size[n]}
    place = {n: ranks(size[n]) for n in open_}

    def sketch(todo: dict, shares: dict, rows: dict, of) -> None:
        ends = _rows(df, todo, lambda s: [F.percentile_approx(of(s), shares[s], accuracy).alias("ends")])
        for n, s in todo.items():
            s.bound(ends[n]["ends"], rows[n], eps)

    todo = {}
    for n, s in open_.items():
        if size[n] <= band:
            s.low, s.high, s.values = -math.inf, math.inf, size[n]
        elif share is not None and size[n] * eps >= 4:
            s.bound(first[n]["ends"], size[n], eps)
        else:
            todo[n] = s
    if todo:
        sketch(todo, {s: around(place[n][0] / size[n], (place[n][1] + 1) / size[n]) for n, s in todo.items()}, size,
               lambda s: s.value)
    while wide := {n: s for n, s in open_.items() if s.found is None and s.values > band}:
        counts = _rows(df, wide, lambda s: [
            F.count_if(s.value < s.low).alias("below"), F.count_if(s.value == s.low).alias("at_low"),
            F.count_if(s.inside()).alias("inside"), F.min(F.when(s.inside(), s.value)).alias("least"),
            F.max(F.when(s.inside(), s.value)).alias("most")])
        again = {n: share for n, s in wide.items() if (share := s.narrow(counts[n], *place[n], band)) is not None}
        if again:
            todo = {n: wide[n] for n in again}
            sketch(todo, {wide[n]: around(*again[n]) for n in again}, {n: counts[n]["inside"] for n in again},
                   lambda s: F.when(s.inside(), s.value))
    _order(df, {n: s for n, s in open_.items() if s.found is None}, place)
    return {n: (*s.found, size[n]) for n, s in open_.items()}


def _order(df: DataFrame, open_: dict, place: dict) -> None:
    """Settle searches whose few values are ordered: counts below, above and,
    one by one, between the bounds, all combined before the shuffle."""
    if not open_:
        return

    def cell(n, s):
        side = F.when(s.value < s.low, -1).when(s.value > s.high, 1).when(s.value.isNotNull(), 0)
        return F.struct(F.lit(n).alias("c"), side.alias("side"), F.when(side == 0, s.value).alias("v"))

    cells = df.select(F.inline(F.array(*[cell(n, s) for n, s in open_.items()]))).where("side IS NOT NULL")
    counts = cells.groupBy("c", "side", "v").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("c").orderBy("side", "v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first, last = (F.create_map(*[x for n in open_ for x in (F.lit(n), F.lit(place[n][i]))])[F.col("c")] for i in (0, 1))
    ranked = counts.withColumn("upto", F.sum("n").over(upto))
    at = ranked.groupBy("c").agg(F.min(F.when(F.col("upto") > first, F.col("v"))).alias("a"),
                                 F.min(F.when(F.col("upto") > last, F.col("v"))).alias("b"))
    for r in at.collect():
        open_[r.c].found = (r.a, r.b)


def exact_quantiles(df: DataFrame, columns, q: float, accuracy: int = 10_000, band: int = BAND) -> dict[str, float | None]:
    """The exact ``q``-quantile (linear interpolation) of each numeric column,
    NULLs aside; None for a column without values.  See ``values_at``."""
    columns = list(columns)

    def ranks(n):
        place = (n - 1) * q
        return math.floor(place), math.ceil(place)

    found = values_at(df.select(*columns), {c: F.col(c) for c in columns}, ranks, accuracy, band, q)
    out = dict.fromkeys(columns)
    for c, (a, b, n) in found.items():
        part = (n - 1) * q - math.floor((n - 1) * q)
        out[c] = a + (b - a) * part
    return out


def exact_quantile(df: DataFrame, column: str, q: float) -> Column:
    """The exact quantile of one column, as a literal."""
    return F.lit(exact_quantiles(df, [column], q)[column]).cast("double")


def first_rows(df: DataFrame, keys, order, k: int, band: int = BAND) -> DataFrame:
    """The first ``k`` rows by ``order``, which begins with the numeric ``keys``
    (ascending; doubles must hold them exactly; NULL comes last).

    The value of the first key at place ``k`` is found without a sort
    (``values_at``); rows before it are in, those at it are told apart by the
    next key in the same way, until at most ``band`` rows tie.  So the last
    task sorts at most ``k + band`` rows, however many tasks read the table,
    unless all keys tie."""
    taken, tie, left = F.lit(False), F.lit(True), k
    for key in keys:
        value = F.when(tie, F.coalesce(key.cast("double"), F.lit(float("inf"))))
        found = values_at(df, {"key": value}, lambda n: (min(left, n) - 1,) * 2)
        if not found or found["key"][2] <= left:
            break
        at = found["key"][0]
        n = df.select(F.count_if(value < at).alias("before"), F.count_if(value == at).alias("tied")).first()
        taken, tie, left = taken | (tie & (value < at)), tie & (value == at), left - n.before
        if n.tied <= left + band:
            break
    return df.where(taken | tie).orderBy(*order).limit(k)


def text_rank(df: DataFrame, groups, text: str, name: str) -> DataFrame:
    """Adds ``name``, the 0-based rank of a distinct, non-null text in its
    group.

    Rows are range-partitioned and sorted by group and text, and written once
    with their row numbers; a row's rank is its place among its group's rows in
    its partition, plus the group's rows in the partitions before.  Texts that
    begin alike are spread like any others."""
    groups = list(groups)
    number = F.monotonically_increasing_id()
    x = written(df.repartitionByRange(*groups, text).sortWithinPartitions(*groups, text).withColumn("_m", number), "ranks")
    x = x.withColumn("_part", F.shiftright("_m", 33))
    sizes = x.groupBy(*groups, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_first"))
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    x = x.join(sizes, [*groups, "_part"])
    return x.withColumn(name, (F.col("_before") + F.col("_m") - F.col("_first")).cast("int")).drop(
        "_m", "_part", "_first", "_before")
