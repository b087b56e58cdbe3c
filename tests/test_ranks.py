"""Quantiles, ranks, first rows and hash cutoffs against plain versions, with
bounds so small that every refinement is used."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from supplyscope.operators import ranks, sampling


def plain_quantile(values, q):
    v = sorted(x for x in values if x is not None)
    if not v:
        return None
    place = (len(v) - 1) * q
    a, b = v[math.floor(place)], v[math.ceil(place)]
    return a + (b - a) * (place - math.floor(place))


@pytest.mark.parametrize("accuracy, band", [(10_000, 65_536), (20, 8), (50, 1)])
def test_quantiles_by_refinement(spark, accuracy, band):
    rng = random.Random(1)
    columns = {
        "normal": [rng.gauss(0, 1) for _ in range(3000)], "tied": [float(rng.choice((1, 1, 1, 1, 2, 5))) for _ in range(3000)],
        "spike": [7.0] * 2700 + [rng.random() for _ in range(300)], "wide": [10.0 ** rng.randrange(-300, 300) for _ in range(3000)],
        "holes": [None if i % 3 else float(i) for i in range(3000)], "empty": [None] * 3000, "one": [None] * 2999 + [4.0],
        "two": [0.0] * 1500 + [1.0] * 1500,
    }
    names = list(columns)
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{n} double" for n in names)).repartition(5)
    for q in (0.0, 0.1, 0.75, 0.9995):
        got = ranks.exact_quantiles(df, names, q, accuracy, band)
        for n in names:
            assert got[n] == pytest.approx(plain_quantile(columns[n], q), rel=1e-12, abs=1e-300) if got[n] is not None else columns[n] == [None] * 3000


def test_quantile_of_a_million_values_with_a_tiny_band(spark):
    df = spark.range(1_000_001).select(((F.col("id") * 48271) % 1_000_003).cast("double").alias("x"))
    want = plain_quantile([(i * 48271) % 1_000_003 for i in range(1_000_001)], 0.75)
    assert ranks.exact_quantiles(df, ["x"], 0.75, accuracy=100, band=100)["x"] == want


@pytest.mark.parametrize("band", [65_536, 3])
def test_first_rows(spark, band):
    rng = random.Random(2)
    rows = [(float(rng.choice((1, 2, 2, 3))), rng.randrange(40), i) for i in range(2000)] + [(None, 1, 5000)]
    df = spark.createDataFrame(rows, "score double, a int, b int").repartition(7)
    order = [F.col("score").asc_nulls_last(), F.col("a"), F.col("b")]
    want = sorted(rows, key=lambda r: (math.inf if r[0] is None else r[0], r[1], r[2]))
    for k in (1, 10, 499, 1500, 2001, 9999):
        got = ranks.first_rows(df, [F.col("score"), F.col("a")], order, k, band)
        assert list(map(tuple, got.collect())) == want[:k]
    assert ranks.first_rows(df.limit(0), [F.col("score")], order, 5).collect() == []


def test_first_rows_reach_the_last_task_bounded(spark):
    """Of 40 partitions, no more than k + band rows are left to sort."""
    df = spark.range(0, 40_000, 1, 40).select((F.col("id") % 1000).alias("s"), "id")
    out = ranks.first_rows(df, [F.col("s"), F.col("id")], [F.col("s"), F.col("id")], 500, band=50)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "GlobalLimit" in plan and "Filter" in plan
    kept = df.where("s < 12 OR (s = 12 AND id <= 40000)").count()
    assert out.count() == 500 and kept < 40_000


def test_text_rank_spreads_texts_that_begin_alike(spark):
    texts = [("g", f"same-long-prefix-{i:05d}") for i in range(4000)] + [("h", f"same-long-prefix-{i}") for i in range(50)]
    random.Random(4).shuffle(texts)
    df = spark.createDataFrame(texts, "g string, t string")
    got = {(r.g, r.t): r.n for r in ranks.text_rank(df, ["g"], "t", "n").collect()}
    for g in ("g", "h"):
        want = sorted(t for x, t in texts if x == g)
        assert [got[g, t] for t in want] == list(range(len(want)))
    spread = df.repartitionByRange(8, "g", "t").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in spread) < 0.3 * len(texts)


@pytest.mark.parametrize("band", [65_536, 2])
def test_hash_cutoffs(spark, band):
    rng = random.Random(5)
    rows = [(rng.choice(("a", "a", "a", "b", None)), i) for i in range(6000)]
    df = spark.createDataFrame(rows, "c string, id long").repartition(4).withColumn("h", F.md5(F.col("id").cast("string")))
    cut = sampling.hash_cutoffs(df, F.col("h"), lambda n: {g: n[g] // 5 for g in n}, ("c",), band)
    kept = df.where(sampling.below_cutoff(cut, F.col("h"), ("c",))).select("c", "id").collect()
    by = {}
    for r in df.collect():
        by.setdefault(r.c, []).append((r.h, r.id))
    want = {(c, i) for c, x in by.items() for _, i in sorted(x)[:len(x) // 5]}
    assert {tuple(r) for r in kept} == want


def test_split_is_exact(spark):
    rows = [(i, i % 3 == 0, "x") for i in range(1001)] + [(2000 + i, None, "x") for i in range(7)]
    df = spark.createDataFrame(rows, "id long, y boolean, z string")
    for fraction in (0.2, 0.1, 1.0):
        out = sampling.train_test_split(df, fraction, 1, ("id",), "y")
        n = {(r.y, r.is_test): r["count"] for r in out.groupBy("y", "is_test").count().collect()}
        for y, size in ((True, 334), (False, 667), (None, 7)):
            assert n.get((y, 1), 0) == math.ceil(Fraction(str(fraction)) * size)
            assert n.get((y, 0), 0) + n.get((y, 1), 0) == size
    whole = sampling.train_test_split(df, 0.2, 1, ("id",), None)
    assert whole.where("is_test = 1").count() == math.ceil(Fraction("0.2") * 1008)
    assert sampling.train_test_split(df.limit(0), 0.2, 1, ("id",), "y").count() == 0
