"""Property tests for table maintenance and tiering (hypothesis)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from supplyscope.operators import reports, sinks

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

rows = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 100)), max_size=12)


@SETTINGS
@given(base=rows, new=rows)
def test_upsert_keys_and_last_write(spark, base, new):
    b = spark.createDataFrame(list({k: (k, v) for k, v in base}.values()) or [(0, 0)][:0], "k int, v int")
    n = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(new)], "k int, v int, seq int")
    out = {r["k"]: r["v"] for r in sinks.upsert(b, n, ["k"], "seq").collect()}
    want = {k: v for k, v in {k: (k, v) for k, v in base}.values()}
    for k, v in new:          # later rows of the batch win
        want[k] = v
    assert out == want


@SETTINGS
@given(base=st.lists(st.sampled_from(["A", "B", "C"]), max_size=10),
       new=st.lists(st.sampled_from(["A", "B", "C"]), max_size=5))
def test_replace_groups_only_touches_batch_groups(spark, base, new):
    schema = "id long, agent string, category string"
    b = spark.createDataFrame([(i, a, "x") for i, a in enumerate(base)], schema)
    n = spark.createDataFrame([(100 + i, a, "x") for i, a in enumerate(new)], schema)
    out = sinks.replace_alert_groups(b, n).collect()
    kept = sorted(r["id"] for r in out if r["id"] < 100)
    assert kept == sorted(i for i, a in enumerate(base) if a not in set(new))
    assert sorted(r["id"] for r in out if r["id"] >= 100) == [100 + i for i in range(len(new))]


@SETTINGS
@given(vals=st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=15))
def test_delete_where_is_null_safe(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "v int")
    out = sinks.delete_where(df, F.col("v") >= 3).collect()
    assert sorted((r["v"] is None, r["v"] or 0) for r in out) == sorted(
        (v is None, v or 0) for v in vals if v is None or v < 3)


@SETTINGS
@given(ps=st.lists(st.floats(0.0, 1.0, allow_nan=False), min_size=1, max_size=30))
def test_risk_tiers_partition(spark, ps):
    df = spark.createDataFrame([(p,) for p in ps], "risk_prob double")
    t = reports.risk_tiers(df).first()
    assert t["critical"] + t["high"] + t["medium"] == len(ps)
    assert t["critical"] == sum(p >= 0.85 for p in ps)


@SETTINGS
@given(ids=st.sets(st.integers(0, 9), max_size=10), res=st.sets(st.integers(0, 12), max_size=5))
def test_resolve_flags_exactly_listed_ids(spark, ids, res):
    a = spark.createDataFrame([(i, 0) for i in sorted(ids)] or [(0, 0)][:0], "id long, is_resolved int")
    r = spark.createDataFrame([(i,) for i in sorted(res)] or [(0,)][:0], "id long")
    out = {x["id"]: x["is_resolved"] for x in sinks.resolve(a, r).collect()}
    assert out == {i: int(i in res) for i in ids}
