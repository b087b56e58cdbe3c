"""Run records: same input skips, changed input refits, broken stores raise."""

import tempfile

import pytest
from pyspark.sql import functions as F

from supplyscope.operators.reuse import Records, content_digest, step_key


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="supplyscope-records-", dir="/tmp")


def test_digest_is_of_the_content(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 0.5), (2, None, 0.5)], "x int, y string, z double")
    same = df.repartition(3).orderBy(F.desc("x"))
    assert content_digest(df, df.columns) == content_digest(same, df.columns)
    for other in (df.where("x = 1"), df.distinct(), df.withColumn("x", F.lit(1)), df.union(df), df.limit(0),
                  df.withColumn("x", F.col("x").cast("long")),
                  spark.createDataFrame([(1, None, None), (2, "a", 0.5), (2, None, 0.5)], df.schema)):
        assert content_digest(df, df.columns) != content_digest(other, df.columns)
    assert content_digest(df, ["x"]) != content_digest(df, ["x", "y"])


def test_model_is_fitted_once_for_each_key(spark, root):
    records, fits = Records(spark, root), []

    def get(key):
        return records.model("m", key, "t", lambda p: spark.read.text(p).first()[0], lambda: fits.append(key) or f"model {key}",
                             lambda m, p: spark.createDataFrame([(m,)], "value string").write.text(p))
    a, b = step_key("m", "d", ["f"], {"depth": 4}), step_key("m", "d", ["f"], {"depth": 5})
    assert a != b and step_key("m", "d2", ["f"], {"depth": 4}) != a and step_key("m", "d", ["g"], {"depth": 4}) != a
    assert get(a) == (f"model {a}", False) and get(a) == (f"model {a}", True)
    assert get(b) == (f"model {b}", False) and get(a)[1]
    assert fits == [a, b]


def test_unreadable_model_raises_and_is_not_overwritten(spark, root):
    records = Records(spark, root)
    records.add("m", "k", f"{root}/no-such-model", "t")
    with pytest.raises(Exception, match="no-such-model"):
        records.model("m", "k", "t", lambda p: spark.read.parquet(p), lambda: pytest.fail("fitted"), lambda m, p: pytest.fail("saved"))


def test_broken_records_raise(spark, root):
    spark.createDataFrame([("x",)], "value string").write.text(f"{root}/run_records")
    with pytest.raises(Exception):
        Records(spark, root).find("m", "k")


def test_rows_are_appended_once_and_broken_runs_are_not_seen(spark, root):
    records, path = Records(spark, root), f"{root}/p"
    frame = spark.createDataFrame([("demand", "t1", 1.0)], "prediction_type string, created_at string, v double")

    def broken():
        frame.withColumn("created_at", F.lit("t0")).write.mode("append").parquet(path)
        raise OSError("lost")
    with pytest.raises(OSError):
        records.rows("demand", "k", "t0", broken)
    assert records.rows("demand", "k", "t1", lambda: frame.write.mode("append").parquet(path)) == ("t1", False)
    assert records.rows("demand", "k", "t2", lambda: pytest.fail("appended again")) == ("t1", True)
    stored = records.stored(spark.read.parquet(path), {"demand": "t1"})
    assert [r.created_at for r in stored.collect()] == ["t1"] and spark.read.parquet(path).count() == 2
