import pytest

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows and
    extra columns whose names clash with inner ones."""
    rows = [
        (1, "", "en", "a"), (2, None, "en", "a"), (None, "Some words here, five or more of them.", None, None),
        (None, None, None, None), (3, "Some words here, five or more of them.", "en", "b"),
        (3, "Some words here, five or more of them.", "en", "b"), (4, "SOME words here, five or more of them.", "fr", None),
        (5, LONG, "en", "a"), (6, LONG + " end", "en", "b"), (7, "...!!", "de", ""), (8, "é", "fr", "b"), (9, "x" * 3000, "en", "a"),
    ]
    base = spark.createDataFrame([(*r, 7, "k", "t") for r in rows],
                                 "doc_id long, text string, lang string, source string, id int, row string, `a.b` string")
    from pyspark.sql import functions as F
    for name in ("carry", "key", "payload", "n", "head", "size", "block", "part", "chunk", "word", "shard", "pass", "host", "kept"):
        base = base.withColumn(name, F.lit(1))
    return base.repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def small(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")


@pytest.fixture(scope="session")
def pairs():
    """(doc_id, text) rows of a frame, for the plain versions."""
    return lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
