"""From raw documents to a training mix: STAGES in order, each written and
read again before the next.

Each stage takes (spark, docs, sf_dir) and calls one operator of
``supplyscope.llm``; all but the last return the columns of ``docs``.  A stage's
inner tables are emptied when the next stage begins, so its result must be
written first.

Every stage takes nulls in any column, empty and long texts, repeated rows,
empty tables and extra columns of any name as its operator does: null and empty
texts go in the first stage (no letters); rows without an id stay and are the
smallest where a stage keeps the largest id; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyscope.llm.decontaminate import contamination
from supplyscope.llm.exact import exact_groups
from supplyscope.llm.language import language_rows
from supplyscope.llm.mixing import Mix, mixed_rows
from supplyscope.llm.neardup import near_duplicates
from supplyscope.llm.work import begin_stage, end_stages, stash


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Names each document's language in ``lang``, from its text and its
    source; drops those without a letter of any script."""
    begin_stage(spark)
    return language_rows(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    begin_stage(spark)
    return exact_groups(docs, carry=tuple(docs.columns)).filter("kept").select("carry.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the row with the largest doc_id stays."""
    begin_stage(spark)
    return near_duplicates(docs, carry=tuple(docs.columns)).filter("kept").select("carry.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark window."""
    begin_stage(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(docs, benchmark, carry=tuple(docs.columns)).filter(~F.col("contaminated")).select("carry.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as they are taken, by shard, shuffled."""
    begin_stage(spark)
    return mixed_rows(docs, Mix(docs))


STAGES = [("language_id", language), ("exact_dedup", exact), ("near_dedup", near), ("decontaminate", decontaminate), ("mix", mix)]

#: Language models and MinHash candidates have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"after-{name}", keep=True)
    out = STAGES[-1][1](spark, docs, sf_dir)
    end_stages()
    return out
