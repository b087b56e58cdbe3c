"""Registered queries of the document operators, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_quality")
def op1_quality(spark, sf_dir):
    from supplyscope.llm.quality import quality_scores
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_pii")
def op2_pii(spark, sf_dir):
    from supplyscope.llm.pii import pii_spans
    return pii_spans(table(spark, sf_dir, "documents"))


@query("op3_decontaminate")
def op3_decontaminate(spark, sf_dir):
    from supplyscope.llm.decontaminate import contamination
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op4_repeats")
def op4_repeats(spark, sf_dir):
    from supplyscope.llm.repeats import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents"))


def tokenizer_model(name: str = "piece_bpe_32k.model") -> bytes:
    """Content of a public tokenizer file, read where the query is built."""
    import public_tokenizers
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


@query("op5_token_counts")
def op5_token_counts(spark, sf_dir):
    from supplyscope.llm.tokens import token_counts
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_model())


@query("op6_near_duplicates")
def op6_near_duplicates(spark, sf_dir):
    from supplyscope.llm.neardup import near_duplicates
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "class_id", "class_size", "n_links", "kept")


@query("op7_mixing")
def op7_mixing(spark, sf_dir):
    from supplyscope.llm.mixing import Mix, mix_report
    return mix_report(Mix(table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op8_exact_dedup", f"""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(low) AS text_sha256
FROM (SELECT doc_id, {LOWER_SQL} AS low FROM documents)
WINDOW w AS (PARTITION BY low)""")
def op8_exact_dedup(spark, sf_dir):
    from supplyscope.llm.exact import exact_groups
    out = exact_groups(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


@query("op9_secrets")
def op9_secrets(spark, sf_dir):
    from supplyscope.llm.secrets import secret_spans
    return secret_spans(table(spark, sf_dir, "documents"))


@query("op10_language_id")
def op10_language_id(spark, sf_dir):
    """Documents and web pages; the models are counted over all labelled
    documents."""
    from supplyscope.llm import language
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    names, models = language.text_models(docs.select("text", "lang"), "lang")
    none = F.lit(None).cast("long")
    rows = language.rows_of(docs, [docs["doc_id"], none.alias("page_id")], docs["text"], docs["source"], False).unionByName(
        language.rows_of(pages, [none.alias("doc_id"), pages["page_id"]], pages["html"], pages["url"], True))
    return language.identify(rows, names, models).select("payload.*", "lang", "posterior", "text_lang", "accepted")


@query("op12_spelling")
def op12_spelling(spark, sf_dir):
    from supplyscope.llm.spelling import spelling_groups
    return spelling_groups(table(spark, sf_dir, "documents"), typo_every=97)


@query("op13_hard_negatives")
def op13_hard_negatives(spark, sf_dir):
    from supplyscope.llm.negatives import hard_negatives
    rows, name = table(spark, sf_dir, "embeddings"), F.col("vec_id")
    rows = rows.withColumn("label", F.when(name % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, rows["vec_id"] % 100 == 0)


@query("op11_sentencepiece")
def op11_sentencepiece(spark, sf_dir):
    from supplyscope.llm.pieces import decode, encode
    model = tokenizer_model()
    return decode(encode(table(spark, sf_dir, "documents"), model), model, digests=True)
