"""The pipeline's stages against plain versions, one after another."""

import brute
import corpus_pipeline
import pytest

from supplyscope.llm import language


@pytest.fixture(scope="module")
def stages(spark, sf_small, tmp_path_factory):
    """Input and output of each stage."""
    root, out = tmp_path_factory.mktemp("stages"), {}
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_small).write.parquet(f"{root}/{name}")
        out[name] = docs, spark.read.parquet(f"{root}/{name}")
        docs = out[name][1]
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_stay(stages):
    for name, (before, after) in stages.items():
        assert after.columns[:len(before.columns)] == before.columns
        assert name == "mix" or after.columns == before.columns


def test_each_stage(spark, stages, sf_small, pairs):
    before, after = stages["language_id"]
    assert ids(after) == ids(before.filter("text rlike '[A-Za-z]'"))
    # what the operator says of these documents is what goes on
    names, models = language.text_models(before.select("text", "lang"), "lang")
    said = language.identify(language.rows_of(before, [before["doc_id"]], before["text"], before["source"], False), names, models)
    want = {r.payload.doc_id: r.lang for r in said.filter("accepted AND lang IS NOT NULL").collect()}
    got = {r.doc_id: r.lang for r in after.select("doc_id", "lang").collect()}
    assert len(want) > 100 and all(got[d] == x for d, x in want.items())
    before, after = stages["exact_dedup"]
    best = {}
    for d, t in pairs(before):
        best[t.translate(brute.AZ)] = max(d, best.get(t.translate(brute.AZ), -1))
    assert ids(after) == sorted(best.values())
    before, after = stages["near_dedup"]
    classes = {}
    for d, c, _, _ in brute.near(pairs(before)):
        classes[c] = max(d, classes.get(c, -1))
    assert ids(after) == sorted(classes.values())
    before, after = stages["decontaminate"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    assert ids(after) == sorted(x[0] for x in brute.contamination(pairs(before), items) if not x[-1])
    before, after = stages["mix"]
    assert set(ids(after)) <= set(ids(before)) and {"mix_shard", "mix_pass"} <= set(after.columns)


def test_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs, sf_small):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, sf_small).count() == 0
        assert stage(spark, odd_docs, sf_small).columns[:len(odd_docs.columns)] == odd_docs.columns


def test_run(spark, sf_small):
    assert corpus_pipeline.run(spark, sf_small).count() > 100
