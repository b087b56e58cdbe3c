"""What a task holds doesn't grow with the table."""

import brute
import numpy as np
from pyspark.sql import functions as F

from supplyscope.llm import repeats


def test_repeats_hold_few_chunks_a_file_and_few_answers_a_chunk(spark, monkeypatch):
    """Spark decodes thousands of rows of a file at once, and a chunk had an answer for each bucket."""
    seen, before = {}, repeats.Repeats.with_answers

    def with_answers(self, answered):
        seen.update(run=self, answered=answered)
        return before(self, answered)
    monkeypatch.setattr(repeats.Repeats, "with_answers", with_answers)
    rng = np.random.default_rng(5)
    shared = "".join(rng.choice(list("abcdefgh "), 900))
    docs = [(i, "".join(rng.choice(list("ijklmnop "), 1500)) + shared[:300 + 20 * (i % 30)]) for i in range(90)]
    out = repeats.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(2), chunk_bytes=4000, bucket_names=40)
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect())
    assert got == sorted(brute.repeats(docs)) and any(r[2] for r in got)
    chunks = [r["count"] for r in seen["run"].chunks.groupBy(F.input_file_name()).count().collect()]
    assert sum(chunks) > 32 and max(chunks) <= 16
    bits, _ = seen["run"].layout(seen["run"].bytes // 4, (2, 35), 122)
    most = seen["answered"][2].agg(F.max(F.size("got"))).first()[0]
    assert 2 ** bits > 1000 and most <= int(spark.conf.get("spark.sql.shuffle.partitions"))
