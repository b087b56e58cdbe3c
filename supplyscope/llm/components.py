"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyscope.llm.work import stash


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); the root is the
    least node of the component.

    Labels spread over the edges and then jump to their label's label, so the
    rounds grow with the logarithm of a component's diameter.  Each round is
    two joins and a combined minimum; a node with very many edges is a skewed
    join key that Spark splits.  Each round's labels are a written table.
    """
    both = stash(edges.select("a", "b").union(edges.select("b", "a")).toDF("node", "other").distinct(), "cc-edges")
    labels = both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root"))
    labels = stash(labels.withColumn("moved", F.lit(True)), "cc-labels")
    while labels.filter("moved").limit(1).count():
        old = labels.select("node", "root")
        spread = both.join(old.select(F.col("node").alias("other"), "root"), "other").select("node", "root")
        least = spread.union(old).groupBy("node").agg(F.min("root").alias("root"))
        least = stash(least, "cc-least")
        jump = least.select(F.col("node").alias("root"), F.col("root").alias("far"))
        nearer = least.join(jump, "root").select("node", F.least("root", "far").alias("root"))
        before = old.withColumnRenamed("root", "was")
        labels = stash(nearer.join(before, "node").select("node", "root", (F.col("root") < F.col("was")).alias("moved")),
                       "cc-labels")
    return labels.select("node", "root")
