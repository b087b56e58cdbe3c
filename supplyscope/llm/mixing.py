"""Mixing sources to target weights (operator 7).

Sources get word targets by weight, none above twice its size.  A source's
rows are put in a random order by a hash; it gives whole passes of its rows
and, for the rest of its target, a prefix of that order.  The order is cut
into blocks, and the block instances (block, pass) are dealt to output shards:
a splitting tree halves the shards and draws, by a multivariate hypergeometric
law, how many instances of each source go left, until each shard has its exact
quotas.  A shard takes its quota of each source's instances from disjoint
stretches of a second random order, and its rows are shuffled locally.

Every shard finds its own path through the tree from seeds of the nodes on it,
so the tree is never held in one place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyscope.llm.work import merge_join, named, session, stash, text_or_empty

# The weights by source rank, the mix's size and the cap.
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0
BLOCK_ROWS = 64
SHARD_WORDS = 1_000_000
#: Quota vectors have one entry a pool: a source, or a hash of sources beyond this many.
POOLS = 65_536
WORD = r"[^\x20\x09-\x0D]+"


def source_key(source: Column) -> Column:
    """Non-null join key: a null source differs from every string."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def targets(sources: DataFrame, share: float, cap: float, weights: tuple) -> DataFrame:
    """Adds weight and target to one row per source (source, key, source_size).

    Water filling: sources by capacity per weight; those whose capacity is
    below the level that the rest would get are full, the others share what is
    left by weight.  The window is over one row per source."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (rank % len(weights) + 1).cast("int"))
    w = sources.withColumn("weight", weight).withColumn("room", F.col("source_size") * F.lit(cap))
    order = Window.orderBy(F.col("room") / F.col("weight"), "key")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(share)
    w = w.withColumn("left", total - F.coalesce(F.sum("room").over(before), F.lit(0.0)))
    w = w.withColumn("level", F.col("left") / F.sum("weight").over(after))
    w = w.withColumn("full", F.col("level") * F.col("weight") >= F.col("room"))
    # the level of the first source that isn't full holds for all after it
    level = F.min(F.when(~F.col("full"), F.col("level"))).over(Window.partitionBy())
    first = F.min(F.when(~F.col("full"), F.struct(F.col("room") / F.col("weight"), "key", "level"))).over(Window.partitionBy())
    target = F.when(F.col("full") | level.isNull(), F.col("room")).otherwise(
        F.least(F.col("room"), first["level"] * F.col("weight")))
    return w.withColumn("target", target).select("source", "key", "source_size", "n_rows", "target")


def quotas(spark, pools: np.ndarray, shards: int, seed: int) -> DataFrame:
    """(pool, k, shard): which shard takes a pool's k-th block instance.

    ``pools``: instances by pool.  Each shard walks the splitting tree."""
    shipped = spark.sparkContext.broadcast(pools)

    def walk(batches):
        for b in batches:
            for shard in b.column(0).to_pylist():
                count, start = shipped.value.copy(), np.zeros(len(shipped.value), np.int64)
                low, high = 0, shards
                while high - low > 1:
                    mid = (low + high) // 2
                    rng = np.random.default_rng([seed, low, high])
                    take = int(count.sum()) * (mid - low) // (high - low)
                    left = rng.multivariate_hypergeometric(count, take, method="marginals") if take else np.zeros_like(count)
                    if shard < mid:
                        count, high = left, mid
                    else:
                        count, start, low = count - left, start + left, mid
                has = np.flatnonzero(count)
                for i in range(0, len(has), 4096):
                    p = has[i:i + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(p, pa.int64()), pa.array(start[p], pa.int64()), pa.array(count[p], pa.int64()),
                         pa.array(np.full(len(p), shard), pa.int64())], names=["pool", "start", "quota", "shard"])
    runs = spark.range(shards).mapInArrow(walk, "pool long, start long, quota long, shard long")
    k = F.explode(F.sequence("start", F.col("start") + F.col("quota") - 1))
    return runs.select("pool", k.alias("k"), "shard")


def order_hash(id_col: Column, text: Column, seed: int) -> Column:
    """A row's place in its source's random order."""
    return F.xxhash64(id_col, text, F.lit(seed))


def apart(rows: DataFrame, many: DataFrame) -> DataFrame:
    """``rows`` with a place of its own for every row: of those that share one
    of the places ``many``, copies of an id and text, each hashes its number in.

    Numbers come from a table that is written first: a row's place in its
    partition, plus the group's rows in the partitions before, so a group of
    any size is numbered by many tasks."""
    if many.isEmpty():
        return rows
    both = merge_join(rows, many.withColumn("many", F.lit(True)), "place", "left")
    copies = stash(both.where("many").drop("many").withColumn("m", F.monotonically_increasing_id()), "mix-copied-rows")
    copies = copies.withColumn("part", F.shiftright("m", 33))
    sizes = copies.groupBy("place", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("place").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    local = F.row_number().over(Window.partitionBy("place", "part").orderBy("m"))
    numbered = merge_join(copies.withColumn("local", local), sizes, ["place", "part"])
    number = F.col("before") + F.col("local")
    copies = numbered.withColumn("place", F.xxhash64("place", number))
    return both.where("many IS NULL").select(*rows.columns).unionByName(copies.select(*rows.columns))


def block_of(place: Column, blocks: Column) -> Column:
    """The block of a place: equal ranges of the hash."""
    unit = F.shiftrightunsigned(place, 11).cast("double") / F.lit(float(2 ** 53))
    # unsigned order of the hash, so that a block is a range of it
    return F.floor(unit * blocks)


class Mix:
    """Plan of a mix: ``sized`` (payload, key, size, place), ``sources`` (key,
    source_size, target, blocks, passes, cut) and ``instances`` (key, block,
    pass, shard).

    Null and empty texts have size 0, null sources are a source of their own;
    rows that repeat an id (or have none) and a text are rows of their own, each
    at a place of its own in the order; an empty table gives an empty mix; a long
    text is one row like any other; only id, text and source are read."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 share: float = SHARE, cap: float = CAP, weights: tuple = WEIGHTS, block_rows: int = BLOCK_ROWS,
                 shard_words: int = SHARD_WORDS, seed: int = 7):
        spark = session(docs)
        text = text_or_empty(docs[text_col])
        self.sized = stash(docs.select(
            docs[id_col].alias("id"), docs[source_col].cast("string").alias("source"), source_key(docs[source_col]).alias("key"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
            order_hash(docs[id_col], text, seed).alias("place")), "mix-sized")
        self.many = stash(self.sized.groupBy("place").agg(F.count("*").alias("n")).where("n > 1").select("place"), "mix-many")
        self.sized = apart(self.sized, self.many)
        totals = self.sized.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"),
                                               F.count("*").alias("n_rows"))
        sources = targets(totals, share, cap, weights)
        passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(0)
        sources = sources.withColumn("passes", passes.cast("long")).withColumn(
            "rest", F.greatest(F.lit(0.0), F.col("target") - F.col("passes") * F.col("source_size"))).withColumn(
            "blocks", F.ceil(F.col("n_rows") / block_rows))
        self.sources = stash(sources.drop("n_rows"), "mix-sources")
        n_sources = self.sources.count()

        rows = self.with_source(self.sized.select("key", "size", "place"), n_sources, "blocks")
        rows = rows.withColumn("block", block_of(F.col("place"), F.col("blocks")))
        blocks = rows.groupBy("key", "block").agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
        blocks = blocks.withColumn("before", F.coalesce(upto, F.lit(0)))
        blocks = merge_join(blocks, self.sources.select("key", "passes", "rest"), "key")
        whole = F.col("before") + F.col("words") <= F.col("rest")
        part = ~whole & (F.col("before") < F.col("rest"))
        blocks = stash(blocks.withColumn("whole", whole).withColumn("part", part), "mix-blocks")

        # the block in which a source's rest ends: rows by place until nearest to it
        ends = blocks.filter("part").select("key", "block", (F.col("rest") - F.col("before")).alias("room"))
        inside = merge_join(rows.select("key", "block", "size", "place"), ends, ["key", "block"])
        run = F.sum("size").over(Window.partitionBy("key", "block").orderBy(self.unsigned("place")).rangeBetween(
            Window.unboundedPreceding, 0))
        taken = inside.withColumn("run", run).filter(F.col("run") - F.col("size") / 2 <= F.col("room"))
        cuts = taken.groupBy("key").agg(F.max(self.unsigned("place")).alias("cut"))
        self.sources = stash(merge_join(self.sources, merge_join(ends.select("key", F.col("block").alias("last")), cuts, "key", "left"),
                                        "key", "left"), "mix-cuts")

        times = F.col("passes") + F.when(F.col("whole") | F.col("part"), 1).otherwise(0)
        passes_of = F.sequence(F.lit(0).cast("long"), times.cast("long") - 1)
        copies = blocks.filter(times > 0).select("key", "block", F.explode(passes_of).alias("pass"))
        pool = F.pmod(F.xxhash64("key"), F.lit(POOLS)) if n_sources > POOLS else None
        numbered = self.sources.select("key", (pool if pool is not None else F.row_number().over(Window.orderBy("key")) - 1)
                                       .cast("long").alias("pool"))
        copies = merge_join(copies, stash(numbered, "mix-pools"), "key")
        place = F.row_number().over(Window.partitionBy("pool").orderBy(F.xxhash64("key", "block", "pass", F.lit(seed)), "key", "block", "pass"))
        copies = stash(copies.withColumn("k", (place - 1).cast("long")), "mix-copies")
        counts = np.zeros(min(n_sources, POOLS), np.int64)
        for r in copies.groupBy("pool").count().collect():
            counts[r[0]] = r[1]
        words = self.sources.agg(F.sum("target")).first()[0] or 0.0
        self.shards = int(max(1, min(-(-words // shard_words), counts.sum() or 1)))
        dealt = quotas(spark, counts, self.shards, seed)
        self.instances = stash(merge_join(copies, dealt, ["pool", "k"]).select("key", "block", "pass", "shard"), "mix-instances")
        self.n_sources = n_sources
        self.seed = seed

    @staticmethod
    def unsigned(place) -> Column:
        """The hash as a long in its unsigned order."""
        return F.col(place).bitwiseXOR(F.lit(-(2 ** 63)).cast("long"))

    def with_source(self, rows: DataFrame, n_sources: int, *cols: str) -> DataFrame:
        """Adds columns of ``sources``; broadcast only if there are few."""
        side = self.sources.select("key", *cols)
        return rows.join(F.broadcast(side), "key") if n_sources <= POOLS else merge_join(rows, side, "key")

    def chosen(self) -> Column:
        """Whether a row (with its block, pass and source columns) is taken in
        the pass: all rows in whole passes, a prefix in the last."""
        in_prefix = F.col("last").isNull() | (F.col("block") < F.col("last")) | (
            (F.col("block") == F.col("last")) & F.coalesce(self.unsigned("place") <= F.col("cut"), F.lit(False)))
        return (F.col("pass") < F.col("passes")) | in_prefix


def mix_report(mix: Mix) -> DataFrame:
    """One row per input row: id, size, source_size, target (its source's),
    taken (words the mix takes, repeats counted), shards (of its instances).
    Edge cases are those of ``Mix``."""
    rows = mix.with_source(mix.sized, mix.n_sources, "source_size", "target", "blocks", "passes", "last", "cut")
    rows = rows.withColumn("block", block_of(F.col("place"), F.col("blocks")))
    dealt = stash(mix.instances.groupBy("key", "block").agg(
        F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("dealt")), "mix-dealt")
    out = merge_join(rows, dealt, ["key", "block"], "left")
    in_last = F.col("last").isNull() | (F.col("block") < F.col("last")) | (
        (F.col("block") == F.col("last")) & F.coalesce(Mix.unsigned("place") <= F.col("cut"), F.lit(False)))
    mine = F.filter(F.coalesce(F.col("dealt"), F.array().cast("array<struct<pass:bigint,shard:bigint>>")),
                    lambda d: (d["pass"] < F.col("passes")) | in_last)
    return out.select("id", "size", "source_size", "target", (F.col("size") * F.size(mine)).alias("taken"),
                      F.array_join(F.transform(mine, lambda d: d["shard"].cast("string")), ",").alias("shards"))


def mixed_rows(docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: the columns of ``docs``, whatever their names, and
    ``mix_shard``, ``mix_pass``; a shard's rows lie in one partition, shuffled,
    maybe beside other shards.  Edge cases are those of ``Mix``; which of rows
    with equal id and text is taken, is not told by their other columns."""
    text = text_or_empty(docs[text_col])
    rows = docs.select(F.struct(*(named(docs, c).alias(c) for c in docs.columns)).alias("payload"), source_key(docs[source_col]).alias("key"),
                       order_hash(docs[id_col], text, mix.seed).alias("place"))
    rows = mix.with_source(apart(rows, mix.many), mix.n_sources, "blocks", "passes", "last", "cut")
    rows = rows.withColumn("block", block_of(F.col("place"), F.col("blocks")))
    taken = merge_join(rows, mix.instances, ["key", "block"]).filter(mix.chosen())
    out = taken.repartition("shard").sortWithinPartitions("shard", F.xxhash64("place", "pass", F.lit(mix.seed)), "place")
    return out.select("payload.*", F.col("shard").alias("mix_shard"), F.col("pass").alias("mix_pass"))
