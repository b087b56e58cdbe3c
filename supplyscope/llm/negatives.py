"""Hard negatives by angular triangle filtering (operator 13).

Vectors become integers, so a score (inner product) is exact.  Each row stores
its angles to a few reference directions.  For a query and a row, every
reference bounds the angle between them from both sides by the triangle
inequality on the sphere; the cosines of the bounds times both norms, widened
for rounding, bound the score.  Only pairs whose bounds overlap a window that is
still open are scored.  The same is tried first for runs of rows together.

Rows are dealt to blocks by a hash, so a label or a vector that a third of the
rows share is spread like any other; every block meets every block of queries in
an equi-join on the block's number, and a pair of blocks is one task's smallest
piece of work.  Only each query's best rows of a block are passed on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyscope.llm.work import merge_join, session, stash

#: Reference directions, and the rows (least hashes) that they are chosen from.
REFERENCES = 12
SAMPLE = 512
#: Rows and queries of a block, and bytes of its numbers.
BLOCK_ROWS, BLOCK_QUERIES, BLOCK_BYTES = 4096, 512, 4 << 20
#: Rows that are bounded together, neighbours by their nearest reference.
RUN_ROWS = 128
#: An angle's error: arccos near 1 turns 4e-15 into 9e-8, 32 bits add 1.2e-7.
ANGLE_SLACK = 1e-6
SCORE_SLACK = 1e-9
EXACT_DOUBLE, EXACT_LONG = 2.0 ** 53, 2.0 ** 62


def integers(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component; beyond 63 bits an error."""
    def one(x):
        y = F.lit(float(scale)) * x
        return F.when(F.abs(y) < 2.0 ** 63, F.floor(y)).otherwise(
            F.raise_error(F.lit("a scaled component does not fit into a long")).cast("long"))
    return F.transform(vector.cast("array<double>"), one)


def finite(vector: Column) -> Column:
    def ok(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vector.isNotNull() & F.forall(vector.cast("array<double>"), ok)


def matrix(lists: list, dims: int) -> np.ndarray:
    """Rows of integers, shorter ones continued with zeros."""
    out = np.zeros((len(lists), dims), np.int64)
    for i, x in enumerate(lists):
        out[i, :len(x)] = x
    return out


def directions(rows: DataFrame, dims: int) -> np.ndarray:
    """Unit vectors far from one another, out of a bounded sample: any choice
    gives the same result, a spread one tighter bounds."""
    sample = rows.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE).collect()
    x = matrix([r.vec for r in sample], dims).astype(np.float64)
    size = np.linalg.norm(x, axis=1)
    x = x[size > 0] / size[size > 0, None]
    if not len(x):
        return np.zeros((0, dims))
    chosen, nearest = [0], x @ x[0]
    while len(chosen) < min(REFERENCES, len(x)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    return x[chosen]


BLOCK_TYPE = ("block long, labels array<string>, starts array<long>, uids binary, ids array<long>, vecs binary, "
              "norms binary, angles binary, windows array<array<long>>")


def packed(refs: np.ndarray, dims: int):
    """mapInArrow function: the rows of (block, label, uid, id, vec, windows),
    sorted by block, as one row a block; inside, rows stand by label, nearest
    reference and angle to it."""
    def pack(block, rows):
        label = np.array([r["label"] for r in rows], dtype=object)
        vecs = matrix([r["vec"] for r in rows], dims)
        wide = vecs.astype(np.float64)
        norms = np.linalg.norm(wide, axis=1)
        cos = np.divide(wide @ refs.T, norms[:, None], out=np.zeros((len(rows), len(refs))), where=norms[:, None] > 0)
        angles = np.arccos(np.clip(cos, -1, 1)).astype(np.float32)
        names, code = np.unique(label, return_inverse=True)
        cell = angles.argmin(axis=1) if len(refs) else np.zeros(len(rows), np.int64)
        near = angles.min(axis=1) if len(refs) else np.zeros(len(rows))
        order = np.lexsort((near, cell, code))
        starts = np.searchsorted(code[order], np.arange(len(names) + 1))
        rows = [rows[i] for i in order]
        return {"block": block, "labels": names.tolist(), "starts": starts.tolist(),
                "uids": np.array([r["uid"] for r in rows], np.int64).tobytes(), "ids": [r["id"] for r in rows],
                "vecs": vecs[order].tobytes(), "norms": norms[order].tobytes(), "angles": angles[order].tobytes(),
                "windows": [r["windows"] for r in rows]}

    def run(batches):
        block, held = None, []
        for b in batches:
            for r in b.to_pylist():
                if held and r["block"] != block:
                    yield as_batch([pack(block, held)])
                    held = []
                block = r["block"]
                held.append(r)
        if held:
            yield as_batch([pack(block, held)])

    kind = pa.schema([("block", pa.int64()), ("labels", pa.list_(pa.string())), ("starts", pa.list_(pa.int64())),
                      ("uids", pa.binary()), ("ids", pa.list_(pa.int64())), ("vecs", pa.binary()), ("norms", pa.binary()),
                      ("angles", pa.binary()), ("windows", pa.list_(pa.list_(pa.int64())))])

    def as_batch(found):
        return pa.RecordBatch.from_pylist(found, schema=kind)
    return run


def in_blocks(rows: DataFrame, count: int, most: int, refs: np.ndarray, dims: int) -> DataFrame:
    """Rows of (uid, id, label, vec, windows) packed in blocks of about as many
    rows as ``most`` and the bound on bytes allow, dealt by a hash."""
    size = max(16, min(most, BLOCK_BYTES // (8 * max(1, dims))))
    blocks = -(-count // size)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)))
    dealt = dealt.repartition("block").sortWithinPartitions("block").select("block", "label", "uid", "id", "vec", "windows")
    return dealt.mapInArrow(packed(refs, dims), BLOCK_TYPE)


class Block:
    """A packed block, opened."""

    def __init__(self, row: dict, prefix: str, refs: int, dims: int):
        at = {k.removeprefix(prefix): v for k, v in row.items() if k.startswith(prefix)}
        self.labels, self.starts = at["labels"], at["starts"]
        self.uids = np.frombuffer(at["uids"], np.int64)
        self.known = np.array([i is not None for i in at["ids"]])
        self.ids = np.array([0 if i is None else i for i in at["ids"]], np.int64)
        n = len(self.uids)
        self.vecs = np.frombuffer(at["vecs"], np.int64).reshape(n, dims)
        self.norms = np.frombuffer(at["norms"])
        self.angles = np.frombuffer(at["angles"], np.float32).reshape(n, refs).astype(np.float64)
        self.windows = at["windows"]

    def of(self, label: str) -> tuple[int, int]:
        """Where the rows of a label stand."""
        if label not in self.labels:
            return 0, 0
        i = self.labels.index(label)
        return self.starts[i], self.starts[i + 1]


def score_bounds(low_angle, high_angle, least_norms, most_norms):
    """Bounds of scores whose angle and product of norms lie in the intervals."""
    top, bottom = np.cos(np.clip(low_angle, 0, np.pi)), np.cos(np.clip(high_angle, 0, np.pi))
    slack = most_norms * SCORE_SLACK + 1
    return (np.minimum(bottom * least_norms, bottom * most_norms) - slack,
            np.maximum(top * least_norms, top * most_norms) + slack)


def angle_bounds(query, low, high):
    """Angles between queries (n, refs) and rows whose angles to each reference
    lie between ``low`` and ``high`` (m, refs); (n, m) each."""
    least = np.zeros((len(query), len(low)))
    most = np.full(least.shape, np.pi)
    for r in range(query.shape[1]):
        q, a, b = query[:, r, None], low[None, :, r], high[None, :, r]
        np.maximum(least, np.maximum(q - b, a - q), out=least)
        np.minimum(most, np.minimum(q + b, 2 * np.pi - q - a), out=most)
    return least - 2 * ANGLE_SLACK, most + 2 * ANGLE_SLACK


def scores(queries: np.ndarray, rows: np.ndarray, bound: float) -> np.ndarray:
    """All inner products, exact: doubles hold them below 2^53, as no partial
    sum exceeds the product of the norms; then longs."""
    if bound < EXACT_DOUBLE:
        return np.rint(queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    if bound < EXACT_LONG:
        return queries @ rows.T
    raise OverflowError("scores do not fit into a long")


def windowed(q: Block, mine: slice, rows: Block, ranges, low: np.ndarray, high: np.ndarray, keep: int):
    """Best rows of the ranges for queries ``mine``: for each query and window
    k with low <= score <= high, (query, k, score, row) of the ``keep`` highest
    scores and all that equal the last of them.

    ``low`` rises as rows are found, so ever fewer bounds overlap a window."""
    low, vecs, angles, norms, uids = low.copy(), q.vecs[mine], q.angles[mine], q.norms[mine], q.uids[mine]
    best = np.full((*low.shape, keep), np.iinfo(np.int64).min)
    found = []
    for begin, end in ranges:
        cuts = np.arange(begin, end, RUN_ROWS)
        if not len(cuts):
            continue
        a, b = np.minimum.reduceat(rows.angles[:end], cuts), np.maximum.reduceat(rows.angles[:end], cuts)
        short, long = np.minimum.reduceat(rows.norms[:end], cuts), np.maximum.reduceat(rows.norms[:end], cuts)
        worst, most = score_bounds(*angle_bounds(angles, a, b), norms[:, None] * short, norms[:, None] * long)
        for c, i in enumerate(cuts):
            part = slice(i, min(i + RUN_ROWS, end))
            open_ = (most[:, c, None] >= low) & (worst[:, c, None] <= high) & (low <= high)
            who = np.flatnonzero(open_.any(axis=1))
            if not len(who):
                continue
            product = norms[who][:, None] * rows.norms[part]
            least, greatest = score_bounds(*angle_bounds(angles[who], rows.angles[part], rows.angles[part]), product, product)
            near = np.zeros(least.shape, bool)
            for k in range(low.shape[1]):
                near |= (greatest >= low[who, k, None]) & (least <= high[who, k, None])
            near &= uids[who][:, None] != rows.uids[part]
            wanted = near.any(axis=1)
            who, near = who[wanted], near[wanted]
            if not len(who):
                continue
            cols = np.flatnonzero(near.any(axis=0))
            near, place = near[:, cols], i + cols
            got = scores(vecs[who], rows.vecs[place], float(product.max()))
            for k in range(low.shape[1]):
                hit = near & (got >= low[who, k, None]) & (got <= high[who, k, None])
                x, y = np.nonzero(hit)
                if not len(x):
                    continue
                found.append((who[x], np.full(len(x), k), got[x, y], place[y]))
                both = np.concatenate([best[who, k], np.where(hit, got, np.iinfo(np.int64).min)], axis=1)
                best[who, k] = np.partition(both, both.shape[1] - keep, axis=1)[:, -keep:]
                low[who, k] = np.maximum(low[who, k], best[who, k].min(axis=1))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    who, k, score, row = (np.concatenate(x) for x in zip(*found, strict=True))
    still = score >= low[who, k]
    return who[still], k[still], score[still], row[still]


def first_of(who, k, score, known, ids, keep: int) -> np.ndarray:
    """Places of the first ``keep`` of each (query, window): high scores first,
    then small ids, null ids last."""
    order = np.lexsort((ids, ~known, -score, k, who))
    w, g = who[order], k[order]
    new = np.r_[True, (w[1:] != w[:-1]) | (g[1:] != g[:-1])] if len(w) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(new, np.arange(len(w)), 0))
    return order[np.arange(len(w)) - start < keep]


HITS = pa.schema([("uid", pa.int64()), ("k", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])
HIT_TYPE = "uid long, k int, score long, id long"


def searched(refs: int, dims: int, keep: int, low_part: int | None, high_part: int | None):
    """mapInArrow function over pairs of blocks: without parts the best rows of
    each query's own label, with them the best rows of other labels in each of
    its windows."""
    least, most = np.iinfo(np.int64).min, np.iinfo(np.int64).max

    def pair(q: Block, rows: Block):
        for i, label in enumerate(q.labels):
            mine = slice(q.starts[i], q.starts[i + 1])
            begin, end = rows.of(label)
            n = mine.stop - mine.start
            if low_part is None:
                low, high, ranges = np.full((n, 1), least), np.full((n, 1), most), [(begin, end)]
            else:
                windows = q.windows[mine]
                wide = max(map(len, windows))
                low, high = np.full((n, wide), most), np.full((n, wide), least)
                for j, mids in enumerate(windows):
                    for k, s in enumerate(mids):
                        # low_part * s <= 100 * score <= high_part * s
                        low[j, k], high[j, k] = -(-low_part * s // 100), high_part * s // 100
                ranges = [(0, begin), (end, len(rows.uids))]
            who, k, score, row = windowed(q, mine, rows, ranges, low, high, keep)
            at = first_of(who, k, score, rows.known[row], rows.ids[row], keep)
            yield (q.uids[mine][who[at]], k[at], score[at], pa.array(rows.ids[row[at]], mask=~rows.known[row[at]]))

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                for uid, k, score, ids in pair(Block(r, "q_", refs, dims), Block(r, "r_", refs, dims)):
                    if len(uid):
                        yield pa.RecordBatch.from_arrays([pa.array(uid), pa.array(k.astype(np.int32)), pa.array(score), ids],
                                                         schema=HITS)
    return run


def hard_negatives(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", scale: float = 256.0, positives: int = 5, negatives: int = 5,
                   low_part: int = 80, high_part: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score: for each anchor (a row where ``is_anchor`` holds) and each
    of its first ``positives`` other rows of the same label, the first
    ``negatives`` rows of other labels with low_part% <= negative / positive
    score <= high_part%.

    Scores are inner products of floor(``scale`` * x); high scores come first,
    then small ids, a null id last.  A row with a null label, a null vector or a
    component that is null or not finite takes no part.  A shorter vector counts
    as continued with zeros, an empty one scores 0.  Repeated rows are rows of
    their own, also as anchors (a row is only never its own positive).  An empty
    table gives no rows; other columns are not read.  Scores or components that
    do not fit into a long are an error.
    """
    spark = session(rows)
    vector = rows[vector_col]
    ready = rows.where(rows[label_col].isNotNull() & finite(vector)).select(
        rows[id_col].cast("long").alias("id"), rows[label_col].cast("string").alias("label"),
        integers(vector, scale).alias("vec"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    ready = stash(ready.withColumn("uid", F.monotonically_increasing_id()), "negatives-rows")
    known = ready.agg(F.count("*").alias("n"), F.count_if("anchor").alias("anchors"), F.max(F.size("vec")).alias("dims")).first()
    dims = known.dims or 0
    refs = directions(ready, dims)
    none = F.lit(None).cast("array<long>").alias("windows")
    blocks = stash(in_blocks(ready.select("uid", "id", "label", "vec", none), max(1, known.n), BLOCK_ROWS, refs, dims), "negatives-blocks")
    queries = ready.where("anchor").select("uid", "id", "label", "vec")

    def search(asked: DataFrame, keep: int, low: int | None, high: int | None) -> DataFrame:
        """The first ``keep`` of every (uid, k) over all blocks."""
        every = -(-max(1, known.n) // max(16, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(1, dims)))))
        packs = in_blocks(asked, max(1, known.anchors), BLOCK_QUERIES, refs, dims)
        left = packs.select(*[F.col(c).alias(f"q_{c}") for c in packs.columns]).withColumn(
            "block", F.explode(F.sequence(F.lit(0), F.lit(every - 1)).cast("array<long>")))
        right = blocks.select(*[F.col(c).alias(f"r_{c}") for c in blocks.columns], F.col("block"))
        hits = merge_join(left, right, "block").drop("block").mapInArrow(searched(len(refs), dims, keep, low, high), HIT_TYPE)
        first = Window.partitionBy("uid", "k").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        return hits.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= keep)

    near = stash(search(queries.withColumn("windows", none), positives, None, None).select(
        "uid", (F.col("rank") - 1).alias("k"), F.col("score").alias("positive_score"), F.col("id").alias("positive_id")), "negatives-near")
    mids = near.groupBy("uid").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "positive_score"))),
                                               lambda x: x["positive_score"]).alias("windows"))
    hard = search(merge_join(queries, mids, "uid"), negatives, low_part, high_part)
    named = merge_join(merge_join(hard, near, ["uid", "k"]), queries.select("uid", F.col("id").alias("anchor_id")), "uid")
    return named.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                        F.col("score").alias("negative_score"))
