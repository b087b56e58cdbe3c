"""Random forest of two classes by histograms (MLD1).

As MLlib grows it: level by level, each node choosing the best Gini split among
a random subset of ceil(sqrt(n)) features at no more than ``BINS`` bins, each
tree on a Poisson(1) bootstrap of the rows; two leaves that predict one class
become one.  A level is one pass: tasks count rows by tree, node, feature, bin
and class in numpy, counts of a tree are added up by one reducer, which finds
its splits, and the driver holds the trees.  Rows are stored once, binned, as
two numbers; places in trees and bootstrap draws are found anew at each level,
so nothing of a hundred numbers a row is kept.

A draw is a hash of the row's own ``draw`` column, so a forest is the same on
any cluster and for any order of the rows; rows with one draw are drawn alike.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyscope.session import written

#: Bins of a feature, and bits that a feature's bin takes in a packed row (the lowest is 0); the label is above them.
BINS, STRIDE, LABEL_BIT = 32, 6, 60
#: Rows that a task walks at once.
BLOCK = 1 << 18
#: Poisson(1) by the sixteen bits of a draw.
POISSON = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(9)]), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


def packed(columns: list[np.ndarray], cuts: list[np.ndarray]) -> np.ndarray:
    """The bins of each row in one number: bin b of a feature holds the values
    above ``cuts[b - 1]`` up to ``cuts[b]``."""
    out = np.zeros(len(columns[0]), np.int64)
    for k, (x, cut) in enumerate(zip(columns, cuts, strict=True)):
        out |= np.searchsorted(cut, x).astype(np.int64) << (STRIDE * k + 1)
    return out


class Walk:
    """One tree's levels as tables: the place of a node's feature, and the next
    level's node by node and bin; the node past the last is where leaves go."""

    def __init__(self, feature: np.ndarray, cut: np.ndarray, levels: int):
        self.steps = []
        for level in range(levels):
            n = 1 << level
            f, c = feature[n - 1:2 * n - 1], cut[n - 1:2 * n - 1]
            child = 2 * np.arange(n)[:, None] + (np.arange(BINS) > c[:, None])
            child[f < 0] = 2 * n
            self.steps.append((np.append(np.maximum(f, 0) * STRIDE + 1, 1), np.append(child.ravel(), np.full(BINS, 2 * n))))

    def nodes(self, rows: np.ndarray) -> np.ndarray:
        """Each row's node of the level after the last."""
        at = np.zeros(len(rows), np.int64)
        for place, child in self.steps:
            b = place.take(at)
            np.right_shift(rows, b, out=b)
            b &= BINS - 1
            at <<= 5
            at |= b
            at = child.take(at)
        return at


def blocks(batches):
    """Arrays of the batches' columns, BLOCK rows or a little more at a time."""
    held, n = [], 0
    for b in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in b.columns])
        n += b.num_rows
        if n >= BLOCK:
            yield [np.concatenate(c) for c in zip(*held, strict=True)]
            held, n = [], 0
    if n:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def counter(feature: np.ndarray, cut: np.ndarray, level: int, subsets: np.ndarray, odds: np.ndarray):
    """Task of a level: (packed, boot) rows to (tree, counts by node, feature of
    the node's subset, bin and class)."""
    def count(batches):
        trees, _, k = subsets.shape
        nodes = 1 << level
        walks = [Walk(f, c, level) for f, c in zip(feature, cut, strict=True)]
        places = np.zeros((trees, k, nodes + 1), np.int64)
        places[:, :, :-1] = (subsets * STRIDE).transpose(0, 2, 1)
        sums = np.zeros((trees, k, nodes * 2 * BINS), np.int32)
        size = sums.shape[2]
        for rows, boot in blocks(batches):
            label = rows >> LABEL_BIT
            for t in range(trees):
                if t % 2 == 0:
                    drawn = (boot.view(np.uint64) * odds[t // 2]).view(np.uint16)
                times = POISSON.take(drawn[3 - t % 2::4])
                hit = np.flatnonzero(times)
                mine, weight = rows.take(hit), times.take(hit).astype(float)
                at = walks[t].nodes(mine)
                base = at << 6
                base |= label.take(hit)
                for j in range(k):
                    b = places[t, j].take(at)
                    np.right_shift(mine, b, out=b)
                    b &= 2 * BINS - 2
                    b |= base
                    sums[t, j] += np.bincount(b, weight, size + 2 * BINS)[:size].astype(np.int32)
        for t in range(trees):
            if (top := sums[t].max(initial=0)) > 0:
                kind = next(d for d in (np.uint8, np.uint16, np.int32) if top <= np.iinfo(d).max)
                yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([np.dtype(kind).itemsize], pa.int32()),
                                                  pa.array([sums[t].astype(kind).tobytes()], pa.binary())], names=["tree", "width", "counts"])
    return count


def gini(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
    n = np.maximum(zero + one, 1e-300)
    return 1 - (zero / n) ** 2 - (one / n) ** 2


def best_splits(counts: np.ndarray, subset: np.ndarray, weights: tuple[float, float]) -> dict[str, np.ndarray]:
    """Of each node with rows: its weights by class, the feature (-1: none
    gains), bin and gain of its best split, and the left side's weights.
    ``counts`` by feature of the subset, node, bin and class."""
    k, nodes = len(counts), counts.shape[1]
    left = counts.cumsum(axis=2)
    rows_left, rows = left.sum(axis=3), counts[0].sum(axis=(1, 2))
    left = left * np.array(weights)
    whole = left[0, :, -1]
    a0, a1 = left[..., 0], left[..., 1]
    b0, b1 = whole[None, :, None, 0] - a0, whole[None, :, None, 1] - a1
    all_ = np.maximum(whole.sum(axis=1), 1e-300)[None, :, None]
    gain = gini(whole[:, 0], whole[:, 1])[None, :, None] - ((a0 + a1) * gini(a0, a1) + (b0 + b1) * gini(b0, b1)) / all_
    gain[(rows_left == 0) | (rows_left == rows[None, :, None])] = -1
    flat = gain.transpose(1, 0, 2).reshape(nodes, k * BINS)
    best = flat.argmax(axis=1)
    node, which, bin_ = np.arange(nodes), best // BINS, best % BINS
    top = flat[node, best]
    use = np.flatnonzero(rows > 0)
    return {"node": node[use], "feature": np.where(top > 1e-15, subset[node, which], -1)[use], "bin": bin_[use], "gain": top[use],
            "zero": whole[use, 0], "one": whole[use, 1], "left_zero": left[which, node, bin_, 0][use], "left_one": left[which, node, bin_, 1][use]}


FOUND = "tree int, node int, feature int, bin int, gain double, zero double, one double, left_zero double, left_one double"


def reducer(level: int, subsets: np.ndarray, weights: tuple[float, float]):
    """Counts sorted by tree to the best splits of its nodes; one sum is held."""
    def reduce(batches):
        tree, total = None, None

        def out():
            found = best_splits(total, subsets[tree], weights)
            kinds = [pa.int32()] * 4 + [pa.float64()] * 5
            cols = [np.full(len(found["node"]), tree), *found.values()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["tree", *found])
        for b in batches:
            for t, width, counts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                more = np.frombuffer(counts, {1: np.uint8, 2: np.uint16, 4: np.int32}[width]).reshape(-1, 1 << level, BINS, 2)
                if t != tree and tree is not None:
                    yield out()
                total = more.astype(np.int64) if t != tree else total + more
                tree = t
        if tree is not None:
            yield out()
    return reduce


class Forest:
    """A fitted forest: trees as arrays of 2^(depth + 1) - 1 nodes, the children
    of node i at 2i + 1 and 2i + 2; a leaf has feature -1."""

    def __init__(self, features: list[str], cuts: list[np.ndarray], feature: np.ndarray, cut: np.ndarray, gain: np.ndarray, stats: np.ndarray):
        self.features, self.cuts, self.feature, self.cut, self.gain, self.stats = list(features), cuts, feature, cut, gain, stats

    @property
    def getNumTrees(self) -> int:  # noqa: N802, as MLlib's models
        return len(self.feature)

    def getCacheNodeIds(self) -> bool:  # noqa: N802
        """Rows walk the trees at each level."""
        return False

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802
        """Gains of a feature's splits by weight, each tree's scaled to 1."""
        shares = np.zeros((len(self.feature), len(self.features)))
        for share, f, g, s in zip(shares, self.feature, self.gain, self.stats, strict=True):
            inner = f >= 0
            np.add.at(share, f[inner], g[inner] * s[inner].sum(axis=1))
        total = shares.sum(axis=1, keepdims=True)
        mean = np.divide(shares, total, out=np.zeros_like(shares), where=total > 0).sum(axis=0)
        return Vectors.dense(mean / mean.sum() if mean.sum() else mean)

    def leaves(self) -> np.ndarray:
        """Share of class 1, each leaf's handed down to the nodes below."""
        whole = self.stats.sum(axis=2)
        p = np.divide(self.stats[:, :, 1], whole, out=np.zeros_like(whole), where=whole > 0)
        for i in range(self.feature.shape[1] // 2):
            over = self.feature[:, i] < 0
            for child in (2 * i + 1, 2 * i + 2):
                p[over, child] = p[over, i]
        return p

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``probability``: of class 1, the mean of the trees' leaves."""
        levels = int(math.log2(self.feature.shape[1] + 1)) - 1
        # a leaf sends its rows left, so that all end on the last level
        feature, cut = np.maximum(self.feature, 0), np.where(self.feature < 0, BINS, self.cut)
        p, cuts = self.leaves()[:, (1 << levels) - 1:], self.cuts

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            rows = packed([c.to_numpy(dtype=float) for c in columns], cuts)
            out = np.zeros(len(rows))
            for f, c, leaf in zip(feature, cut, p, strict=True):
                out += leaf.take(Walk(f, c, levels).nodes(rows))
            return pd.Series(out / len(feature))
        return df.withColumn("probability", score(*[F.col(c).cast("double") for c in self.features]))

    def save(self, spark: SparkSession, path: str) -> str:
        """One parquet row a tree."""
        rows = [(t, self.feature[t].tolist(), self.cut[t].tolist(), self.gain[t].tolist(), self.stats[t].ravel().tolist()) for t in range(len(self.feature))]
        spark.createDataFrame(rows, "tree int, feature array<int>, cut array<int>, gain array<double>, stats array<double>").coalesce(1).write.mode(
            "overwrite").parquet(f"{path}/trees")
        spark.createDataFrame([(self.features, [c.tolist() for c in self.cuts], len(rows))],
                              "features array<string>, cuts array<array<double>>, trees int").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> Forest:
        m, trees = spark.read.parquet(f"{path}/model").first(), spark.read.parquet(f"{path}/trees").orderBy("tree").collect()
        if m is None or len(trees) != m.trees:
            raise ValueError(f"the model at {path} is incomplete")
        return Forest(m.features, [np.array(c, float) for c in m.cuts], np.array([t.feature for t in trees]), np.array([t.cut for t in trees]),
                      np.array([t.gain for t in trees]), np.array([t.stats for t in trees]).reshape(len(trees), -1, 2))


def bin_cuts(rows: DataFrame, features: list[str]) -> list[np.ndarray]:
    """Where each feature's bins end: between all its values if there are at
    most BINS, else at its quantiles."""
    def few(batches):
        seen: list = [set() for _ in features]
        for b in batches:
            for s, c in zip(seen, b.columns, strict=True):
                if len(s) <= BINS:
                    s.update(np.unique(c.to_numpy(zero_copy_only=False)).tolist()[:BINS + 1])
        k, v = zip(*((k, x) for k, s in enumerate(seen) for x in sorted(s)[:BINS + 1]), strict=True) if any(seen) else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(v, pa.float64())], names=["k", "v"])
    data = rows.select(*[F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(features)])
    values: list = [[] for _ in features]
    for r in data.mapInArrow(few, "k int, v double").distinct().collect():
        values[r.k].append(r.v)
    if not all(values):
        raise ValueError("no rows to fit a forest on")
    many = [k for k, v in enumerate(values) if len(v) > BINS]
    shares = [i / BINS for i in range(1, BINS)]
    at = data.select(*[F.percentile_approx(f"x{k}", shares, 10000).alias(f"x{k}") for k in many]).first() if many else {}
    return [np.unique(at[f"x{k}"]) if k in many else (np.array(sorted(v))[1:] + np.array(sorted(v))[:-1]) / 2 for k, v in enumerate(values)]


def grow(rows: DataFrame, features: list[str], label: str, draw: str, weights: dict[int, float], num_trees: int, max_depth: int, seed: int) -> Forest:
    """Fit a forest on numeric features without nulls and a label 0 or 1, whose
    rows weigh ``weights[label]``.  At most 10 features, as a row is one number."""
    if STRIDE * len(features) > LABEL_BIT:
        raise ValueError(f"{len(features)} features don't fit a row of {LABEL_BIT} bits")
    cuts = bin_cuts(rows, features)

    def pack(batches):
        for b in batches:
            *columns, y, boot = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            yield pa.RecordBatch.from_arrays([pa.array(packed(columns, cuts) | (y.astype(np.int64) << LABEL_BIT)), pa.array(boot)], names=["packed", "boot"])
    binned = written(rows.select(*[F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(features)], (F.col(label) == 1).cast("int").alias("y"),
                                 F.xxhash64(draw, F.lit(seed)).alias("boot")).mapInArrow(pack, "packed long, boot long"), "forest-rows", "zstd")
    rng = np.random.default_rng(seed)
    odds = rng.integers(0, 1 << 63, (num_trees + 1) // 2, np.uint64) * np.uint64(2) + np.uint64(1)
    size = 2 ** (max_depth + 1) - 1
    feature, cut = np.full((num_trees, size), -1), np.zeros((num_trees, size), np.int64)
    gain, stats = np.zeros((num_trees, size)), np.zeros((num_trees, size, 2))
    k, pair = math.ceil(math.sqrt(len(features))), (weights.get(0, 1.0), weights.get(1, 1.0))
    for level in range(max_depth):
        subsets = np.sort(rng.random((num_trees, 1 << level, len(features))).argsort(axis=2)[:, :, :k], axis=2)
        counts = binned.mapInArrow(counter(feature, cut, level, subsets, odds), "tree int, width int, counts binary")
        found = counts.repartition("tree").sortWithinPartitions("tree").mapInArrow(reducer(level, subsets, pair), FOUND).toArrow()
        f = {c: found[c].to_numpy() for c in found.column_names}
        at, t = f["node"] + (1 << level) - 1, f["tree"]
        stats[t, at] = np.stack([f["zero"], f["one"]], axis=1)
        split = f["feature"] >= 0
        at, t = at[split], t[split]
        feature[t, at], cut[t, at], gain[t, at] = f["feature"][split], f["bin"][split], f["gain"][split]
        left = np.stack([f["left_zero"], f["left_one"]], axis=1)[split]
        stats[t, 2 * at + 1], stats[t, 2 * at + 2] = left, stats[t, at] - left
        if not split.any():
            break
    says = stats[:, :, 1] > stats[:, :, 0]
    for i in reversed(range(size // 2)):
        alike = (feature[:, i] >= 0) & (feature[:, 2 * i + 1] < 0) & (feature[:, 2 * i + 2] < 0) & (says[:, 2 * i + 1] == says[:, 2 * i + 2])
        feature[alike, i] = -1
    return Forest(features, cuts, feature, cut, gain, stats)
