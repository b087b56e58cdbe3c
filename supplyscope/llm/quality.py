"""Quality classifier: histogram gradient-boosted trees over document
statistics (operator 1).

Statistics of every whole text are computed in vectorised passes over its
bytes and words.  Trees are grown on binned statistics of a bounded sample of
labelled rows and kept as flat arrays (feature, threshold, leaf by node
number), so a batch goes down all of them by numpy indexing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyscope.llm.textscan import Words
from supplyscope.llm.work import byte_view, merge_join, session, slices, stash, text_or_empty

#: Labelled rows the trees are grown on, at most about this many.
TRAIN_ROWS = 30_000
THRESHOLD = 0.7

STATS = ["log_bytes", "log_words", "word_len", "letters", "upper", "digits", "spaces", "lines", "high", "commas", "stops",
         "symbols", "pipes", "marks", "quotes", "distinct_words", "top_word", "distinct_pairs", "repeated_lines", "line_len",
         "short_words", "long_words", "bytes_entropy", "capital_words"]


def byte_classes() -> np.ndarray:
    """One-hot classes of bytes, in the order of the columns they feed."""
    sets = [range(97, 123), range(65, 91), range(48, 58), b" ", b"\n", range(128, 256), b",", b".;:", b"#$%&*+/<=>@\\^_`~{}[]()",
            b"|", b"!?", b"\"'"]
    out = np.zeros((256, len(sets)), np.float32)
    for i, s in enumerate(sets):
        out[list(s), i] = 1
    return out


CLASSES = byte_classes()


def stats(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The statistics of each text, one row each; zeros for an empty one."""
    n = len(off) - 1
    out = np.zeros((n, len(STATS)), np.float32)
    w = Words(data, off)
    pairs = w.grams(2)
    raw = data.tobytes()
    for t in range(n):
        a, b = int(off[t]), int(off[t + 1])
        if a == b:
            continue
        size = b - a
        hist = np.bincount(data[a:b], minlength=256).astype(np.float32)
        share = hist @ CLASSES / size
        p = hist[hist > 0] / size
        i, j = int(w.first[t]), int(w.first[t + 1])
        words = max(1, j - i)
        h = np.sort(w.hash[i:j])
        run = np.diff(np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1], [True])))) if len(h) else np.ones(1)
        g = pairs[i:max(i, j - 1)]
        text = raw[a:b]
        lines = [x for x in text.split(b"\n") if x.strip()]
        parts = text.split()
        sizes = np.fromiter(map(len, parts), np.int32, len(parts)) if parts else np.ones(1)
        capital = sum(x.isupper() for x in parts) / max(1, len(parts))
        letters = share[0] + share[1] + share[5]
        out[t] = (np.log1p(size), np.log1p(words), size / words, letters, share[1], share[2], share[3], share[4], share[5],
                  share[6], share[7], share[8], share[9], share[10], share[11], len(run) / words, run.max() / words,
                  len(np.unique(g)) / max(1, len(g)), 1 - len(set(lines)) / max(1, len(lines)), np.log1p(size / max(1, len(lines))),
                  (sizes <= 3).mean(), (sizes >= 14).mean(), -(p * np.log2(p)).sum(), capital)
    return out


class Trees:
    """Boosted trees of one depth as flat arrays.

    Node k of a tree has the children 2k + 1 and 2k + 2; a row goes right if
    its statistic is above the node's threshold."""

    def __init__(self, base: float, feature: np.ndarray, threshold: np.ndarray, leaf: np.ndarray):
        self.base, self.feature, self.threshold, self.leaf = base, feature, threshold, leaf

    def score(self, x: np.ndarray) -> np.ndarray:
        depth = int(np.log2(self.leaf.shape[1])) if len(self.leaf) else 0
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += v[node - len(f)]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15,
         ridge: float = 5.0, least: int = 20) -> Trees:
    """Fit by histograms of gradients: each feature is binned once by
    quantiles, each level needs one weighted count per feature."""
    n, m = x.shape
    inner = 2 ** depth - 1
    if n == 0 or y.min() == y.max():
        p = (y.sum() + 1) / (n + 2)
        return Trees(float(np.log(p / (1 - p))), np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(m)]
    code = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    total = np.full(n, base)
    feature, threshold, leaf = [], [], []
    rows = np.arange(n)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        f_of, t_of, c_of = np.zeros(inner, np.int64), np.full(inner, np.inf), np.full(inner, bins, np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            best = np.zeros(width)
            for f in range(m):
                at = (node - first) * bins + code[:, f]
                g, h, c = (np.bincount(at, weights=v, minlength=width * bins).reshape(width, bins).cumsum(axis=1)
                           for v in (grad, hess, np.ones(n)))
                whole = g[:, -1:] ** 2 / (h[:, -1:] + ridge)
                gain = g ** 2 / (h + ridge) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + ridge) - whole
                gain[(c < least) | (c[:, -1:] - c < least)] = 0
                gain[:, len(edges[f]):] = 0
                cut = gain.argmax(axis=1)
                better = gain[np.arange(width), cut] > best + 1e-9
                best = np.where(better, gain[np.arange(width), cut], best)
                k = np.flatnonzero(better)
                f_of[first + k], c_of[first + k] = f, cut[k]
                t_of[first + k] = edges[f][cut[k]] if len(k) else t_of[first + k]
            node = 2 * node + 1 + (code[rows, f_of[node]] > c_of[node])
        end = node - inner
        g, h = (np.bincount(end, weights=v, minlength=inner + 1) for v in (grad, hess))
        values = rate * g / (h + ridge)
        total += values[end]
        feature.append(f_of)
        threshold.append(t_of)
        leaf.append(values)
    return Trees(base, np.array(feature), np.array(threshold), np.array(leaf))


def held_out(id_col: Column) -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def document_stats(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, held_out, x): the statistics of each row's whole text."""
    def run(batches):
        for b in batches:
            data, off = byte_view(b.column(2))
            parts = [stats(data[off[i]:off[j]], off[i:j + 1] - off[i]) for i, j in slices(np.diff(off), 1 << 20)]
            x = np.concatenate(parts) if parts else np.zeros((0, len(STATS)), np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(STATS), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], names=["id", "held_out", "x"])

    rows = docs.select(docs[id_col].alias("id"), held_out(docs[id_col]).alias("held_out"), text_or_empty(docs[text_col]).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, held_out boolean, x array<float>")


def train(stats_of: DataFrame, labels: DataFrame, id_col: str, label_col: str, rows: int) -> Trees:
    """Fit on about ``rows`` labelled rows at most, chosen by a hash of their
    id; an id with several labels counts as its mean, rounded up."""
    known = labels.select(labels[id_col].alias("id"), labels[label_col].cast("double").alias("y")).filter(
        F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id")))
    known = known.groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    share = min(1.0, rows / max(1, known.count()))
    picked = known.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000))
    sample = merge_join(stats_of, picked, "id").select("id", "x", "y").toPandas().sort_values("id")
    x = np.array(sample["x"].tolist(), np.float32).reshape(len(sample), len(STATS))
    return grow(x, sample["y"].to_numpy(np.float64))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", threshold: float = THRESHOLD, rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per input row: id, held_out, score (0 to 1), predicted.

    Null and empty texts have all statistics 0 and are scored like any row; a
    row without a label is scored too.  Without labels of both kinds the score
    is the smoothed share of good labels.  Repeated rows and rows without an id
    (which belong to no label) are scored each; a long text is measured whole,
    in a batch of its own; an empty table gives no rows; other columns are not
    read, so their names can't clash.
    """
    spark = session(docs)
    known = stash(document_stats(docs, id_col, text_col), "quality-stats")
    model = train(known, labels, id_col, label_col, rows)
    shipped = spark.sparkContext.broadcast((model.base, model.feature, model.threshold, model.leaf))

    def run(batches):
        trees = Trees(*shipped.value)
        for b in batches:
            x = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(STATS))
            s = trees.score(x)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                             names=["id", "held_out", "score", "predicted"])

    kind = known.schema["id"].dataType.simpleString()
    return known.mapInArrow(run, f"id {kind}, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col)
