"""Benchmark decontamination by winnowing (operator 3).

Fingerprints are the least k-gram hash of each run of consecutive k-grams of
one window (10 words: 5-grams, runs of 6).  Two texts that share 10 words in a
row share all hashes of that run and so its least one: a document word span
that equals an item's window is always found.  Matching fingerprints are
extended to whole windows: those of equal hash are compared word by word.

Items are processed in blocks of bounded size, each sent to the tasks as
sorted arrays; a benchmark of one block takes a single pass over the documents
and no shuffle.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyscope.llm.textscan import Words
from supplyscope.llm.work import Carried, byte_view, merge_join, session, slices, stash, text_or_empty

WINDOW = 10
GRAM = 5
RUN = WINDOW - GRAM + 1
#: Bytes of item text in one block, the bound of what is broadcast.
BLOCK_BYTES = 16 << 20


def selected(w: Words, g: np.ndarray) -> np.ndarray:
    """Indices of the k-grams that are least in some window of their text."""
    n = len(w.hash) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least = g[:n].copy()
    for j in range(1, RUN):
        np.minimum(least, g[j:n + j], out=least)
    inside = np.zeros(n, bool)  # windows that lie in one text
    text_end = np.repeat(w.first[1:], w.count)[:n]
    np.less_equal(np.arange(n) + WINDOW, text_end, out=inside)
    chosen = np.zeros(len(g), bool)
    for j in range(RUN):
        chosen[j:n + j] |= (g[j:n + j] == least) & inside
    return np.flatnonzero(chosen)


def present(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return ordered[at] == values


class Items:
    """A block of benchmark items as arrays: fingerprints, and for each window
    length the sorted window hashes with the items they occur in and, for each
    of these, a place where the window's words stand."""

    def __init__(self, names: list[str], texts: list[str]):
        data, off = byte_view(pa.array(texts, pa.large_string()))
        w = Words(data, off)
        self.names, self.words = names, w
        self.prints = np.unique(w.grams(GRAM)[selected(w, None if len(w.hash) < WINDOW else w.grams(GRAM))]
                                if len(w.hash) >= WINDOW else np.zeros(0, np.uint64))
        at: dict[int, list] = {}
        for item, (a, n) in enumerate(zip(w.first.tolist(), w.count.tolist(), strict=False)):
            size = min(n, WINDOW)
            if size:
                starts = np.arange(a, a + n - size + 1)
                at.setdefault(size, []).append((np.full(len(starts), item), starts))
        self.windows = {}
        for size, parts in at.items():
            item, start = (np.concatenate(x) for x in zip(*parts, strict=True))
            h = w.gram_at(start, size)
            order = np.lexsort((start, item, h))
            h, item, start = h[order], item[order], start[order]
            new = np.r_[True, (h[1:] != h[:-1]) | (item[1:] != item[:-1])]
            # an item's further windows of one hash count only if their words differ
            keep, seen = new.copy(), set()
            for i in np.flatnonzero(~new).tolist():
                if new[i - 1]:
                    seen = {w.window(int(start[i - 1]), size)}
                words = w.window(int(start[i]), size)
                keep[i] = words not in seen
                seen.add(words)
            keys, begin = np.unique(h[keep], return_index=True)
            self.windows[size] = (keys, np.append(begin, int(keep.sum())), item[keep].astype(np.int64), start[keep])

    @classmethod
    def of(cls, arrays: dict) -> Items:
        """From the plain arrays that a broadcast carries."""
        out = cls.__new__(cls)
        out.__dict__.update(arrays)
        return out

    def hits(self, w: Words):
        """Hit mask of the words, and (text, item) index pairs."""
        mark = np.zeros(len(w.hash) + 1, np.int32)
        text, pairs = w.text_of(), []
        for size, (keys, begin, items, place) in self.windows.items():
            if size == WINDOW:
                g = w.grams(GRAM)
                near = selected(w, g)
                near = near[present(g[near], self.prints)]
                start = np.unique((near[:, None] - np.arange(RUN)).ravel())  # windows that hold the fingerprint
                start = start[start >= 0]
            else:
                start = np.arange(max(0, len(w.hash) - size + 1))
            start = start[start + size <= len(w.hash)]
            start = start[text[start] == text[start + size - 1]]
            h = w.gram_at(start, size)
            found = present(h, keys)
            start, k = start[found], np.searchsorted(keys, h[found])
            if not len(start):
                continue
            many = begin[k + 1] - begin[k]
            at = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begin[k], many)
            start = np.repeat(start, many)
            # the hash proposes, the words decide
            theirs = {p: self.words.window(p, size) for p in set(place[at].tolist())}
            mine = {p: w.window(p, size) for p in set(start.tolist())}
            same = np.array([mine[p] == theirs[q] for p, q in zip(start.tolist(), place[at].tolist(), strict=True)])
            start, at = start[same], at[same]
            hit = np.unique(start)
            np.add.at(mark, hit, 1)
            np.add.at(mark, hit + size, -1)
            pairs.append(np.unique(np.stack([text[start], items[at]]), axis=1))
        both = np.unique(np.concatenate(pairs, axis=1), axis=1) if pairs else np.zeros((2, 0), np.int64)
        return np.cumsum(mark[:-1]) > 0, both


def digest(names: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


def scan(items: Items, texts: pa.Array, batch_bytes: int = 1 << 20):
    """For each text: words, hit mask, names of the items found."""
    data, off = byte_view(texts)
    for i, j in slices(np.diff(off), batch_bytes):
        w = Words(data[off[i]:off[j]], off[i:j + 1] - off[i])
        mask, pairs = items.hits(w)
        names: dict[int, list] = {}
        for t, k in pairs.T.tolist():
            names.setdefault(t, []).append(items.names[k])
        for t in range(j - i):
            yield int(w.count[t]), mask[w.first[t]:w.first[t + 1]], names.get(t, [])


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int):
    """Blocks of items, each of about ``block_bytes``; one at a time."""
    b = benchmark.select(F.coalesce(benchmark[item_col].cast("string"), F.lit("")).alias("item"),
                         text_or_empty(benchmark[text_col]).alias("text"))
    total = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        part = b if n == 1 else b.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        rows = part.collect()
        # rows that share an id are one item with the windows of all
        yield Items([r.item for r in rows], [r.text for r in rows]), n


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", carry: tuple[str, ...] = (),
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: id, ``carry`` (struct of those columns, if any),
    n_words, n_hit, n_items, items_sha256 and contaminated.

    Null and empty texts have no words; an empty benchmark hits nothing; null
    ids and repeated rows pass through.  A null item id is written as an empty
    string; rows that share an item id are one item.  An empty table gives no
    rows; a long text is scanned whole; ``carry`` is a struct, so names can't
    clash.
    """
    spark = session(docs)
    c = Carried(docs, id_col, text_col, carry)
    found_in = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"

    blocks = item_blocks(benchmark, item_col, item_text, block_bytes)
    items, n = next(blocks)
    if n == 1:
        shipped = spark.sparkContext.broadcast(vars(items))
        texts_of, kept = c.texts, c.kept

        def run(batches):
            known = Items.of(shipped.value)
            for b in batches:
                found = [(words, int(mask.sum()), sorted(set(names))) for words, mask, names in scan(known, texts_of(b))]
                keep = [b.column(k) for k in kept]
                yield pa.RecordBatch.from_arrays(
                    [*keep, pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                     pa.array([len(f[2]) for f in found], pa.int64()), pa.array([digest(f[2]) for f in found], pa.string()),
                     pa.array([f[1] > 0 for f in found], pa.bool_())],
                    names=[*kept, "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
        return c.rows.mapInArrow(run, c.schema(found_in, c.rows.select(*c.kept)))

    base = stash(c.rows.withColumn("row", F.monotonically_increasing_id()), "decon-rows")
    parts = []
    while items is not None:
        shipped = spark.sparkContext.broadcast(vars(items))

        def some(batches, shipped=shipped):
            for b in batches:
                found = list(scan(Items.of(shipped.value), b.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([f[0] for f in found], pa.int64()),
                     pa.array([np.packbits(f[1]).tobytes() if f[1].any() else None for f in found], pa.binary()),
                     pa.array([sorted(set(f[2])) for f in found], pa.list_(pa.string()))],
                    names=["row", "n_words", "mask", "names"])
        parts.append(stash(base.select("row", c.text.alias("text")).mapInArrow(
            some, "row long, n_words long, mask binary, names array<string>"), "decon-block"))
        items = next(blocks, (None, 0))[0]
    hits = parts[0]
    for p in parts[1:]:
        hits = hits.unionByName(p)
    merged = hits.groupBy("row").agg(F.max("n_words").alias("n_words"), F.collect_list("mask").alias("masks"),
                                     F.array_distinct(F.flatten(F.collect_list("names"))).alias("names"))

    def merge(batches):
        for b in batches:
            n_hit = []
            for masks in b.column(2).to_pylist():
                bits = [np.unpackbits(np.frombuffer(m, np.uint8)) for m in masks]
                n_hit.append(int(np.bitwise_or.reduce(bits).sum()) if bits else 0)
            names = b.column(3).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in names], pa.int64()),
                 pa.array([digest(x) for x in names], pa.string()), pa.array([x > 0 for x in n_hit], pa.bool_())],
                names=["row", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
    done = merged.mapInArrow(merge, f"row long, {found_in}")
    return merge_join(base.select("row", *c.kept), done, "row").drop("row")
