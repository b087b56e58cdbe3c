"""N-gram Jaccard join by MinHash LSH banding (operator 6).

Each distinct shingle set gets a signature, cut into ``TREES`` bands of
``DEPTH`` values each.  Bands are matched at one fixed depth, the greatest at
which a pair at the threshold is found with the target probability, known
before any data is seen; the values beyond it serve only the estimate of
similarity.  This replaces an LSH forest: as all pairs are wanted, the prefixes
of a forest would be shortened to that depth for every row, with the same
candidates.  A band's prefix group is cut into blocks, so a huge one is spread
over many tasks.

Candidates that their signatures show to be too unlike are left out, the rest
form families (components).  All pairs of a family are verified exactly on
their shingle sets, block against block; only link counts and a spanning
forest leave a task, never all pairs.  Equal sets are one member with a count.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyscope.llm.components import components
from supplyscope.llm.textscan import STEP, mix, shingle_sets
from supplyscope.llm.work import Carried, byte_view, merge_join, session, slices, stash

SHINGLE = 5
SIMILARITY = 0.8
TREES = 20
DEPTH = 5
RECALL = 0.9999
#: Standard deviations that a signature may fall short of the threshold.
SLACK = 4.5
BLOCK = 512
BLOCK_TEXT = 16 << 20


def prefix_depth(similarity: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix that still finds a pair at ``similarity`` with
    probability ``recall``; 1 if none does."""
    d = depth
    while d > 1 and 1 - (1 - similarity ** d) ** trees < recall:
        d -= 1
    return d


def multipliers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * STEP) | np.uint64(1)


def signatures(sets: list[np.ndarray], n: int) -> np.ndarray:
    """n minimum hashes (uint32) of each non-empty set."""
    size = np.array([len(s) for s in sets])
    head = np.cumsum(size) - size
    every = np.concatenate(sets)
    out = np.empty((len(sets), n), np.uint32)
    buf = np.empty_like(every)
    for i, m in enumerate(multipliers(n)):
        np.multiply(every, m, out=buf)
        out[:, i] = np.minimum.reduceat(buf, head) >> np.uint64(32)
    return out


def sign(texts_of, k: int, n: int):
    """mapInArrow function: adds shingle count, set key and signature."""
    def run(batches):
        for b in batches:
            data, off = byte_view(texts_of(b))
            counts, keys, sigs = [], [], []
            for i, j in slices(np.diff(off), 1 << 20):
                sets = shingle_sets(data[off[i]:off[j]], off[i:j + 1] - off[i], k)
                full = [s for s in sets if len(s)]
                rows = iter(signatures(full, n)) if full else iter(())
                for s in sets:
                    counts.append(len(s))
                    keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    sigs.append(next(rows).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())],
                names=[*b.schema.names, "n_sh", "key", "sig"])
    return run


def whole_groups(batches, keys: list[str], rows: int = 8192):
    """Arrow tables of about ``rows`` rows, from sorted batches, that hold
    whole groups of ``keys``; a larger group stands alone."""
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        if held.num_rows < rows:
            continue
        g = group_ids(held, keys)
        last = int(np.searchsorted(g, g[-1]))
        if last:
            yield held.slice(0, last)
            held = held.slice(last).combine_chunks()
    if held is not None and held.num_rows:
        yield held


def group_ids(t: pa.Table, keys: list[str]) -> np.ndarray:
    """Number of each row's group among consecutive equal keys."""
    new = np.zeros(t.num_rows, bool)
    for k in keys:
        v = t.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.cumsum(new)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index of each of n nodes' component under the pairs (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def candidate_forest(trees: int, depth: int, cut: int, floor: float):
    """mapInArrow function over sorted trie-node blocks (label, low, high,
    tree, row, side, sig): spanning forest (a, b) of the likely pairs.

    A pair counts in the first tree where its prefixes match, so it is
    compared once for all its nodes."""
    def run(batches):
        for t in whole_groups(batches, ["label", "low", "high"]):
            g = group_ids(t, ["label", "low", "high"])
            row, tree, side = (t.column(c).to_numpy() for c in ("row", "tree", "side"))
            off_diagonal = t.column("low").to_numpy() != t.column("high").to_numpy()
            sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint32).reshape(len(g), -1)
            left, right = [], []
            step, live = 1, np.arange(len(g))
            while len(live):
                live = live[live + step < len(g)]
                live = live[g[live] == g[live + step]]
                i = live[~off_diagonal[live] | (side[live] != side[live + step])]
                for s in range(0, len(i), 16384):
                    a = i[s:s + 16384]
                    same = sig[a] == sig[a + step]
                    likely = same.mean(axis=1) >= floor
                    a, same = a[likely], same[likely]
                    prefix = same.reshape(len(a), trees, depth)[:, :, :cut].all(axis=2)
                    first = prefix.argmax(axis=1) == tree[a]
                    left.append(a[first & prefix.any(axis=1)])
                    right.append(left[-1] + step)
                step += 1
            if left:
                top = roots(len(g), np.concatenate(left), np.concatenate(right))
                own = np.flatnonzero(top != np.arange(len(g)))
                yield pa.RecordBatch.from_arrays([pa.array(row[top[own]], pa.int64()), pa.array(row[own], pa.int64())],
                                                 names=["a", "b"])
    return run


def verified(k: int, similarity: float):
    """mapInArrow function over sorted family blocks (family, low, high, side,
    row, copies, text): for each row its links (copies counted) and the least
    row it is linked to in this block."""
    def run(batches):
        for t in whole_groups(batches, ["family", "low", "high"], rows=256):
            ids = group_ids(t, ["family", "low", "high"])
            edge = np.flatnonzero(np.diff(ids)) + 1
            for i, j in zip([0, *edge.tolist()], [*edge.tolist(), len(ids)], strict=True):
                part = t.slice(i, j - i)
                row, copies, side = (part.column(c).to_numpy() for c in ("row", "copies", "side"))
                cross = part.column("low")[0].as_py() != part.column("high")[0].as_py()
                sets = shingle_sets(*byte_view(part.column("text")), k)
                links, a, b = jaccard_links(sets, side if cross else None, similarity, copies)
                order = np.argsort(row, kind="stable")
                rank = np.empty_like(order)
                rank[order] = np.arange(len(order))
                top = row[order][roots(len(row), rank[a], rank[b])[rank]]
                yield pa.RecordBatch.from_arrays(
                    [part.column("family").combine_chunks(), pa.array(row, pa.int64()), pa.array(top, pa.int64()),
                     pa.array(links, pa.int64())], names=["family", "row", "other", "links"])
    return run


def jaccard_links(sets: list[np.ndarray], side: np.ndarray | None, similarity: float, copies: np.ndarray):
    """Links of each set (the other's copies counted) and the linked pairs.

    One set's members are marked in the block's vocabulary and all later sets
    are counted against it in one pass; with ``side`` only pairs of unlike
    sides count."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    _, code = np.unique(every, return_inverse=True)
    head = np.cumsum(size) - size
    mark = np.zeros(int(code.max()) + 1, np.int32)
    links, left, right = np.zeros(n, np.int64), [], []
    for i in range(n - 1):
        mine = code[head[i]:head[i] + size[i]]
        mark[mine] = 1
        both = np.add.reduceat(mark[code[head[i + 1]:]], head[i + 1:] - head[i + 1])
        mark[mine] = 0
        ok = both >= similarity * (size[i] + size[i + 1:] - both) - 1e-9
        if side is not None:
            ok &= side[i + 1:] != side[i]
        j = np.flatnonzero(ok) + i + 1
        links[i] += copies[j].sum()
        links[j] += copies[i]
        left.append(np.full(len(j), i))
        right.append(j)
    none = np.zeros(0, np.int64)
    return links, np.concatenate(left) if left else none, np.concatenate(right) if right else none


def in_blocks(df: DataFrame, blocks: str) -> DataFrame:
    """Copies each row (with ``row`` and its group's number of blocks) to the
    block pairs its own block is in; ``side`` tells which of the two it is."""
    own = F.pmod(F.xxhash64("row"), F.col(blocks)).cast("int")
    out = df.withColumn("own", own).withColumn("mate", F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1)))
    return out.withColumn("low", F.least("own", "mate")).withColumn("high", F.greatest("own", "mate")).withColumn(
        "side", F.when(F.col("low") == F.col("high"), 0).when(F.col("own") == F.col("low"), 0).otherwise(1)).drop("own", "mate")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (),
                    similarity: float = SIMILARITY, shingle: int = SHINGLE, trees: int = TREES, depth: int = DEPTH,
                    recall: float = RECALL) -> DataFrame:
    """One row per input row: id, ``carry`` (struct of those columns, if any),
    class_id (least id of its class), class_size, n_links (rows of Jaccard
    similarity ``similarity`` or more, copies counted) and kept (one row of
    each class, the one with the largest id).

    A class is a connected component of links.  Texts without words (null,
    empty, punctuation) have no shingles and no links: each is a class of its
    own.  Rows that repeat an id and text are linked copies.  A class of null
    ids has a null class_id.  An empty table gives no rows; a long text is one
    set of shingles like any other; ``carry`` is a struct, so names can't clash.
    """
    session(docs)
    c = Carried(docs, id_col, text_col, carry)
    rows = c.rows.withColumn("row", F.monotonically_increasing_id())
    n = trees * depth
    base = stash(rows.mapInArrow(sign(c.texts, shingle, n), c.schema("n_sh long, key binary, sig binary", rows)), "near-rows")

    cut = prefix_depth(similarity, trees, depth, recall)
    full = base.filter("n_sh > 0")
    members = stash(full.groupBy("key").agg(F.min("row").alias("row"), F.count("*").alias("copies"),
                                            F.max("sig").alias("sig")), "near-members")
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))
    label = F.xxhash64("tree", F.col("sig").substr(F.col("tree") * (4 * depth) + 1, F.lit(4 * cut)))
    labels = members.select("row", "sig", tree.alias("tree")).select("row", "tree", label.alias("label"))
    nodes = stash(labels.groupBy("label").agg(F.count("*").alias("n")).filter("n > 1")
                  .withColumn("blocks", F.ceil(F.col("n") / BLOCK)), "near-nodes")
    shared = stash(in_blocks(merge_join(labels, nodes, "label"), "blocks").select("label", "low", "high", "side", "tree", "row"),
                   "near-shared")
    floor = similarity - SLACK * (similarity * (1 - similarity) / n) ** 0.5
    grouped = merge_join(shared, members.select("row", "sig"), "row").repartition("label", "low", "high").sortWithinPartitions(
        "label", "low", "high", "row")
    edges = stash(grouped.mapInArrow(candidate_forest(trees, depth, cut, floor), "a long, b long"), "near-edges")

    family = components(edges).withColumnRenamed("root", "family").withColumnRenamed("node", "row")
    texts = merge_join(base.select("row", c.text.alias("text")), merge_join(family, members.select("row", "copies"), "row"), "row")
    texts = stash(texts, "near-texts")
    sizes = stash(texts.groupBy("family").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK), F.ceil(F.sum(F.octet_length("text")) / BLOCK_TEXT)).alias("blocks")), "near-families")
    blocks = in_blocks(merge_join(texts, sizes, "family"), "blocks").repartition("family", "low", "high").sortWithinPartitions(
        "family", "low", "high", "row").select("family", "low", "high", "side", "row", "copies", "text")
    checked = stash(blocks.mapInArrow(verified(shingle, similarity), "family long, row long, other long, links long"),
                    "near-checked")
    links = checked.groupBy("row").agg(F.sum("links").alias("links"))
    classes = components(checked.filter("row != other").select(F.col("row").alias("a"), F.col("other").alias("b")))

    # from members to rows: equal sets share the member's class and links
    per_member = merge_join(merge_join(members.select("key", "row", "copies"), links, "row", "left"),
                            classes.withColumnRenamed("node", "row"), "row", "left").select(
        "key", F.coalesce("root", "row").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    per_member = stash(per_member, "near-classes")
    placed = stash(merge_join(base.select("row", "id", "key"), per_member, "key", "left").select(
        "row", "id", F.coalesce("class", "row").alias("class"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")),
        "near-placed")
    heads = stash(placed.groupBy("class").agg(F.min("id").alias("class_id"), F.max(F.struct("id", "row")).alias("best"),
                                              F.count("*").alias("class_size")), "near-heads")
    found = merge_join(placed, heads, "class").select("row", "id", "class_id", "class_size", "n_links",
                                                      (F.col("best.row") == F.col("row")).alias("kept"))
    if carry:
        found = merge_join(base.select("row", "carry"), found, "row")
    return found.select(*c.kept, "class_id", "class_size", "n_links", "kept")
