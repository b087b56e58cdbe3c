"""Removal of repeated byte strings by a difference cover and blockwise
grouping of fingerprints (operator 4).

A byte goes if a string of ``LENGTH`` bytes over it also starts elsewhere.
Only the first LENGTH bytes of a suffix matter and only whether two are equal,
so a suffix is known by a fingerprint (name) of its window.  Grouping by names
replaces the sorting of suffixes: no suffix order is built, cover samples only
prune and don't rank, and bytes are never compared.

1. Cover sample.  Positions whose remainder modulo V is in a difference cover
   D are sampled: for any two positions some shift below V brings both into
   the sample.  So two equal windows hold, at one shift, two equal sampled
   strings of LENGTH - V + 1 bytes.  The sampled strings are named, and the
   names sorted bucket by bucket.  A suffix is resolved as unique when all
   cover samples in its reach have names of their own.
2. Suffixes that tie in a cover sample are named by their whole windows, again
   sorted bucket by bucket; ties that are left are repeats.

Texts stay where they are: they are written once as chunks, in a table
bucketed by partition, and read in each round without a shuffle.  Only names
travel to the buckets, and one bit a name travels back.  A chunk sends a name
once however often it has it, so a string that a third of all rows share costs
one name a chunk.  Of texts that are equal as a whole only one sends names,
the others are known to be repeated.  Buckets are ranges of names, sorted one at a time, and
their number follows the data, so a task's memory is bounded.  Each chunk sends
to each bucket, so the pieces grow with the square of the data: a task answers a
chunk once for all its buckets, and a file holds a few chunks, as Spark reads
and writes the rows of a file in large batches.

Names are values of two polynomials modulo the prime 2^61 - 1 at keys that are
drawn for each run, multiplied by drawn factors and cut to a width that follows
the data.  Unlike windows of L bytes agree in one value for fewer than L keys,
so whatever the texts are, a false tie of two of them has a probability below
L / 2^61 for the first value, times 2^(1-t) for t bits of the second.  In step 1
false ties cost only work, and the names are short.  In step 2 the width makes
the probability of one false tie anywhere less than 2^-26 if at most a quarter
of the bytes start a suffix that is still open, and 2^-22 if all do.
"""

from __future__ import annotations

import hashlib
import secrets
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyscope.llm.work import merge_join, session, stash, text_or_empty
from supplyscope.session import output_root

LENGTH = 400
COVER = 2
CHUNK_BYTES = 2 << 20
#: Names that a bucket holds, on average.
BUCKET_NAMES = 1 << 18
#: Chunks, and answers to chunks, that a file holds: Spark decodes up to 4,096 rows at once.
FILE_CHUNKS, FILE_ANSWERS = 16, 64
#: Pieces whose answers a task holds before it sends them.
HELD_ANSWERS = 1 << 18


def difference_cover(r: int) -> tuple[int, np.ndarray]:
    """Modulus 24 r^2 + 36 r + 13 and a cover of 6 r + 4 residues: steps of
    1, r + 1, 2r + 1, 4r + 3, 2r + 2 and 1, repeated r, 1, r, 2r + 1, r + 1
    and r times (Colbourn and Ling)."""
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return 24 * r * r + 36 * r + 13, np.concatenate(([0], np.cumsum(steps)))


PRIME = (1 << 61) - 1
#: Positions that share a table of powers.
BLOCK = 1 << 15
P, LOW32, LOW31, LOW30, LOW29 = (np.uint64((1 << k) - 1) for k in (61, 32, 31, 30, 29))
B61, B32, B31, B30, B29, B6, B3 = (np.uint64(k) for k in (61, 32, 31, 30, 29, 6, 3))


def folded(x: np.ndarray) -> np.ndarray:
    """Numbers modulo PRIME."""
    x = (x & P) + (x >> B61)
    return np.where(x >= P, x - P, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo PRIME of numbers below it."""
    a1, a0, b1, b0 = a >> B32, a & LOW32, b >> B32, b & LOW32
    middle, last = a1 * b0 + a0 * b1, a0 * b0
    return folded((a1 * b1 << B3) + (middle >> B29) + ((middle & LOW29) << B32) + (last >> B61) + (last & P))


def drawn_keys() -> tuple[tuple[int, int], ...]:
    """(key, factor) of the two polynomials of a run."""
    return tuple((2 + secrets.randbelow(PRIME - 2), 1 + secrets.randbelow(PRIME - 1)) for _ in range(2))


def powers(first: int, key: int, n: int) -> np.ndarray:
    """``first`` times the first n powers of a key."""
    out = np.full(n, first, np.uint64)
    m = 1
    while m < n:
        out[m:2 * m] = times(out[:min(m, n - m)], np.uint64(pow(key, m, PRIME)))
        m *= 2
    return out


class Fingerprints:
    """Values below PRIME of windows of at most ``most`` bytes."""

    def __init__(self, key: int, factor: int, most: int):
        up = powers(1, key, BLOCK + most)
        self.low, self.high = up & LOW31, up >> B31
        self.down = powers(factor, pow(key, -1, PRIME), BLOCK)

    def at(self, data: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
        """Of the windows at ascending positions: differences of running sums,
        block by block, scaled back by powers of the key's inverse."""
        out = np.empty(len(start), np.uint64)
        edges = np.searchsorted(start, np.arange(0, len(data) + BLOCK, BLOCK)).tolist()
        for k, (i, j) in enumerate(zip(edges, edges[1:], strict=False)):
            if i == j:
                continue
            block = data[k * BLOCK:(k + 1) * BLOCK + length].astype(np.uint64) + np.uint64(1)
            at, n = start[i:j] - k * BLOCK, len(block)
            sums = np.zeros((2, n + 1), np.uint64)
            np.cumsum(block * self.low[:n], out=sums[0, 1:])
            np.cumsum(block * self.high[:n], out=sums[1, 1:])
            low, high = sums[0][at + length] - sums[0][at], sums[1][at + length] - sums[1][at]
            out[i:j] = times(folded(low + (high >> B30) + ((high & LOW30) << B31)), self.down[at])
        return out


class Names:
    """Sorted distinct names of strings: ``high`` and ``low`` 64-bit halves,
    ``which`` name each string has, ``count`` of each name."""

    def __init__(self, high: np.ndarray, low: np.ndarray | None = None):
        order = np.argsort(high, kind="stable") if low is None else np.lexsort((low, high))
        self.high, self.low = high[order], None if low is None else low[order]
        new = np.ones(len(high), bool)
        new[1:] = self.high[1:] != self.high[:-1]
        if low is not None:
            new[1:] |= self.low[1:] != self.low[:-1]
            self.low = self.low[new]
        self.high = self.high[new]
        self.which = np.empty(len(high), np.int64)
        self.which[order] = np.cumsum(new) - 1
        self.count = np.bincount(self.which, minlength=len(self.high))

    def buckets(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets with names, and where the names of each begin (and all end):
        the bucket is the first ``bits`` bits."""
        bucket = self.high >> np.uint64(64 - bits) if bits else np.zeros_like(self.high)
        keys, begin = np.unique(bucket, return_index=True)
        return keys.astype(np.int64), np.append(begin, len(bucket)).astype(np.int64)

    def sent(self, bits: int, width: int) -> np.ndarray:
        """The ``width`` bytes of each name that follow the bucket's bits."""
        low = np.zeros_like(self.high) if self.low is None else self.low
        halves = (self.high << np.uint64(bits)) | (low >> np.uint64(64 - bits)) if bits else self.high, low << np.uint64(bits)
        return np.ascontiguousarray(np.stack(halves, axis=1).astype(">u8").view(np.uint8).reshape(-1, 16)[:, :width])


class Chunk:
    """Some whole texts laid end to end, and the suffixes of interest."""

    def __init__(self, texts: list[bytes], length: int, cover: tuple[int, np.ndarray], hashes: list[Fingerprints]):
        self.off = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.length, (self.v, self.d), self.hashes = length, cover, hashes

    def ends(self, start: np.ndarray) -> np.ndarray:
        """End of the text that each position is in."""
        return self.off[np.searchsorted(self.off, start, side="right")]

    def samples(self) -> np.ndarray:
        """Cover positions, by text, whose pruning string fits."""
        short = self.length - self.v + 1
        parts = []
        for a, b in zip(self.off.tolist(), self.off[1:].tolist(), strict=False):
            if b - a >= self.length:
                grid = (np.arange(0, b - a - short + 1, self.v)[:, None] + self.d).ravel()
                parts.append(a + grid[grid <= b - a - short])
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def sample_names(self, keep: int) -> tuple[np.ndarray, Names]:
        """Samples and the first ``keep`` bits of their strings' names."""
        s = self.samples()
        drop = np.uint64(64 - keep)
        return s, Names(self.hashes[0].at(self.data, s, self.length - self.v + 1) << B3 >> drop << drop)

    def open_suffixes(self, tied: np.ndarray) -> np.ndarray:
        """Starts of windows that hold the string of a tied sample."""
        mark = np.zeros(len(self.data) + 1, np.int32)
        low = np.maximum(tied - self.v + 1, self.off[np.searchsorted(self.off, tied, side="right") - 1])
        high = np.minimum(tied, self.ends(tied) - self.length)
        ok = high >= low
        mark += np.bincount(low[ok], minlength=len(mark)).astype(np.int32)
        mark -= np.bincount(high[ok] + 1, minlength=len(mark)).astype(np.int32)
        return np.flatnonzero(np.cumsum(mark[:-1]) > 0)

    def window_names(self, start: np.ndarray) -> Names:
        if not len(start):
            return Names(np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        one, two = (h.at(self.data, start, self.length) for h in self.hashes)
        return Names(one << B3 | two >> np.uint64(58), two << B6)

    def covered(self, at: np.ndarray) -> np.ndarray:
        """Mask of the bytes of the windows that start at ``at`` (distinct)."""
        mark = np.zeros(len(self.data) + 1, np.int32)
        mark[at] += 1
        mark[at + self.length] -= 1
        return np.cumsum(mark[:-1]) > 0


def ramps(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The n numbers from each beginning on, end to end."""
    return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())


def tied_bits(batches, width: int):
    """Sorted batches of (bucket, chunk, names): by chunk, the buckets where
    another chunk has some of its names too, and their bit strings (a bit a
    name, each in whole bytes), end to end."""
    held: list = []
    found: list = []

    def flush():
        data = [n for _, _, n in held]
        raw = np.frombuffer(b"".join(data), np.uint8).reshape(-1, width)
        wide = np.zeros((len(raw), 8 * -(-width // 8)), np.uint8)
        wide[:, :width] = raw
        key = wide.view(">u8").astype(np.uint64)
        order = np.lexsort(key.T[::-1])
        ordered = key[order]
        same = (ordered[1:] == ordered[:-1]).all(axis=1)
        tied = np.zeros(len(raw), bool)
        tied[order[1:]] |= same
        tied[order[:-1]] |= same
        n = np.fromiter(map(len, data), np.int64, len(data)) // width
        end = np.cumsum((n + 7) // 8)
        begin = end - (n + 7) // 8
        spread = np.zeros(8 * end[-1], bool)
        spread[ramps(8 * begin, n)] = tied
        bits = np.packbits(spread).tobytes()
        for i in np.flatnonzero(np.logical_or.reduceat(tied, np.cumsum(n) - n)).tolist():
            found.append((held[i][1], held[i][0], bits[begin[i]:end[i]]))
        held.clear()

    def answer():
        found.sort(key=lambda x: x[0])  # stable: a chunk's buckets stay in order
        chunk, bucket, bits = zip(*found, strict=True)
        chunks, first = np.unique(np.array(chunk, np.int64), return_index=True)
        edge = [*first.tolist(), len(found)]
        buckets = np.array(bucket, np.int64)
        spans = list(zip(edge, edge[1:], strict=False))
        out = pa.RecordBatch.from_arrays(
            [pa.array(chunks), pa.array([buckets[i:j].tobytes() for i, j in spans], pa.binary()),
             pa.array([b"".join(bits[i:j]) for i, j in spans], pa.binary())], names=["chunk", "buckets", "bits"])
        found.clear()
        return out
    for b in batches:
        for row in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            if held and held[-1][0] != row[0]:
                flush()
                if len(found) >= HELD_ANSWERS:
                    yield answer()
            held.append(row)
    if held:
        flush()
    if found:
        yield answer()


def answers(names: Names, bits: int, got: list | None) -> np.ndarray:
    """Which of a chunk's names are tied: twice in the chunk, or in another
    chunk by the buckets' bit strings ``got``."""
    out = names.count > 1
    keys, edge = names.buckets(bits)
    for g in got or ():
        at = np.searchsorted(keys, np.frombuffer(g["buckets"], np.int64))
        n = edge[at + 1] - edge[at]
        size = (n + 7) // 8
        tied = np.unpackbits(np.frombuffer(g["bits"], np.uint8))[ramps(8 * (np.cumsum(size) - size), n)]
        out[ramps(edge[at], n)] |= tied.astype(bool)
    return out


def senders(row: dict) -> list[bytes]:
    """A chunk's texts, empty for those that another text sends names for."""
    texts = list(row["texts"])
    for g in row["got0"] or ():
        if not g["sends"]:
            texts[g["pos"]] = b""
    return texts


def bucket_values(spark, n: int) -> np.ndarray:
    """For each of n partitions a number that Spark's bucketing puts into the
    bucket of the same place, so that no two partitions share a bucket."""
    drawn = spark.range(20 * n + 64).select(F.col("id").cast("int").alias("v"))
    found = drawn.groupBy(F.pmod(F.hash("v"), F.lit(n)).alias("b")).agg(F.min("v").alias("v")).collect()
    out = np.full(n, -1, np.int64)
    for r in found:
        out[r.b] = r.v
    spare = iter(range(20 * n + 64, 22 * n + 64))
    return np.array([v if v >= 0 else next(spare) for v in out.tolist()], np.int64)


class Repeats:
    """The rounds over the chunk table; each adds one column of answers."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, length: int, cover: int, chunk_bytes: int, bucket_names: int):
        self.spark = session(docs)
        self.length, self.cover = length, difference_cover(cover)
        if self.cover[0] * 2 > length:
            raise ValueError(f"a cover modulo {self.cover[0]} is too wide for strings of {length} bytes")
        self.bucket_names = bucket_names
        self.keys = drawn_keys()
        rows = docs.select(docs[id_col].alias("id"), text_or_empty(docs[text_col]).alias("text"))
        kind = rows.schema["id"].dataType.simpleString()
        self.id_kind = kind

        n = max(1, rows.rdd.getNumPartitions())
        part_of = self.spark.sparkContext.broadcast(bucket_values(self.spark, n))

        def pack(batches):
            from pyspark import TaskContext

            part = int(part_of.value[TaskContext.get().partitionId()])
            ids, texts, size, number = [], [], 0, 0
            long_enough = lambda t: hashlib.blake2b(t, digest_size=16).digest() if len(t) >= length else None

            def out():
                return pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([(part << 33) + number], pa.int64()),
                     pa.array([ids], pa.list_(id_type)), pa.array([texts], pa.list_(pa.binary())), pa.array([size], pa.int64()),
                     pa.array([[long_enough(t) for t in texts]], pa.list_(pa.binary()))],
                    names=["part", "chunk", "ids", "texts", "size", "digests"])
            for b in batches:
                id_type = b.column(0).type
                for i, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                    if ids and size + len(t) > chunk_bytes:
                        yield out()
                        ids, texts, size, number = [], [], 0, number + 1
                    ids.append(i)
                    texts.append(t)
                    size += len(t)
            if ids:
                yield out()

        packed = rows.mapInArrow(pack, f"part int, chunk long, ids array<{kind}>, texts array<binary>, size long, digests array<binary>")
        self.n_parts = n
        self.name = f"llm_chunks_{uuid.uuid4().hex}"
        # each task writes one bucket of its own: no shuffle here, nor on this side of joins by part
        packed.write.option("compression", "zstd").option("maxRecordsPerFile", FILE_CHUNKS).option("path", f"{output_root(self.spark, 'llm')}/{self.name}").bucketBy(
            n, "part").saveAsTable(self.name, format="parquet")
        self.chunks = self.spark.table(self.name)
        self.bytes = self.chunks.agg(F.sum("size")).first()[0] or 0

    def copies(self) -> DataFrame:
        """By chunk, the places of texts that equal another as a whole, and
        which of them is the one that sends names."""
        rows = self.chunks.select("chunk", F.posexplode("digests").alias("pos", "digest")).where("digest IS NOT NULL")
        groups = rows.groupBy("digest").agg(F.min(F.struct("chunk", "pos")).alias("first"), F.count("*").alias("n"))
        groups = stash(groups.where("n > 1"), "repeat-copies")
        sends = (F.col("first.chunk") == F.col("chunk")) & (F.col("first.pos") == F.col("pos"))
        mine = merge_join(rows, groups, "digest").select("chunk", F.struct("pos", sends.alias("sends")).alias("text"))
        back = mine.groupBy("chunk").agg(F.collect_list("text").alias("got"))
        return stash(back.withColumn("part", F.shiftright("chunk", 33).cast("int")), "repeat-places")

    def layout(self, names: int, spare: tuple[float, float], most: int) -> tuple[int, int]:
        """Bucket bits and sent bytes for names of log2(names) * ``spare[0]`` +
        ``spare[1]`` bits, ``most`` at most."""
        bits = int(max(0, np.ceil(np.log2(max(1, names) / self.bucket_names))))
        keep = min(most, int(np.ceil(np.log2(max(2, names)) * spare[0] + spare[1])))
        return bits, max(1, -(-(keep - bits) // 8))

    def resolve(self, named, answered: list[DataFrame], bits: int, width: int) -> DataFrame:
        """One round: chunks send names (``named``: Chunk and earlier answers
        to Names), buckets are sorted, bits return by chunk."""
        length, cover, drawn = self.length, self.cover, self.keys

        def send(batches):
            hashes = [Fingerprints(*k, length) for k in drawn]
            for b in batches:
                for row in b.to_pylist():
                    names = named(Chunk(senders(row), length, cover, hashes), row)
                    keys, edge = names.buckets(bits)
                    if len(keys):
                        data = names.sent(bits, width)
                        pieces = pa.BinaryArray.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer((edge * width).astype(np.int32)), pa.py_buffer(data)])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys), pa.array(np.full(len(keys), row["chunk"], np.int64)), pieces], names=["bucket", "chunk", "names"])

        sent = self.with_answers(answered).mapInArrow(send, "bucket long, chunk long, names binary")
        dealt = sent.repartition("bucket").sortWithinPartitions("bucket", "chunk")
        back = dealt.mapInArrow(lambda it: tied_bits(it, width), "chunk long, buckets binary, bits binary")
        back = back.groupBy("chunk").agg(F.collect_list(F.struct("buckets", "bits")).alias("got"))
        return stash(back.withColumn("part", F.shiftright("chunk", 33).cast("int")), "repeat-bits", file_rows=FILE_ANSWERS)

    def with_answers(self, answered: list[DataFrame]) -> DataFrame:
        """The chunk table, each chunk with its answers of earlier rounds."""
        out = self.chunks.select("part", "chunk", "ids", "texts")
        for k, got in enumerate(answered):
            mine = got.repartition(self.n_parts, "part").groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("chunk", "got"))).alias(f"got{k}"))
            out = out.join(mine.hint("shuffle_hash"), "part", "left")
        return out.select("chunk", "ids", "texts", *(F.col(f"got{k}")[F.col("chunk")].alias(f"got{k}") for k in range(len(answered))))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, cover: int = COVER,
                   chunk_bytes: int = CHUNK_BYTES, bucket_names: int = BUCKET_NAMES, with_text: bool = False) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256
    and, with ``with_text``, kept (binary: the remaining bytes).

    Null and empty texts and texts under ``length`` bytes lose nothing;
    repeated rows count as copies of each other; null ids pass through; an
    empty table gives no rows; other columns are not read, so their names can't
    clash.  A text is never split: one much longer than ``chunk_bytes`` is a
    chunk of its own and takes some 25 bytes of memory for each of its bytes,
    75 if all of them repeat.
    """
    r = Repeats(docs, id_col, text_col, length, cover, chunk_bytes, bucket_names)
    v, d = r.cover
    # false ties of samples cost work only: one in 2^13; of windows, one anywhere with 2^-26, where the first 61 bits
    # of a name tell windows apart as 61 - log2(length) drawn bits do
    bits1, width1 = r.layout(r.bytes * len(d) // v, (1, 13), 64)
    bits2, width2 = r.layout(r.bytes // 4, (2, 26 + np.log2(length)), 122)
    keep1 = min(64, bits1 + 8 * width1)

    def first(c: Chunk, row) -> Names:
        return c.sample_names(keep1)[1]

    def second(c: Chunk, row) -> tuple[np.ndarray, Names]:
        s, names = c.sample_names(keep1)
        start = c.open_suffixes(s[answers(names, bits1, row["got1"])[names.which]])
        return start, c.window_names(start)

    whole = r.copies()
    one = r.resolve(first, [whole], bits1, width1)
    two = r.resolve(lambda c, row: second(c, row)[1], [whole, one], bits2, width2)
    cover_of, keys = r.cover, r.keys

    def cut(batches):
        hashes = [Fingerprints(*k, length) for k in keys]
        for b in batches:
            for row in b.to_pylist():
                c = Chunk(senders(row), length, cover_of, hashes)
                start, names = second(c, row)
                gone = c.covered(start[answers(names, bits2, row["got2"])[names.which]])
                copied = {g["pos"] for g in row["got0"] or ()}
                out = []
                for i, (a, e) in enumerate(zip(c.off.tolist(), c.off[1:].tolist(), strict=False)):
                    g, text = gone[a:e], row["texts"][i]
                    kept = b"" if i in copied else c.data[a:e][~g].tobytes() if g.any() else text
                    spans = 1 if i in copied else int(g[:1].sum() + (g[1:] & ~g[:-1]).sum())
                    out.append((row["ids"][i], len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
                cols = list(zip(*out, strict=True))
                arrays = [pa.array(cols[0], id_arrow), *(pa.array(x, pa.int64()) for x in cols[1:4]), pa.array(cols[4], pa.string())]
                names_ = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if with_text:
                    arrays.append(pa.array(cols[5], pa.binary()))
                    names_.append("kept")
                yield pa.RecordBatch.from_arrays(arrays, names=names_)

    from pyspark.sql.pandas.types import to_arrow_type
    id_arrow = to_arrow_type(r.chunks.schema["ids"].dataType.elementType)
    schema = f"id {r.id_kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return r.with_answers([whole, one, two]).mapInArrow(cut, schema).withColumnRenamed("id", id_col)
