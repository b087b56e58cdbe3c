"""SentencePiece encoding that keeps offsets, and decoding (operator 11).

A text is normalised here, by the longest prefix that the model's compiled
character map holds (a double-array trie of UTF-8 bytes), and every normalised
byte keeps the place of the source bytes it comes from.  The library segments
what is normalised (its own normaliser is switched off in the copy of the model
that it loads), and each piece's normalised bytes are projected back to a span
of the source's bytes.  Decoding joins the bytes of pieces by table.

Texts are segmented in parts that begin with U+2581 after another character: no
piece of the vocabulary holds U+2581 there (tested when the model is loaded; a
model without that property gets whole texts), so no merge crosses such a place.
Equal parts of a batch are segmented once.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from supplyscope.llm.work import byte_view, session, text_or_empty

SPACE = "▁"
SPACE_BYTES = SPACE.encode()
#: Field numbers of the model file.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Parts a task remembers, and the longest of them.
MEMO_ENTRIES, MEMO_LONGEST = 500_000, 64
#: Bytes of a text that are normalised at once.
CHUNK = 1 << 20


def varint(data: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        c = data[i]
        value, i, shift = value | (c & 127) << shift, i + 1, shift + 7
        if c < 128:
            return value, i


def fields(data: bytes):
    """(number, value) of a message; a nested one is bytes."""
    i = 0
    while i < len(data):
        key, i = varint(data, i)
        if key & 7 == 0:
            value, i = varint(data, i)
        else:
            size, i = {1: (8, i), 5: (4, i)}.get(key & 7) or varint(data, i)
            value, i = data[i:i + size], i + size
        yield key >> 3, value


def message(items) -> bytes:
    """A message of (number, integer or bytes)."""
    def number(n):
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes([*out, n])
    return b"".join(number(k << 3) + number(v) if isinstance(v, int) else number(k << 3 | 2) + number(len(v)) + v
                    for k, v in items)


class CharacterMap:
    """Longest-prefix replacement through a compiled map: the size of a
    double array, the array, and the replacements, each ended by a zero."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
        self.values = blob[4 + size:]
        first = {c for c in range(256) if self.units and self.child(0, c) is not None}
        # places where a key may begin
        self.starts = re.compile(b"[" + b"".join(re.escape(bytes([c])) for c in sorted(first)) + b"]") if first else None

    def offset(self, unit: int) -> int:
        return (unit >> 10) << ((unit & 1 << 9) >> 6)

    def child(self, node: int, c: int) -> int | None:
        at = node ^ self.offset(self.units[node]) ^ c
        return at if at < len(self.units) and self.units[at] & 0x800000FF == c else None

    def longest(self, data: bytes, i: int) -> tuple[int, bytes] | None:
        """(end, replacement) of the longest key at ``i``."""
        node, found, j = 0, None, i
        while j < len(data) and (node := self.child(node, data[j])) is not None:
            j += 1
            if self.units[node] >> 8 & 1:
                found = j, self.units[node ^ self.offset(self.units[node])] & 0x7FFFFFFF
        if found is None:
            return None
        end, at = found
        return end, self.values[at:self.values.index(b"\0", at)]


class Model:
    """What a model file says, apart from how it segments."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        spec: dict[int, object] = {}
        self.unknown, self.suffix_spaces, rest = " ⁇ ", False, []
        for number, value in fields(data):
            if number == PIECES:
                piece = dict(fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.kinds.append(piece.get(3, NORMAL))
            elif number == TRAINER:
                trainer = dict(fields(value))
                self.unknown = trainer.get(44, b" \xe2\x81\x87 ").decode()
                self.suffix_spaces = bool(trainer.get(24, 0))
            if number == NORMALIZER:
                spec = dict(fields(value))
            else:
                rest.append((number, value))
        self.prefix, self.trim, self.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
        if not self.escape or self.suffix_spaces:
            raise ValueError("models that leave spaces, or mark them behind words, are not supported")
        self.map = CharacterMap(spec.get(2, b""))
        #: the same model for normalised text: identity, spaces left alone
        self.neutral = message([*rest, (NORMALIZER, message([(1, b"identity"), (3, 0), (4, 0), (5, 1)]))])


class Normalizer:
    """Normalised text with the source of each byte."""

    def __init__(self, model: Model):
        self.model = model

    def replaced(self, data: bytes, i: int, end: int) -> tuple[bytes, np.ndarray, np.ndarray, int]:
        """The text from ``i`` on until ``end`` at least, through the map:
        bytes, for each the begin and end of the source it replaces, and where
        the source goes on."""
        out, begins, ends = [], [], []

        def plain(a, b):
            if b > a:
                raw = np.frombuffer(data, np.uint8, b - a, a)
                begin = np.flatnonzero((raw & 0xC0) != 0x80)
                size = np.diff(np.append(begin, b - a))
                out.append(data[a:b])
                begins.append(np.repeat(begin, size) + a)
                ends.append(np.repeat(begin + size, size) + a)

        starts = self.model.map.starts
        at = i
        while at < end:
            m = starts.search(data, at, end) if starts else None
            while m is not None and (hit := self.model.map.longest(data, m.start())) is None:
                m = starts.search(data, m.end(), end)
            plain(at, m.start() if m else end)
            if m is None:
                at = end
                break
            at, new = hit
            out.append(new)
            begins.append(np.full(len(new), m.start()))
            ends.append(np.full(len(new), at))
        empty = [np.zeros(0, np.int64)]
        return b"".join(out), np.concatenate(begins or empty), np.concatenate(ends or empty), at

    def chunks(self, data: bytes):
        """(normalised text, begins, ends) of stretches of the text in order,
        each cut where a space follows another character.  Without a map a
        stretch ends at such a place at once; with one it is carried over."""
        m = self.model
        held, hb, he = b"", np.zeros(0, np.int64), np.zeros(0, np.int64)
        first, i, spaced = True, 0, m.trim
        while i < len(data):
            end = min(len(data), i + CHUNK)
            while end < len(data) and data[end] & 0xC0 == 0x80:
                end += 1
            new, b, e, i = self.replaced(data, i, end)
            raw = np.frombuffer(new, np.uint8)
            if m.trim and len(raw):
                # of a run of spaces the first stays, at the text's ends none
                space = raw == 32
                before = np.append(spaced, space[:-1])
                stay = ~(space & before)
                spaced = bool(space[-1])
                raw, b, e = raw[stay], b[stay], e[stay]
            if first and m.prefix and (len(raw) or not m.trim):
                raw, b, e = np.append(np.uint8(32), raw), np.append(b[:1] if m.trim else 0, b), np.append(b[:1] if m.trim else 0, e)
            first = first and not len(raw)
            raw, b, e = (np.concatenate(x) for x in ((np.frombuffer(held, np.uint8), raw), (hb, b), (he, e)))
            cut = len(raw)
            if i < len(data):
                # the last space that follows another character opens the next stretch
                inner = np.flatnonzero((raw[1:] == 32) & (raw[:-1] != 32) & (raw[:-1] != SPACE_BYTES[2]))
                cut = int(inner[-1]) + 1 if len(inner) else 0
            elif m.trim:
                # the library takes spaces and U+2581 alike off the end
                text = raw.tobytes().replace(b" ", SPACE_BYTES)
                while text.endswith(SPACE_BYTES):
                    text = text[:-3]
                    cut -= 1 if raw[cut - 1] == 32 else 3
            held, hb, he = raw[cut:].tobytes(), b[cut:], e[cut:]
            if cut:
                yield self.escaped(raw[:cut], b[:cut], e[:cut])

    def escaped(self, raw, b, e):
        """Spaces as U+2581."""
        times = np.where(raw == 32, 3, 1)
        text = raw.tobytes().replace(b" ", SPACE_BYTES).decode()
        return text, np.repeat(b, times), np.repeat(e, times)


class Encoder:
    """Ids and spans of texts with one loaded model."""

    def __init__(self, data: bytes, begin: bool, end: bool):
        import sentencepiece

        self.model = Model(data)
        self.normal = Normalizer(self.model)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=self.model.neutral)
        self.splits = not any(SPACE in p.lstrip(SPACE) for p in self.model.pieces)
        self.boundary = re.compile(f"(?<=[^{SPACE}])(?={SPACE})")
        # normalised bytes of a piece; of byte pieces see ``sizes``
        self.size = np.array([len(p.encode()) * (k != BYTE) for p, k in zip(self.model.pieces, self.model.kinds, strict=True)])
        self.byte = np.full(len(self.size), -1)
        for i, (p, k) in enumerate(zip(self.model.pieces, self.model.kinds, strict=True)):
            if k == BYTE:
                self.byte[i] = int(p[1:-1], 16)
        self.memo: dict[str, bytes] = {}
        self.begin = [self.library.bos_id()] * begin
        self.end = [self.library.eos_id()] * end

    def sizes(self, text: str, a: np.ndarray) -> np.ndarray:
        """The normalised bytes that each id covers.  Of an unknown character's
        byte pieces the last covers it and the others nothing; without byte
        pieces the unknown id covers the characters up to the next known piece."""
        out, value = self.size[a], self.byte[a]
        lead = np.flatnonzero((value >= 0) & ((value < 0x80) | (value >= 0xC0)))
        if len(lead):
            n = 1 + (value[lead] >= 0xC0) + (value[lead] >= 0xE0) + (value[lead] >= 0xF0)
            out[lead + n - 1] = n
        unknown = self.library.unk_id()
        if (a == unknown).any():
            raw, at = text.encode(), 0
            for i, x in enumerate(a.tolist()):
                if x == unknown:
                    after = self.model.pieces[a[i + 1]].encode() if i + 1 < len(a) else b""
                    out[i] = (raw.index(after, at + 1) if after else len(raw)) - at
                at += int(out[i])
        return out

    def known(self, todo: list) -> dict[str, bytes]:
        """Ids, as bytes, of the parts that the memo doesn't hold, all in one
        call of the library."""
        parts = set().union(*(t[2] for t in todo))
        new = list(parts.difference(self.memo))
        if len(self.memo) + len(new) > MEMO_ENTRIES:
            self.memo.clear()
            new = list(parts)
        if not new:
            return {}
        found = self.library.encode(new, num_threads=1)
        flat = np.fromiter(chain.from_iterable(found), np.int32).tobytes()
        end = np.cumsum([4 * len(x) for x in found]).tolist()
        got = {p: flat[i:j] for p, i, j in zip(new, [0, *end], end)}
        self.memo.update(got if max(map(len, new)) <= MEMO_LONGEST else {p: x for p, x in got.items() if len(p) <= MEMO_LONGEST})
        return got

    def pieces_of(self, text: str) -> list[str]:
        if not self.splits:
            return [text]
        if SPACE * 2 in text or text[:1] != SPACE:
            return self.boundary.split(text)
        return [SPACE + w for w in text[1:].split(SPACE)]

    def placed(self, text: str, parts: list[str], b, e, got) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids of a normalised stretch and the source bytes of each piece."""
        memo = self.memo
        a = np.frombuffer(b"".join([memo[p] if p in memo else got[p] for p in parts]), np.int32)
        size = self.sizes(text, a)
        stop = np.cumsum(size)
        if len(a) and stop[-1] != len(b):
            raise ValueError("pieces do not cover the normalised text")
        begin = b[np.minimum(stop - size, len(b) - 1)]
        return a, begin, np.where(size > 0, e[np.maximum(stop - 1, 0)], begin)

    def encode_all(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text the ids, and the begin and end of each piece's source
        bytes.  Parts of several texts go to the library together."""
        done: list[list] = [[] for _ in texts]
        todo: list = []
        held = 0

        def flush():
            got = self.known(todo)
            for k, text, parts, b, e in todo:
                done[k].append(self.placed(text, parts, b, e, got))
            todo.clear()

        for k, data in enumerate(texts):
            for text, b, e in self.normal.chunks(data):
                todo.append((k, text, self.pieces_of(text), b, e))
                held += len(b)
                if held >= CHUNK:
                    flush()
                    held = 0
        if todo:
            flush()

        def whole(stretches, size):
            first, last = np.zeros(len(self.begin), np.int64), np.full(len(self.end), size)
            ids = [np.array(self.begin, np.int32), *(x[0] for x in stretches), np.array(self.end, np.int32)]
            return np.concatenate(ids), *(np.concatenate([first, *(x[i] for x in stretches), last]) for i in (1, 2))
        return [whole(x, len(data)) for x, data in zip(done, texts, strict=True)]

    def encode(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.encode_all([data])[0]


codecs.register_error("one-by-one", lambda e: ("\ufffd", e.start + 1))


class Decoder:
    """Text of ids by table."""

    def __init__(self, data: bytes):
        model = Model(data)
        self.kinds = np.array(model.kinds, np.int8)
        raw = []
        for p, k in zip(model.pieces, model.kinds, strict=True):
            raw.append(b"" if k == CONTROL else model.unknown.encode() if k == UNKNOWN else
                       bytes([int(p[1:-1], 16)]) if k == BYTE else p.replace(SPACE, " ").encode())
        self.size = np.array([len(x) for x in raw], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.table = np.frombuffer(b"".join(raw), np.uint8)
        self.headed = np.array([p.startswith(SPACE) and k not in (UNKNOWN, CONTROL, BYTE)
                                for p, k in zip(model.pieces, model.kinds, strict=True)])
        self.strip, self.trim = model.prefix or model.trim, model.trim

    def decode(self, ids: np.ndarray) -> str:
        """The library's text: one space is taken off the front, bytes that
        are no UTF-8 become U+FFFD one by one, control ids part byte pieces."""
        size, start = self.size[ids], self.start[ids].copy()
        if self.strip:
            for i, x in enumerate(ids.tolist()):
                if self.kinds[x] == CONTROL:
                    continue
                if not self.headed[x]:
                    break
                size[i] -= 1
                start[i] += 1
                if size[i] or not self.trim:
                    break
        raw = []
        for i in range(0, len(ids), CHUNK):
            part = size[i:i + CHUNK]
            end = np.cumsum(part)
            raw.append(self.table[np.arange(end[-1]) + np.repeat(start[i:i + CHUNK] - (end - part), part)].tobytes())
        whole = b"".join(raw)
        kinds = self.kinds[ids]
        control = np.flatnonzero(kinds[1:-1] == CONTROL) + 1 if (kinds == BYTE).any() else []
        if not len(control):
            return whole.decode(errors="one-by-one")
        cuts = [0, *np.cumsum(size)[control].tolist(), len(whole)]
        return "".join(whole[i:j].decode(errors="one-by-one") for i, j in zip(cuts, cuts[1:]))


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
           begin: bool = True, end: bool = True) -> DataFrame:
    """One row per input row: id, ids, starts, ends (arrays of equal length).

    ``ids`` are those that the library gives for the model file's content
    ``model``, with begin and end ids as asked; ``starts`` and ``ends`` bound
    each piece's bytes in the source's UTF-8 (of an unknown character that is
    written in byte pieces, the last has its span and the others an empty one
    where it begins).  A null or empty text has only begin and end ids; null ids
    and repeated rows pass through; an empty table gives no rows; other columns
    are not read.  Memory: one batch of bounded bytes, a longer text alone and
    in stretches, and a bounded memo.
    """
    spark = session(docs)
    shipped = spark.sparkContext.broadcast(model)

    def run(batches):
        encoder = Encoder(shipped.value, begin, end)
        for b in batches:
            data, off = byte_view(b.column(1))
            places = off.tolist()
            done = 0
            while done < b.num_rows:
                i = done + 1
                while i < b.num_rows and places[i + 1] - places[done] <= 4 * CHUNK:
                    i += 1
                rows = encoder.encode_all([data[places[k]:places[k + 1]].tobytes() for k in range(done, i)])
                size = np.cumsum([0] + [len(r[0]) for r in rows]).astype(np.int32)
                cols = [pa.ListArray.from_arrays(pa.array(size), pa.array(np.concatenate([r[k] for r in rows]).astype(np.int32)))
                        for k in range(3)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(done, i - done), *cols], names=["id", "ids", "starts", "ends"])
                done = i

    kept = docs.select(docs[id_col].alias("id"), text_or_empty(docs[text_col]).alias("text"))
    kind = kept.schema["id"].dataType.simpleString()
    return kept.mapInArrow(run, f"id {kind}, ids array<int>, starts array<int>, ends array<int>").withColumnRenamed("id", id_col)


def decode(rows: DataFrame, model: bytes, id_col: str = "doc_id", ids_col: str = "ids", digests: bool = False) -> DataFrame:
    """One row per input row: id, text (the library's for those ids); with
    ``digests`` also n_tokens and the SHA-256 of ids, as little-endian 32-bit
    integers, and of the text, in its place.  Null counts as no ids."""
    spark = session(rows)
    shipped = spark.sparkContext.broadcast(model)

    def run(batches):
        decoder = Decoder(shipped.value)
        for b in batches:
            lists = b.column(1)
            values, off = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            parts = [values[i:j] if ok else values[:0]
                     for i, j, ok in zip(off[:-1], off[1:], lists.is_valid().to_pylist(), strict=True)]
            texts = [decoder.decode(p) for p in parts]
            if not digests:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["id", "text"])
                continue
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(p) for p in parts], pa.int64()),
                 pa.array([hashlib.sha256(p.astype("<u4").tobytes()).hexdigest() for p in parts], pa.string()),
                 pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kept = rows.select(rows[id_col].alias("id"), rows[ids_col].cast("array<int>").alias("ids"))
    kind = kept.schema["id"].dataType.simpleString()
    more = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "text string"
    return kept.mapInArrow(run, f"id {kind}, {more}").withColumnRenamed("id", id_col)
