"""Token counts of whole texts (operator 5).

Texts go through Arrow to a SentencePiece model; only lengths come back.
Each text is split at safe boundaries, equal segments of a batch are encoded
once, and a batch holds a bounded number of bytes whatever its rows are.

A space after a character that is neither a space nor U+2581 is a safe
boundary: the model writes it as U+2581, no vocabulary piece holds U+2581
after another character, so no merge crosses it, and encoding what follows on
its own puts the same U+2581 back in front.  Both facts are tested when the
model is loaded; a model without them encodes whole texts.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from supplyscope.llm.work import session, slices, text_or_empty

SPACE = "▁"
MEMO_ENTRIES = 300_000
MEMO_LONGEST = 64


class Counter:
    """Counts tokens of texts with one loaded model."""

    def __init__(self, model: bytes, batch_bytes: int = 1 << 20):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.batch_bytes = batch_bytes
        self.boundary = re.compile(f"(?<=[^ {SPACE}]) ")
        self.memo: dict[str, int] = {}
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        self.splits = not any(SPACE in p.lstrip(SPACE) for p in pieces) and all(
            len(self.model.encode(f"{a} {b}")) == len(self.model.encode(a)) + len(self.model.encode(b))
            for a, b in (("a", "b"), ("a", " b"), ("x.", "Y"), ("\n", "b"), ("é", "é"), ("a", "  ")))

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]

    def segments(self, text: str) -> list[str]:
        if "  " in text or SPACE in text or text[:1] == " ":
            return self.boundary.split(text)
        return text.split(" ")

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text, the whole of it."""
        out = [0] * len(texts)
        if not self.splits:
            for i, j in slices([len(t) for t in texts], self.batch_bytes):
                out[i:j] = self.lengths(texts[i:j])
            return out
        parts = [(k, t[i:i + self.batch_bytes]) for k, t in enumerate(texts) for i in (0,)
                 if len(t) <= self.batch_bytes] + [p for k, t in enumerate(texts)
                                                   if len(t) > self.batch_bytes for p in self.cut(k, t)]
        for i, j in slices([len(p) for _, p in parts], self.batch_bytes):
            split = [self.segments(p) for _, p in parts[i:j]]
            new = list(set().union(*split).difference(self.memo))
            got = dict(zip(new, self.lengths(new), strict=True))
            if len(self.memo) + len(got) > MEMO_ENTRIES:
                self.memo.clear()
                new = list(set().union(*split).difference(got))
                got.update(zip(new, self.lengths(new), strict=True))
            long = {s: n for s, n in got.items() if len(s) > MEMO_LONGEST}
            known = self.memo
            known.update(got)
            for (k, _), segs in zip(parts[i:j], split, strict=True):
                # an empty last segment is a space at the text's end: one token
                out[k] += sum(map(known.__getitem__, segs)) + (len(segs) > 1 and segs[-1] == "")
            for s in long:
                del known[s]
        return out

    def cut(self, k: int, text: str):
        """Pieces of a long text that end at safe boundaries, as (k, piece);
        a stretch without one stays whole."""
        i = 0
        while i < len(text):
            m = self.boundary.search(text, i + self.batch_bytes) if len(text) - i > self.batch_bytes else None
            if m is None or m.end() == len(text):
                yield k, text[i:]
                return
            yield k, text[i:m.start()]
            i = m.end()


def token_counts(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096, batch_bytes: int = 1 << 20) -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens, over_limit.

    ``model`` is the content of a SentencePiece model file.  A null or empty
    text has 0 tokens; null ids and repeated rows pass through; other columns
    are not read.  Memory: one Arrow batch (bounded bytes, a longer text
    alone) and a bounded memo of segments.
    """
    spark = session(docs)
    shipped = spark.sparkContext.broadcast(model)

    def run(batches):
        counter = Counter(shipped.value, batch_bytes)
        for b in batches:
            texts = b.column(1).to_pylist()
            n = counter.counts(texts)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=["id", "n_bytes", "n_tokens", "over_limit"])

    kept = docs.select(docs[id_col].alias("id"), text_or_empty(docs[text_col]).alias("text"))
    kind = kept.schema["id"].dataType.simpleString()
    out = kept.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
