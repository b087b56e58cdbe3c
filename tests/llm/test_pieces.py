"""SentencePiece encoding and decoding against the library."""

import hashlib
import random
import struct

import numpy as np
import pytest
import sentencepiece

from supplyscope.llm import pieces
from supplyscope.llm.queries import QUERIES, tokenizer_model

ODD = ["", " ", "  ", "a", " a", "a ", "  a  b  ", "▁", "▁▁a ▁ b▁c", "ﬁ ①　\n\t\r x", "😀 é😀", "<s> </s> <unk> <0x0A>", "\x00\x01 a\x00b",
       "Hello  world", "日本語のテキスト", "é é", "a​b", "x" * 3000, " " * 3000, "▁" * 50 + " " * 50, "ab " * 2000, "� ﻿"]


def samples(n=400, seed=7):
    rng = random.Random(seed)
    letters = ["a", "b", " ", "  ", "▁", "é", "😀", "\n", "ﬁ", "①", "the", "ing", "<s>", "한", "　", ".", "A", "\x7f", "İ"]
    return ODD + ["".join(rng.choices(letters, k=rng.randrange(1, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def model():
    return tokenizer_model()


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def test_ids_spans_and_text(model, library):
    encoder, decoder = pieces.Encoder(model, True, True), pieces.Decoder(model)
    for t in samples():
        raw = t.encode()
        ids, starts, ends = encoder.encode(raw)
        want = library.encode(t, add_bos=True, add_eos=True)
        assert ids.tolist() == want
        assert decoder.decode(ids) == library.decode(want)
        # the spans are the library's, and together they are the text
        proto = library.encode(t, return_type="proto").pieces
        assert list(zip(starts[1:-1].tolist(), ends[1:-1].tolist())) == [(p.begin, p.end) for p in proto]
        assert b"".join(raw[a:b] for a, b in zip(starts, ends)) == raw


def test_stretches(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "CHUNK", 11)
    encoder, decoder = pieces.Encoder(model, False, False), pieces.Decoder(model)
    for t in samples():
        ids, starts, ends = encoder.encode(t.encode())
        assert ids.tolist() == library.encode(t)
        assert b"".join(t.encode()[a:b] for a, b in zip(starts, ends)) == t.encode()
        assert decoder.decode(ids) == library.decode(ids.tolist())


def test_decoding_any_ids(model, library):
    rng, decoder = random.Random(1), pieces.Decoder(model)
    low = [0, 1, 2, 259, *range(3, 259), *(library.piece_to_id(p) for p in ("▁", "▁▁", "▁a", "a", "▁the"))]
    for _ in range(1500):
        ids = [rng.choice(low) if rng.random() < 0.8 else rng.randrange(32000) for _ in range(rng.randrange(12))]
        assert decoder.decode(np.array(ids, np.int64)) == library.decode(ids)


def compiled(replace):
    """A character map as model files hold it: keys are placed one trie node
    after another at the first offset where all children fit."""
    values, at = b"", {}
    for k in replace:
        at[k] = len(values)
        values += replace[k].encode() + b"\0"
    tree = {}
    for k in replace:
        node = tree
        for c in k.encode():
            node = node.setdefault(c, {})
        node[-1] = at[k]
    units, used = {0: 0}, {0}
    todo = [(0, tree, 0)]
    while todo:
        place, node, label = todo.pop(0)
        children = [0 if c == -1 else c for c in node]
        offset = next(o for o in range(1, 1 << 20) if all((place ^ o ^ c) not in used for c in children))
        units[place] = offset << 10 | (-1 in node) << 8 | label
        used |= {place ^ offset ^ c for c in children}
        for c, x in node.items():
            if c == -1:
                units[place ^ offset] = x | 1 << 31
            else:
                todo.append((place ^ offset ^ c, x, c))
    size = (max(units) // 256 + 1) * 256
    return struct.pack("<I", 4 * size) + struct.pack(f"<{size}I", *(units.get(i, 0) for i in range(size))) + values


MAP = {"ﬁ": "fi", "①": "1", "　": " ", "A": "a", "é": "é", "é": "e", "\n": " ", "abc": "x", "ab": "yy", "abca": "zé", "한": "", "th": "the"}


@pytest.mark.parametrize("prefix, trim", [(1, 0), (0, 0), (1, 1), (0, 1)])
def test_character_map(model, prefix, trim, monkeypatch):
    spec = pieces.message([(1, b"own"), (2, compiled(MAP)), (3, prefix), (4, trim), (5, 1)])
    own = b"".join(pieces.message([(k, v)]) for k, v in pieces.fields(model) if k != pieces.NORMALIZER) + pieces.message([(3, spec)])
    library = sentencepiece.SentencePieceProcessor(model_proto=own)
    for size in (1 << 20, 9):
        monkeypatch.setattr(pieces, "CHUNK", size)
        encoder, decoder = pieces.Encoder(own, False, False), pieces.Decoder(own)
        for t in samples(300) + ["abcabcab abca", "thththe", "ab" * 40, "한", " 한 ", "한a"]:
            ids, starts, ends = encoder.encode(t.encode())
            assert ids.tolist() == library.encode(t), t
            assert decoder.decode(ids) == library.decode(ids.tolist())
            # where characters are dropped the library begins a piece at the first of those before it
            assert "한" in t or starts.tolist() == [p.begin for p in library.encode(t, return_type="proto").pieces]
            assert (starts <= ends).all() and (np.diff(starts) >= 0).all()


def test_query_and_odd_rows(spark, sf_small, odd_docs, no_docs, model, library):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")

    def want(rows):
        out = []
        for r in rows:
            ids = library.encode(r.text or "", add_bos=True, add_eos=True)
            out.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                        hashlib.sha256(library.decode(ids).encode()).hexdigest()))
        return sorted(map(str, out))
    got = QUERIES["op11_sentencepiece"](spark, sf_small)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(str, map(tuple, got.collect()))) == want(docs.select("doc_id", "text").collect())
    odd = pieces.decode(pieces.encode(odd_docs, model), model, digests=True)
    assert sorted(map(str, map(tuple, odd.collect()))) == want(odd_docs.select("doc_id", "text").collect())
    assert pieces.decode(pieces.encode(no_docs, model), model).collect() == []
    texts = pieces.decode(pieces.encode(odd_docs, model, begin=False, end=False), model).collect()
    assert sorted(r.text for r in texts) == sorted((r.text or "") for r in odd_docs.select("text").collect())
    none = spark.createDataFrame([(1, None), (None, [5])], "doc_id long, ids array<int>")
    assert sorted((r.text or "") for r in pieces.decode(none, model).collect())[0] == ""
