"""Spelling variants against comparing all words."""

import itertools
import random

import brute

from supplyscope.llm import spelling


def check(df, typo_every=97, min_length=5, min_count=3):
    got = spelling.spelling_groups(df, typo_every=typo_every, min_length=min_length, min_count=min_count).collect()
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = brute.spelling(docs, typo_every, min_length, min_count)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    return got


def test_documents(spark, small):
    assert any(r.form for r in check(small))


def test_odd_rows(spark, odd_docs, no_docs):
    check(odd_docs)
    check(odd_docs, typo_every=2, min_count=1)
    assert spelling.spelling_groups(no_docs).collect() == []


def test_dense_words(spark):
    """All words of a small alphabet, where every node branches; forms in
    chains, ties and words that begin one another."""
    rng = random.Random(3)
    every = ["".join(w) for k in (5, 6) for w in itertools.product("abé", repeat=k)]
    texts = [" ".join([w] * rng.choice((1, 3, 3, 7, 15, 40))) for w in rng.sample(every, 500)]
    chain = [" ".join([w] * 3 * 2 ** i) for i, w in enumerate(("ordre", "order", "orders", "oorders", "oorderss"))]
    runs = [" ".join(["x" * k] * (3 + k % 2)) for k in range(4, 60)]
    mixed = ["ÀÉÿ÷×ab " * 3, "ÀÉÿ÷×aB-ÀÉÿ÷×abc " * 4, "straße strasse STRASSE Straße " * 5, "a1bcdef abcdef abcde,abcdef " * 3]
    df = spark.createDataFrame(list(enumerate(texts + chain + runs + mixed)), "doc_id long, text string").repartition(3)
    got = {r.word: r for r in check(df, typo_every=None)}
    assert got["order"].form == "orders" and got["ordre"].root == "ordre"
    check(df, typo_every=5, min_length=1, min_count=1)


def test_long_texts_are_split_between_runs(monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 7)
    rng = random.Random(5)
    for _ in range(300):
        t = "".join(rng.choice("abé .,") for _ in range(rng.randrange(60)))
        assert [w for p in spelling.pieces(t) for w in spelling.RUN.findall(p)] == spelling.RUN.findall(t)
