"""Hard negatives against scoring all pairs."""

import random

import brute
import numpy as np
import pytest

from supplyscope.llm import negatives
from supplyscope.llm.queries import QUERIES


def same(got, want):
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_embeddings(spark, sf_small):
    rows = [(r.vec_id, r.embedding, None if r.label is None else (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
            for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = QUERIES["op13_hard_negatives"](spark, sf_small).collect()
    assert got
    same(got, brute.hard_negatives(rows, lambda i: i % 100 == 0))


def frame(spark, rows):
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "vec_id long, embedding array<double>, label int, uid int, block string")
    return df.repartition(3)


def check(spark, rows, anchor=lambda i: i is not None and i % 5 == 0):
    df = frame(spark, rows)
    got = negatives.hard_negatives(df, df["vec_id"] % 5 == 0).collect()
    same(got, brute.hard_negatives(rows, anchor))
    return got


def test_odd_rows(spark, monkeypatch):
    """Nulls, values that are not finite, ties, repeated rows and ids, vectors
    without length or of unlike lengths, in blocks of a few rows."""
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 40)
    monkeypatch.setattr(negatives, "RUN_ROWS", 8)
    rng = random.Random(1)
    rows = [(i, [rng.choice((-0.5, 0.0, 0.25, 0.5)) for _ in range(4)], rng.randrange(3)) for i in range(200)]
    rows += rows[:60] + [(5, [0.5, 0.5, 0.25, 0.0], 1), (5, [0.5, 0.5, 0.25, 0.0], 2), (None, [0.5] * 4, 1), (None, None, None)]
    rows += [(10, None, 1), (15, [0.1, None, 0.2, 0.3], 1), (20, [0.1, float("nan"), 0.0, 0.0], 2), (25, [float("inf"), 0.0, 0.0, 0.0], 1)]
    rows += [(30, [0.5, 0.5, 0.5, 0.5], None), (35, [], 1), (40, [0.5, 0.25], 2), (45, [0.0] * 4, 0), (50, [0.5] * 6, 1)]
    assert check(spark, rows)


def test_copies_and_close_vectors(spark, monkeypatch):
    """A vector that a third of the rows share, and clusters tight enough for
    the angles to leave rows out."""
    monkeypatch.setattr(negatives, "RUN_ROWS", 16)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 16))
    rows = [(i, (centres[i % 6] + rng.normal(size=16) * 0.05).tolist(), int(i % 6 // 2)) for i in range(300)]
    rows += [(i, centres[0].tolist(), int(i % 2)) for i in range(300, 450)]
    assert check(spark, rows)


def test_empty_and_single(spark):
    assert check(spark, []) == []
    assert check(spark, [(0, [1.0], 1)]) == []
    assert check(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == []


def test_bounds_hold():
    """No score lies outside its bounds, for rows that nearly coincide too."""
    rng = np.random.default_rng(4)
    refs = rng.normal(size=(5, 8))
    refs /= np.linalg.norm(refs, axis=1)[:, None]
    x = np.rint(rng.normal(size=(200, 8)) * 200)
    x[100:] = x[:100] + rng.integers(-1, 2, size=(100, 8))
    x[:5] = refs * 1000
    norms = np.linalg.norm(x, axis=1)
    angles = np.arccos(np.clip(x @ refs.T / norms[:, None], -1, 1)).astype(np.float32).astype(float)
    product = norms[:, None] * norms
    low, high = negatives.score_bounds(*negatives.angle_bounds(angles, angles, angles), product, product)
    assert (low <= x @ x.T).all() and (x @ x.T <= high).all()
    assert (high < product * 0.99).mean() > 0.3


def test_large_numbers():
    a = np.array([[2 ** 29 + 1, 3]], np.int64)
    assert negatives.scores(a, a, 2.0 ** 59).tolist() == [[(2 ** 29 + 1) ** 2 + 9]]
    with pytest.raises(OverflowError):
        negatives.scores(a, a, 2.0 ** 63)
