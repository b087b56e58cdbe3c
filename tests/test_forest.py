"""the forest by histograms against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from supplyscope.operators import forest, models

KEY = ("named_struct('order_id', id, 'line_number', 1, 'part_key', 1L, 'supp_key', 1L, 'ship_date', timestamp'2020-01-01', "
       "'extended_price', 1.0D, 'line_quantity', 1.0D) AS item_seq")


@pytest.fixture(scope="module")
def lines(spark):
    rng = np.random.default_rng(1)
    names = models.DELIVERY_FEATURES
    rows = []
    for i in range(3000):
        x = [float(rng.integers(0, 4)) if k < 5 else float(rng.normal()) for k in range(len(names))]
        rows.append((*x, int(rng.random() < (0.9 if x[0] > 1 or x[6] > 1 else 0.2)), i))
    rows.append((None, *rows[0][1:-1], 3000))
    return spark.createDataFrame(rows, f"{', '.join(f'{n} double' for n in names)}, late_delivery_risk int, id long").selectExpr("*", KEY)


def test_forest_is_the_same_for_any_layout_and_learns(spark, lines, tmp_path):
    model, split = models.train_delivery_forest(lines.repartition(1), num_trees=20, max_depth=6)
    again, _ = models.train_delivery_forest(lines.repartition(5, F.col("id") % 3), num_trees=20, max_depth=6)
    assert model.featureImportances.toArray().tolist() == pytest.approx(again.featureImportances.toArray().tolist(), abs=1e-12)
    report = models.delivery_held_out(model, split).collect()
    assert sum(r["support"] for r in report) == 600 and all(r["accuracy"] > 0.8 for r in report)
    best = sorted(zip(model.featureImportances.toArray(), models.DELIVERY_FEATURES, strict=True))[-2:]
    assert {n for _, n in best} == {models.DELIVERY_FEATURES[0], models.DELIVERY_FEATURES[6]}
    models.save_model(model, f"{tmp_path}/forest")
    a, b = (sorted((r.id, r.late_prob) for r in models.score_delivery(m, lines).collect()) for m in (model, models.load_forest(f"{tmp_path}/forest")))
    assert a == b and len(a) == 3000 and len({p for _, p in a}) > 100
    assert not [n for n in model.feature.ravel() if n >= len(models.DELIVERY_FEATURES)]


def test_scores_are_the_mean_of_the_leaves(lines):
    """Rows that walk the trees as tables end where a plain walk ends."""
    model, _ = models.train_delivery_forest(lines, num_trees=3, max_depth=5)
    rows = models.score_delivery(model, lines.limit(200)).collect()
    for r in rows:
        p = []
        for feature, cut, stats in zip(model.feature, model.cut, model.stats, strict=True):
            i = 0
            while feature[i] >= 0:
                f = feature[i]
                i = 2 * i + 1 + int(r[model.features[f]] > model.cuts[f][cut[i]])
            p.append(stats[i][1] / stats[i].sum())
        assert r.late_prob == pytest.approx(np.mean(p), abs=6e-5)


def test_best_split_is_the_plain_one():
    rng = np.random.default_rng(2)
    x, y, node = rng.integers(0, 6, (3, 400)), rng.integers(0, 2, 400), rng.integers(0, 4, 400)
    node[node == 2] = 3
    counts = np.zeros((2, 4, forest.BINS, 2), np.int64)
    subset = np.array([[0, 2], [0, 1], [1, 2], [0, 2]])
    for k in range(2):
        np.add.at(counts, (k, node, x[subset[node, k], np.arange(400)], y), 1)
    found = forest.best_splits(counts, subset, (1.0, 2.5))
    assert found["node"].tolist() == [0, 1, 3]

    def impurity(w):
        n = sum(w)
        return 1 - sum((v / n) ** 2 for v in w)
    for i, n in enumerate(found["node"]):
        def weights(at, n=n):
            return [((y == c) & at & (node == n)).sum() * w for c, w in ((0, 1.0), (1, 2.5))]
        whole, best = weights(x[0] >= 0), 0.0
        for f in subset[n]:
            for b in range(5):
                left, right = weights(x[f] <= b), weights(x[f] > b)
                if sum(left) and sum(right):
                    best = max(best, impurity(whole) - (sum(left) * impurity(left) + sum(right) * impurity(right)) / sum(whole))
        assert found["gain"][i] == pytest.approx(best)
        f, b = found["feature"][i], found["bin"][i]
        assert [found["left_zero"][i], found["left_one"][i]] == pytest.approx(weights(x[f] <= b))


def test_bootstrap_is_poisson():
    share = np.bincount(forest.POISSON) / len(forest.POISSON)
    assert share[:3] == pytest.approx([0.3679, 0.3679, 0.1839], abs=1e-4) and (forest.POISSON.mean(), forest.POISSON.var()) == pytest.approx((1, 1), abs=0.01)


def test_no_rows_and_one_class(lines):
    with pytest.raises(ValueError):
        models.train_delivery_forest(lines.limit(0), num_trees=2, max_depth=2)
    model, _ = models.train_delivery_forest(lines.withColumn("late_delivery_risk", F.lit(1)), num_trees=2, max_depth=2)
    assert {r.late_prob for r in models.score_delivery(model, lines).collect()} == {1.0}
