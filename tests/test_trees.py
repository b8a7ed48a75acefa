"""Grown trees against plain searches over all rows."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabloom.operators import models, trees

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    x = np.stack([rng.integers(0, 20, 600), rng.integers(0, 7, 600), rng.integers(0, 40, 600)], axis=1).astype(float)
    y = ((x[:, 0] > 11) ^ (x[:, 2] > 25) | (rng.uniform(size=600) < 0.1)).astype(float)
    df = spark.createDataFrame([(k, *map(float, r), float(t)) for k, (r, t) in enumerate(zip(x, y))], "id long, a double, b double, c double, label double")
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(df).repartition(3).cache(), x, y


def rows_of(df):
    return trees.training_rows(df, "features", "label")


def plain_split(x, y, least):
    """(gain, feature, threshold) of the best split, first feature and smallest threshold at ties."""
    best = (0.0, None, None)
    for f in range(x.shape[1]):
        for cut in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= cut
            if min(left.sum(), (~left).sum()) < least:
                continue
            gain = y[left].sum() ** 2 / left.sum() + y[~left].sum() ** 2 / (~left).sum() - y.sum() ** 2 / len(y)
            if gain > best[0] + 1e-9:
                best = (gain, f, cut)
    return best


def plain_tree(x, y, depth, split, least):
    gain, f, cut = plain_split(x, y, least) if depth and len(y) >= split and len(y) >= 2 * least else (0, None, None)
    if f is None or gain <= 1e-9:
        return y.mean()
    left = x[:, f] <= cut
    return f, cut, round(gain, 6), plain_tree(x[left], y[left], depth - 1, split, least), plain_tree(x[~left], y[~left], depth - 1, split, least)


def shape_of(tree, node=0):
    if tree.feature[node] < 0:
        return tree.value[node]
    return tree.feature[node], tree.threshold[node], round(tree.gain[node], 6), shape_of(tree, tree.left[node]), shape_of(tree, tree.right[node])


def alike(a, b):
    return len(a) == len(b) and a[:3] == b[:3] and alike(a[3], b[3]) and alike(a[4], b[4]) if isinstance(a, tuple) and isinstance(b, tuple) else a == pytest.approx(b)


@pytest.mark.parametrize("depth,split,least", [(2, 2, 1), (6, 2, 1), (6, 60, 1), (6, 2, 25)])
def test_decision_tree_is_the_plain_one(table, depth, split, least):
    df, x, y = table
    how = trees.Growth(1, depth, split, least, "all", "best")
    (tree,) = trees.grow(rows_of(df), 3, how)
    assert alike(shape_of(tree), plain_tree(x, y, depth, split, least))


def test_cells_in_small_groups_give_the_same_trees(table, monkeypatch):
    df, _x, _y = table
    for splitter in ("best", "random"):
        how = trees.Growth(6, 4, 5, 2, "sqrt", splitter, splitter == "best")
        whole = trees.grow(rows_of(df), 3, how)
        monkeypatch.setattr(trees, "CELLS", 1)
        monkeypatch.setattr(trees, "CHUNK", 37)
        again = trees.grow(rows_of(df), 3, how)
        assert len(again) == 6 and all(alike(shape_of(a), shape_of(b)) for a, b in zip(again, whole))
        monkeypatch.undo()


def test_random_thresholds_are_drawn_per_node(table):
    """Every threshold lies between the ends of its node's rows; trees and nodes differ; leaves hold their rows' mean."""
    df, x, y = table
    grown = trees.grow(rows_of(df), 3, trees.Growth(8, 5, 12, 3, "sqrt", "random"))
    cuts = [(f, c) for t in grown for f, c in zip(t.feature, t.threshold) if f >= 0]
    assert len(set(cuts)) == len(cuts) > 60
    for t in grown:
        stack = [(0, np.ones(len(y), bool))]
        while stack:
            node, here = stack.pop()
            assert t.weight[node] == here.sum() and t.value[node] == pytest.approx(y[here].mean())
            if t.feature[node] >= 0:
                v = x[:, t.feature[node]]
                assert v[here].min() <= t.threshold[node] < v[here].max() and here.sum() >= 12
                left = here & (v <= t.threshold[node])
                assert min(left.sum(), (here & ~left).sum()) >= 3
                stack += [(t.left[node], left), (t.right[node], here & ~left)]


def plain_leafwise(x, g, h, how):
    """Best-first growth that looks at one leaf at a time."""

    def best(rows):
        out = (0.0, None, None)
        for f in range(x.shape[1]):
            for cut in np.unique(x[:, f])[:-1]:
                left, right = rows & (x[:, f] <= cut), rows & (x[:, f] > cut)
                if min(left.sum(), right.sum()) < how.min_samples_leaf:
                    continue
                gain = g[left].sum() ** 2 / h[left].sum() + g[right].sum() ** 2 / h[right].sum() - g[rows].sum() ** 2 / h[rows].sum()
                if gain > out[0] + 1e-9:
                    out = (gain, f, cut)
        return out

    whole = np.ones(len(g), bool)
    leaves, splits = [(whole, 0, best(whole))], []
    while len(leaves) < how.leaves:
        able = [(b[0], k) for k, (_r, d, b) in enumerate(leaves) if b[1] is not None and d < how.max_depth]
        if not able:
            break
        rows, d, (gain, f, cut) = leaves.pop(max(able)[1])
        splits.append((f, cut, round(gain, 6)))
        for part in (rows & (x[:, f] <= cut), rows & (x[:, f] > cut)):
            leaves.append((part, d + 1, best(part)))
    return splits, sorted(round(how.rate * g[r].sum() / h[r].sum(), 9) for r, _d, _b in leaves)


@pytest.mark.parametrize("leaves,depth", [(4, 6), (9, 3), (31, 4)])
def test_leafwise_tree_is_the_best_first_one(table, leaves, depth):
    df, x, y = table
    how = trees.Boosting(leaves=leaves, max_depth=depth, min_samples_leaf=15, subsample=1.0)
    p = y.mean()
    base = float(np.log(p / (1 - p)))
    rows = rows_of(df)
    tree = trees.leafwise_tree(rows, 3, trees._slopes([], how, base, True, 0), trees.feature_edges(rows, 3), np.arange(3), how)
    splits, values = plain_leafwise(x, y - p, np.full(len(y), p * (1 - p)), how)
    got = sorted((f, c, g) for f, c, g in zip(tree.feature, tree.threshold, tree.gain) if f >= 0)
    np.testing.assert_allclose(np.array(got), np.array(sorted(splits), float), atol=2e-6)
    assert sorted(round(v, 9) for f, v in zip(tree.feature, tree.value) if f < 0) == pytest.approx(values)


def test_boosting_learns_and_margins_are_written_on_the_way(table, monkeypatch):
    df, _x, y = table
    monkeypatch.setattr(trees, "ROUNDS_KEPT", 2)
    settings = '{"rounds": 7, "rate": 0.3, "max_depth": 4}'
    model = trees.LeafwiseBoosting(settings=settings).fit(df)
    scored = model.transform(df)
    assert scored.where(F.col("prediction") == F.col("label")).count() / len(y) > 0.85
    monkeypatch.setattr(trees, "ROUNDS_KEPT", 50)
    again = trees.LeafwiseBoosting(settings=settings).fit(df)
    assert [alike(shape_of(a), shape_of(b)) for a, b in zip(model.grown(), again.grown())] == [True] * 7


def test_split_limits_make_different_models(table):
    df, _x, _y = table
    sizes = []
    for split in (2, 30, 120):
        m = models.fit(models.get("random_forest"), df.drop("features"), NAMES, {"n_estimators": 4, "max_depth": 6, "min_samples_split": split})
        sizes.append(sum(len(t.feature) for t in m.stages[-1].grown()) if hasattr(m.stages[-1], "grown") else None)
    assert sizes[0] is None and sizes[1] > sizes[2]


def test_ensemble_round_trip(table, tmp_path):
    df, _x, _y = table
    model = trees.Forest(numTrees=3, maxDepth=3).fit(df)
    model.write().save(str(tmp_path / "m"))
    back = trees.TreeEnsemble.load(str(tmp_path / "m"))
    want = [tuple(r) for r in model.transform(df).select("id", "prediction").orderBy("id").collect()]
    assert [tuple(r) for r in back.transform(df).select("id", "prediction").orderBy("id").collect()] == want
    assert back.featureImportances.toArray().sum() == pytest.approx(1)
    with pytest.raises(ValueError):
        trees.Forest().fit(df.limit(0))


def test_sums_meet_in_pieces(table, monkeypatch):
    """Sums of tasks come straight to the driver or meet in pieces first; both are the plain sums."""
    df, x, y = table
    edges = trees.feature_edges(rows_of(df), 3)
    level = trees.Level([(0, trees.Tree([-1], [0.0], [-1], [-1], [0.0], [1.0], [0.0]).arrays())], [np.zeros(1, np.int32)], [np.arange(3)[None, :]], None, edges)
    stats = lambda x, y, h, m, t: np.stack([np.ones(len(y)), y], axis=1)
    want = [np.bincount(np.searchsorted(e, x[:, f]), y, level.width) for f, e in enumerate(edges)]
    for piece, direct in ((1 << 15, 1 << 15), (7, 0), (5, 1 << 15)):
        monkeypatch.setattr(trees, "PIECE", piece)
        monkeypatch.setattr(trees, "DIRECT", direct)
        (got,) = trees.cell_sums(rows_of(df), level, stats, 2)
        assert got.shape == (1, 3, level.width, 2) and got[0, :, :, 0].sum() == 3 * len(y)
        np.testing.assert_allclose(got[0, :, :, 1], want)


def test_binned_rows_boost_the_trees_of_the_values(table):
    df, x, y = table
    rows = rows_of(df)
    edges = trees.feature_edges(rows, 3)
    packed = trees.binned_rows(rows, edges)
    got = {r["h"]: list(r["x"]) for r in packed.collect()}
    assert got == {r["h"]: [int(np.searchsorted(e, v)) for e, v in zip(edges, r["x"])] for r in rows.collect()}
    how = trees.Boosting(rounds=1, leaves=9, min_samples_leaf=15, subsample=1.0, colsample=1.0)
    base, (tree,) = trees.boost(df, "features", "label", 3, how, True)
    plain = trees.leafwise_tree(rows, 3, trees._slopes([], how, base, True, 0), edges, np.arange(3), how)
    assert alike(shape_of(tree), shape_of(plain)) and len(tree.feature) > 5
