"""The tree whose branches grow in tasks against the library's, and against itself at other branch sizes."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor

from tabloom.operators import deep_tree, trees


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    x = np.stack([rng.normal(size=700), rng.integers(0, 9, 700), rng.exponential(size=700).round(1)], axis=1)
    y = np.round(x[:, 0] * 3) + x[:, 1] * x[:, 2]
    rows = [(i, *map(float, r), float(t), float(t + rng.normal() > 4)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double, k double").coalesce(1)
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).cache()


@pytest.mark.parametrize("depth,leaf", [(30, 1), (6, 1), (30, 7)])
def test_tree_is_the_library_tree(table, depth, leaf):
    theirs = DecisionTreeRegressor(labelCol="y", maxDepth=depth, minInstancesPerNode=leaf).fit(table)
    ours = deep_tree.DeepTree(labelCol="y", maxDepth=depth, minSamplesLeaf=leaf, problem="regression").fit(table)
    a, b = ([r["prediction"] for r in m.transform(table).orderBy("id").collect()] for m in (ours, theirs))
    assert np.allclose(a, b)
    assert np.allclose(ours.featureImportances, theirs.featureImportances.toArray())
    theirs = DecisionTreeClassifier(labelCol="k", maxDepth=depth, minInstancesPerNode=leaf).fit(table)
    ours = deep_tree.DeepTree(labelCol="k", maxDepth=depth, minSamplesLeaf=leaf).fit(table)
    for column in ("rawPrediction", "probability", "prediction"):
        a, b = ([r[column] for r in m.transform(table).orderBy("id").collect()] for m in (ours, theirs))
        assert a == b, column
    assert np.allclose(ours.featureImportances, theirs.featureImportances.toArray())


def test_branches_in_tasks_give_the_same_tree(table, monkeypatch, spark):
    rows = trees.training_rows(table, "features", "k")
    edges = deep_tree.library_edges(rows, 700, 3)
    x = np.array([r["x"] for r in rows.collect()])
    for rules in (deep_tree.Rules(30, 1, 2), deep_tree.Rules(30, 3)):
        monkeypatch.setattr(deep_tree, "LOCAL_ROWS", 1 << 16)
        whole = deep_tree.grow_deep(rows, 700, 3, edges, rules)
        monkeypatch.setattr(deep_tree, "LOCAL_ROWS", 60)
        crown, branches = deep_tree._grow(rows, 700, 3, edges, rules, deep_tree.pack)
        assert len(crown) > 5 and len(branches) > 3
        dealt = deep_tree.grow_deep(rows.repartition(3), 700, 3, edges, rules)
        assert len(dealt["feature"]) == len(whole["feature"])
        assert np.allclose(deep_tree.leaf_values(dealt, edges, x), deep_tree.leaf_values(whole, edges, x))
        assert np.allclose(dealt["gains"], whole["gains"])
    how = trees.Growth(n_trees=1, max_depth=8, min_samples_split=9, max_features="all", splitter="best")
    small = trees.grow(rows, 3, how)[0]
    monkeypatch.setattr(deep_tree, "LOCAL_ROWS", 1 << 16)
    large = trees.grow(rows, 3, how)[0]
    assert sorted(zip(small.feature, small.threshold, small.weight, small.value)) == sorted(zip(large.feature, large.threshold, large.weight, large.value))


def test_driver_holds_bytes_not_nodes(table):
    """About 15 bytes per node reach the driver, whatever the depth."""
    fitted = deep_tree.DeepTree(labelCol="y", problem="regression").fit(table)
    tree, edges = fitted.grown()
    assert sum(v.nbytes for v in tree.values()) < 24 * len(tree["feature"]) + 200
    assert all(len(e) < 32 for e in edges)
    leaves = fitted.leaf_paths()
    assert len(leaves) == (tree["feature"] < 0).sum()
