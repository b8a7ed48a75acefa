"""Forests of random thresholds grown whole in tasks are those of the passes over the table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import models, selectors, trees

NAMES = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def frame(spark):
    """Features with few values, a constant and nearly constant one, and rows that come twice."""
    df = spark.range(700).select("id", *[(F.xxhash64(F.col("id") % 600, F.lit(c)) % 1000 / w).alias(c) for c, w in zip(NAMES, (1000, 400, 7, 1, 1))])
    df = df.withColumn("d", F.lit(2.5)).withColumn("e", (F.col("id") % 97 == 0).cast("double"))
    return df.withColumn("label", (F.col("a") + F.col("b") * F.col("c") > 0.3).cast("double")).repartition(3).cache()


def alike(a, b):
    assert a.feature == b.feature and a.left == b.left and a.right == b.right and a.threshold == b.threshold
    for name in ("value", "weight", "gain"):
        np.testing.assert_allclose(getattr(a, name), getattr(b, name), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("how", [trees.Growth(7, 10), trees.Growth(4, 6, 9, 3, "all"), trees.Growth(3, 0), trees.Growth(5, 4, 2, 1, 2, seed=7)])
@pytest.mark.parametrize("target", ["label", "a", "b"])
def test_trees_are_those_of_the_passes(frame, how, target, monkeypatch):
    df = models.VectorAssembler(inputCols=NAMES, outputCol="features").transform(frame.coalesce(1))
    prepared = trees.Prepared(df, "features", target)
    monkeypatch.setattr(trees, "ROWS_TIMES_TREES", 1000)  # some trees in each of several tasks
    got, want = trees.grow_in_tasks(prepared.spark, prepared.local, how), trees.grow(prepared.rows, 5, how)
    prepared.done()
    assert len(got) == how.n_trees
    for a, b in zip(got, want):
        alike(a.tree(), b)


def test_a_forest_of_few_rows_is_one_job(frame, monkeypatch):
    spec, params = models.get("extra_trees"), {"n_estimators": 3, "max_depth": 4}
    local = models.fit(spec, frame, NAMES, params).stages[-1].grown()
    monkeypatch.setattr(trees, "LOCAL_BYTES", 0)  # beyond it the rows stay where they are
    passes = models.fit(spec, frame, NAMES, params).stages[-1].grown()
    for a, b in zip(local, passes, strict=True):
        alike(a, b)
    monkeypatch.undo()
    monkeypatch.setattr(trees, "node_ends", None)  # no pass over the table
    assert len(models.fit(spec, frame, NAMES, params).stages[-1].grown()) == 3


def test_an_elimination_reads_its_rows_once(frame, monkeypatch):
    spec, params, calls = models.get("extra_trees"), {"n_estimators": 4, "max_depth": 5}, []
    real = trees.training_rows
    monkeypatch.setattr(trees, "training_rows", lambda *a: calls.append(1) or real(*a))
    path = list(selectors.elimination_path(frame, NAMES, spec, params, 1))
    assert [len(names) for names, _model in path] == [5, 4, 3, 2, 1] and len(calls) == 1
    for names, model in path:
        for a, b in zip(model.stages[-1].grown(), models.fit(spec, frame, names, params).stages[-1].grown(), strict=True):
            alike(a, b)
