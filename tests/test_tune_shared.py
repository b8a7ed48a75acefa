"""Candidates of a search share a fold's rows, edges and bin numbers, and get the trees they would grow alone."""

from pyspark.sql import functions as F

from tabloom.operators import deep_tree, models, trees, tune

NAMES = ["a", "b", "c"]


def frame(spark, n=900):
    df = spark.range(n).select("id", *[(F.xxhash64("id", F.lit(c)) % 1000 / 1000).alias(c) for c in NAMES])
    return df.withColumn("label", (F.col("a") + F.col("b") * F.col("c") > 0.3).cast("double")).withColumn("fold", (F.col("id") % 3).cast("int")).persist()


def test_folds_are_prepared_once_for_all_candidates(spark, monkeypatch):
    calls = {"dealt": 0, "library_edges": 0, "feature_edges": 0}

    def counted(module, name):
        real = getattr(module, name)

        def run(*a, **k):
            calls[name] += 1
            return real(*a, **k)

        run.__name__ = name
        monkeypatch.setattr(module, name, run)

    for module, name in ((trees, "dealt"), (deep_tree, "library_edges"), (trees, "feature_edges")):
        counted(module, name)
    candidates = [{"max_depth": d, "min_samples_split": s} for d in (2, 5, None) for s in (2, 20)]
    got = tune.tune(frame(spark), models.get("decision_tree"), NAMES, "classification", candidates, 3)
    assert len(got.trials) == 6 and calls == {"dealt": 3, "library_edges": 3, "feature_edges": 3}


def test_shared_fits_equal_single_fits(spark, monkeypatch):
    df = frame(spark)
    spec = models.get("decision_tree")
    for local in (deep_tree.LOCAL_ROWS, 100):  # whole in one task, and with a crown
        monkeypatch.setattr(deep_tree, "LOCAL_ROWS", local)
        training = models.Training(df, NAMES)
        for params in ({"max_depth": 6}, {"max_depth": 6, "min_samples_split": 30}):
            shared, alone = training.fit(spec, params).transform(df), models.fit(spec, df, NAMES, params).transform(df)
            pick = lambda x: [(r["id"], r["prediction"], r["probability"]) for r in x.orderBy("id").collect()]
            assert pick(shared) == pick(alone)
        training.done()


def test_bin_numbers_give_the_tree_of_the_values(spark):
    rows = trees.training_rows(models.VectorAssembler(inputCols=NAMES, outputCol="features").transform(frame(spark)), "features", "label").persist()
    edges, rules = trees.feature_edges(rows, 3), deep_tree.Rules(8, 1, least=10)
    plain, coded = (deep_tree.grow_tree(r, 3, edges, rules) for r in (rows, trees.binned_rows(rows, edges)))
    assert vars(plain) == vars(coded)
