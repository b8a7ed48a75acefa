"""Order statistics, prefix sums, dense codes and skew-safe joins against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.functions import order_stats
from tabloom.functions.attach import attach
from tabloom.functions.order_stats import exact_quantiles
from tabloom.functions.running import dense_codes, prefix_sums
from tabloom.functions.scalars import at_least, key_hash, token_count


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows hold one value."""
    rng = np.random.default_rng(0)
    x = np.where(np.arange(3000) % 3 == 0, 7.0, rng.normal(10, 5, 3000).round(3))
    return x, spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "id long, x double").repartition(4)


def test_quantiles_small_and_bracketed_agree(skewed):
    x, df = skewed
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    want = np.quantile(x, probs)
    small = exact_quantiles(df, {"x": F.col("x")}, probs)["x"]
    large = exact_quantiles(df, {"x": F.col("x")}, probs, exact_rows=50)["x"]
    np.testing.assert_allclose(small, want, rtol=1e-12)
    np.testing.assert_allclose(large, want, rtol=1e-12)


def test_quantiles_of_mostly_one_value(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, 5.0).otherwise(F.col("id").cast("double")).alias("x"))
    assert exact_quantiles(df, {"x": F.col("x")}, [0.5, 0.99], exact_rows=10)["x"] == pytest.approx([5.0, 989.01])


def test_quantiles_of_all_null_column(spark):
    df = spark.range(10).select(F.lit(None).cast("double").alias("x"))
    assert exact_quantiles(df, {"x": F.col("x")}, [0.5])["x"] == [None]
    assert exact_quantiles(df, {"x": F.col("x")}, [0.5], exact_rows=1)["x"] == [None]


def test_order_statistics_are_exact_integers(spark):
    df = spark.range(5000).select(key_hash("id").alias("h"))
    ranked = sorted(r["h"] for r in df.collect())
    got = order_stats.order_statistics(df, {"h": F.col("h")}, lambda _c, n: [1, n // 2, n], exact_rows=100)["h"]
    assert got[0] == 5000
    assert {k: int(v) for k, v in got[1].items()} == {1: ranked[0], 2500: ranked[2499], 5000: ranked[-1]}


@pytest.mark.parametrize("descending", [False, True])
def test_prefix_sums_split_into_ranges(spark, descending):
    df = spark.range(500).select((F.col("id") * 3 % 501).alias("k"), (F.col("id") % 7).alias("v"))
    got = {r["k"]: r["cum_v"] for r in prefix_sums(df, "k", ["v"], descending, range_rows=40).collect()}
    rows = sorted(((r["k"], r["v"]) for r in df.collect()), reverse=descending)
    total, want = 0, {}
    for k, v in rows:
        total += v
        want[k] = total
    assert got == want


def test_dense_codes_of_strings(spark):
    df = spark.range(400).select(F.format_string("w%03d", F.col("id") % 100).alias("w"))
    got = {r["w"]: r["code"] for r in dense_codes(df, "w", range_rows=10).collect()}
    assert got == {f"w{i:03d}": i for i in range(100)}


def test_attach_hot_and_cold_paths_match_broadcast(spark):
    df = spark.range(600).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"))
    learned = df.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("v", F.length("k") + F.col("n"))
    learned = learned.where("k <> 'k7'")
    a = {(r["id"], r["k"], r["v"]) for r in attach(df, learned, ["k"], "n").collect()}
    b = {(r["id"], r["k"], r["v"]) for r in attach(df, learned, ["k"], "n", broadcast_rows=0).collect()}
    assert a == b and len(a) == 600


def test_attach_cold_keys_beyond_the_hot_set(spark, monkeypatch):
    from tabloom.functions import attach as module

    monkeypatch.setattr(module, "HOT_KEYS", 2)
    df = spark.range(300).select("id", F.when(F.col("id") % 30 != 29, F.col("id") % 30).alias("k"))  # some keys are null
    learned = spark.range(25).select(F.col("id").alias("k"), F.lit(1).alias("n"), (F.col("id") * 2).alias("v"))
    got = {r["id"]: r["v"] for r in attach(df, learned, ["k"], "n", broadcast_rows=0).collect()}
    assert got == {i: (2 * (i % 30) if i % 30 < 25 else None) for i in range(300)}


def test_scalars(spark):
    row = spark.createDataFrame([("  a  b ", "", 0.5)], "s string, e string, p double").select(
        token_count(F.col("s")), token_count(F.col("e")), at_least(F.col("p"), 0.5)
    ).first()
    assert tuple(row) == (2, 0, 1)


def test_quantiles_skip_nan_at_every_size(spark):
    from pyspark.sql import functions as F

    from tabloom.functions.order_stats import exact_quantiles
    from tabloom.operators.profile import column_facts

    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, float("nan")).otherwise(F.col("id").cast("double")).alias("x"))
    small = exact_quantiles(df, {"x": F.col("x")}, [0.25, 0.5, 1.0])
    assert small == exact_quantiles(df, {"x": F.col("x")}, [0.25, 0.5, 1.0], exact_rows=100)
    assert small["x"][2] == 2999.0
    assert column_facts(df)[0]["n_null"] == 1000


def test_lambda_has_no_bound(spark):
    import numpy as np

    from pyspark.sql import functions as F
    from tabloom.operators.power import fit_lambdas

    x = (1 + 0.02 * np.random.default_rng(1).normal(size=4000) * 12) ** (1 / 12)
    x = x[np.isfinite(x)]
    lam = fit_lambdas(spark.createDataFrame([(float(v),) for v in x], "x double"), "box_cox", {"x": F.col("x")})["x"]
    assert lam > 9


def test_wide_tables_are_not_broadcast(spark):
    from pyspark.sql import functions as F

    from tabloom.functions import attach as at

    big = spark.range(40).select("id", F.repeat(F.lit("x"), 1 << 20).alias("v"), F.lit(1).alias("n"))
    out = at.attach(spark.range(60).repartition(3), big, ["id"], "n")
    assert out.where("v is not null").count() == 40


def test_prefix_sums_over_struct_keys(spark):
    from tabloom.functions.running import prefix_sums

    df = spark.range(400).select(F.struct((-(F.col("id") % 7)).cast("double").alias("value"), "id").alias("k"), F.lit(1).cast("long").alias("one"))
    got = {(r["k"]["value"], r["k"]["id"]): r["cum_one"] for r in prefix_sums(df, "k", ["one"], range_rows=20).collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(got))}
