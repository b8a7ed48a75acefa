"""What a profile reads: texts once per value, quartiles of few values from their counts, a joined frame once."""

import numpy as np
from pyspark.sql import functions as F

from tabloom.functions import order_stats
from tabloom.operators import profile as prof
from tabloom.plans import profile_queries


def test_quartiles_of_few_values_need_no_sketch(spark, monkeypatch):
    def no_sketch(*_):
        raise AssertionError("a column of few values was searched by rank")

    monkeypatch.setattr(order_stats, "_narrow", no_sketch)
    df = spark.range(500).select(
        (F.col("id") % 7).alias("a"), F.when(F.col("id") % 3 > 0, (F.col("id") % 11) / 4).alias("b"), F.lit(None).cast("double").alias("c")
    )
    exprs = {c: F.col(c) for c in "abc"}
    got = order_stats.exact_quantiles(df, exprs, [0.25, 0.5, 0.9], 500, exact_rows=10, distinct={"a": 7, "b": 11, "c": 0})
    rows = df.toPandas()
    for c in "ab":
        assert np.allclose(got[c], rows[c].dropna().quantile([0.25, 0.5, 0.9]))
    assert got["c"] == [None] * 3


def test_wording_of_repeated_long_and_missing_texts(spark):
    values = ["yes", "yes", " TRUE ", "2024-05-01", "no", None, "x" * 100, "x" * 100]
    df = spark.createDataFrame([(v, None, "2024-05-01" if v else None) for v in values], "t string, gone string, day string").repartition(3)
    got = {r["column"]: r for r in prof.worded_rollup(df, df.columns).collect()}
    t, gone, day = (got[c] for c in df.columns)
    assert (t["n"], t["n_seen"], t["cardinality"], t["cardinality_with_null"]) == (8, 7, 5, 6)
    assert abs(t["true_ratio"] - 3 / 7) < 1e-12 and t["avg_tokens"] == 1.0 and not t["all_datetime"] and day["all_datetime"]
    assert (gone["n"], gone["n_seen"], gone["cardinality"], gone["true_ratio"], gone["avg_tokens"], gone["all_datetime"]) == (8, 0, 0, None, None, False)
    facts = {f["column"]: f for f in prof.column_facts(df)}
    assert facts["t"]["n_null"] == 1 and facts["gone"]["missing_ratio"] == 1.0


def test_profile_joins_a_frame_once(spark, monkeypatch):
    joins = spark.sparkContext.accumulator(0)

    def orders(session, _sf):
        def seen(batches):
            for b in batches:
                joins.add(b.num_rows)
                yield b

        return session.range(100).selectExpr("id", "id % 4 as kind").mapInArrow(seen, "id bigint, kind bigint")

    monkeypatch.setattr(profile_queries, "orders_frame", orders)
    got = {r["column"]: r["subtype"] for r in profile_queries.profiled(orders, spark, "").collect()}
    assert joins.value == 100 and got["kind"] == "low_cardinality_count"
