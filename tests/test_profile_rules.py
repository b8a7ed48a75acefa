import pytest
from pyspark.sql import functions as F

from tabloom.operators import profile as prof
from tabloom.operators import rules
from tabloom.operators.columns import drop_redundant, redundant_columns


def decide(spark, mode="effective", **facts):
    base = {
        "column": "c", "kind": "float", "n": 100, "n_null": 0, "missing_ratio": 0.0, "cardinality": 50,
        "cardinality_with_null": 50, "skewness": 0.0, "zero_ratio": 0.0, "has_negative": False, "outlier_ratio": 0.0,
        "variance": 1.0, "min": 0.5, "max": 90.0, "is_integer": False, "most_frequent_ratio": 0.1, "has_rare": False,
    }
    return rules.decide(prof.facts_frame(spark.range(1), [{**base, **facts}]), mode).first()


@pytest.mark.parametrize("ratio,want", [(0.5, False), (0.6, False), (0.7, True)])
def test_high_missing_is_exclusive(spark, ratio, want):
    assert decide(spark, missing_ratio=ratio)["is_high_missing"] is want


@pytest.mark.parametrize("ratio,want", [(0.1, False), (0.04, True), (0.99, True), (0.05, False), (0.95, False), (0.0, True), (1.0, True)])
def test_boolean_imbalance(spark, ratio, want):
    assert decide(spark, true_ratio=ratio)["is_imbalanced"] is want


@pytest.mark.parametrize(
    "facts,want",
    [
        ({"skewness": 0.0}, ("none", "standard", "mean")),
        ({"skewness": 2.5}, ("log", "robust", "median")),
        ({"skewness": 2.5, "zero_ratio": 0.1}, ("log1p", "robust", "median")),
        ({"skewness": -2.5}, ("yeo_johnson", "robust", "median")),
        ({"has_negative": True}, ("yeo_johnson", "standard", "mean")),
        ({"outlier_ratio": 0.05}, ("none", "standard", "mean")),
        ({"outlier_ratio": 0.06}, ("none", "robust", "median")),
        ({"is_integer": True, "cardinality": 20}, ("log", "robust", "median")),
        ({"is_integer": True, "cardinality": 20, "zero_ratio": 0.1}, ("log1p", "robust", "median")),
    ],
)
def test_numeric_decisions(spark, facts, want):
    r = decide(spark, **facts)
    assert (r["transformation"], r["scaler"], r["imputer"]) == want


@pytest.mark.parametrize(
    "facts,want",
    [
        ({"is_integer": True, "cardinality": 1, "min": 1.0, "max": 1.0, "cardinality_with_null": 2}, "binary_encoded"),
        ({"is_integer": True, "column": "event_hour", "cardinality": 24, "min": 0.0, "max": 23.0}, "cyclic"),
        ({"is_integer": True, "column": "event_hour", "cardinality": 25, "min": 0.0, "max": 24.0}, "count"),
        ({"is_integer": True, "column": "times", "cardinality": 12, "min": 1.0, "max": 12.0}, "cyclic"),
        ({"is_integer": True, "cardinality": 10}, "low_cardinality_count"),
        ({"is_integer": True, "cardinality": 11}, "count"),
        ({"is_integer": True, "cardinality": 31}, "continuous"),
        ({"is_integer": True, "cardinality": 5, "has_negative": True, "min": -2.0, "uniform_gaps": True}, "ordinal_encoded"),
        ({"is_integer": True, "cardinality": 5, "has_negative": True, "min": -2.0, "uniform_gaps": False}, "continuous"),
        ({"is_integer": False, "cardinality": 5}, "continuous"),
    ],
)
def test_numeric_subtype(spark, facts, want):
    assert decide(spark, **facts)["subtype"] == want


@pytest.mark.parametrize(
    "card,rare,want", [(5, False, "onehot"), (5, True, "frequency"), (21, False, "target"), (21, True, "frequency"), (50, False, "target"), (51, True, "hashing")]
)
def test_categorical_encoding(spark, card, rare, want):
    assert decide(spark, kind="string", cardinality=card, has_rare=rare, avg_tokens=1.0)["encoding"] == want


def test_two_valued_text_depends_on_mode(spark):
    facts = {"kind": "string", "cardinality": 2, "avg_tokens": 1.0, "value_pair": "female|male"}
    assert decide(spark, **facts)["feature_type"] == "boolean"
    assert decide(spark, "strict", **facts)["feature_type"] == "categorical_nominal"
    assert decide(spark, "strict", **{**facts, "value_pair": "no|yes"})["feature_type"] == "boolean"


def test_first_ordinal_word_decides(spark):
    df = spark.createDataFrame([("Very High",), ("high ",), ("LOW",), ("other",), (None,)], "risk string")
    got = prof.ordinal_order(df, ["risk"]).first()
    assert got["category_order"] == ["low", "high", "very high"] and got["n_matches"] == 3


def test_ordinal_positions_of_any_number_of_wordings(spark):
    df = spark.range(1500).select(F.format_string("low %04d", "id").alias("many"), F.lit("high").alias("one"), F.element_at(F.array(*map(F.lit, ["Low", "high", "other"])), (F.col("id") % 3 + 1).cast("int")).alias("two"))
    got = {(r["column"], r["value"]): r["position"] for r in prof.ordinal_positions(df, ["many", "one", "two"]).collect()}
    assert got == {("many", f"low {k:04d}"): k for k in range(1500)} | {("two", "low"): 0, ("two", "high"): 1}
    assert prof.ordinal_positions(df.limit(0), ["many", "two"]).count() == 0


def test_redundant_columns_in_priority_order(spark):
    df = spark.range(100).select(
        "id", F.lit(1).alias("one"), F.when(F.col("id") < 5, 1.0).alias("sparse"), (F.col("id") % 7).alias("ok"),
        F.col("id").cast("double").alias("real"),
    )
    got = {r["column"]: (r["reason"], r["is_primary_key"]) for r in redundant_columns(df).collect()}
    assert got == {"id": ("identifier", True), "one": ("constant", False), "sparse": ("high_null", False)}
    assert drop_redundant(df)[0].columns == ["ok", "real"]


def test_profile_of_empty_and_all_null(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), (None, "c")], "x double, s string")
    got = {r["column"]: r["drop_reason"] for r in prof.profile(df).collect()}
    assert got == {"x": "high_null", "s": "identifier"}
    assert prof.profile(df.where("s = 'z'")).count() == 2


def test_text_statistics_use_whole_tokens(spark):
    df = spark.createDataFrame([("The cat sat on the big mat",), ("",), (None,)], "t string")
    r = prof.text_profile(df, ["t"]).first()
    assert (r["avg_tokens"], r["vocab_size"], r["is_semantic"]) == (3.5, 6, False)
