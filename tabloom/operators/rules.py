"""Typing and preparation rules: CASE expressions over the profile frame.

Every function takes no data; it builds a Column over the profile's columns, so the
rules run as one projection however many columns a table has.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds of the rules.
NULL_RATIO_LIMIT = 0.9
ID_RATIO_LIMIT = 0.90
HIGH_MISSING = 0.6
SKEW_LIMIT = 1.0
OUTLIER_LIMIT = 0.05
NEAR_ZERO_VARIANCE = 1e-6
HIGH_CARDINALITY = 20
VERY_HIGH_CARDINALITY = 50
QUASI_CONSTANT = 0.95
IMBALANCE = (0.05, 0.95)
SEMANTIC_TOKENS = 6.0
LOW_CARDINALITY_COUNT = 10
COUNT_CARDINALITY = 30
ORDINAL_CARDINALITY = 15
HUGE_VOCABULARY = 100_000

# Ordinal words and their rank, first match in this order decides.
ORDINAL_WORDS = {
    "very low": -1,
    "low": 0,
    "small": 0,
    "near": 0,
    "poor": 0,
    "fair": 1,
    "medium": 1,
    "good": 2,
    "large": 2,
    "far": 2,
    "high": 2,
    "very high": 3,
    "excellent": 3,
}

# Fixed values: (low, high, words in the column name) of periodic domains.
CYCLIC_DOMAINS = (
    (0, 23, ("hour", "hora")),
    (1, 12, ("month", "mes")),
    (0, 6, ("weekday", "dayofweek", "day_of_week", "dia_semana")),
    (1, 7, ("weekday", "dayofweek", "day_of_week", "dia_semana")),
    (1, 31, ("day", "dia")),
    (1, 4, ("quarter", "trimestre")),
)

# Two-valued text columns that are truth values in strict mode (sorted pairs).
BOOLEAN_PAIRS = ("false|true", "no|yes", "no|si", "0|1", "n|y")


def _case(branches: list[tuple[Column, object]], default: object) -> Column:
    out = None
    for cond, value in branches:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


# ---- redundant columns --------------------------------------------------------------


def drop_reason(f: Mapping) -> str | None:
    """First reason that applies: mostly null, constant (null is a value), identifier-like."""
    if f["missing_ratio"] is not None and f["missing_ratio"] > NULL_RATIO_LIMIT:
        return "high_null"
    if f["cardinality_with_null"] <= 1:
        return "constant"
    if f["kind"] in ("string", "int") and f["cardinality"] / f["n"] > ID_RATIO_LIMIT:
        return "identifier"
    return None


# ---- predicates ---------------------------------------------------------------------


def is_high_missing() -> Column:
    return F.coalesce(F.col("missing_ratio") > HIGH_MISSING, F.lit(False))


def needs_imputation() -> Column:
    return F.coalesce(F.col("missing_ratio") > 0, F.lit(False))


def is_skewed() -> Column:
    return F.coalesce(F.abs("skewness") > SKEW_LIMIT, F.lit(False))


def is_near_zero_variance() -> Column:
    return F.coalesce(F.col("variance") < NEAR_ZERO_VARIANCE, F.lit(False))


def has_outliers() -> Column:
    return F.coalesce(F.col("outlier_ratio") > OUTLIER_LIMIT, F.lit(False))


def is_high_cardinality() -> Column:
    return F.coalesce(F.col("cardinality") > HIGH_CARDINALITY, F.lit(False))


def is_quasi_constant() -> Column:
    return F.coalesce(F.col("most_frequent_ratio") > QUASI_CONSTANT, F.lit(False))


def is_imbalanced() -> Column:
    low, high = IMBALANCE
    return F.coalesce((F.col("true_ratio") < low) | (F.col("true_ratio") > high), F.lit(False))


# ---- semantic type ------------------------------------------------------------------


def feature_type(mode: str = "effective") -> Column:
    """Semantic type of a column.

    effective: any two-valued column is boolean.
    strict: a two-valued text column is boolean only for a known truth-value pair.
    """
    kind, two = F.col("kind"), F.col("cardinality") == 2
    if mode == "effective":
        head = [(kind == "bool", "boolean"), (two, "boolean")]
    elif mode == "strict":
        head = [
            (kind == "bool", "boolean"),
            (kind.isin("int", "float") & two, "boolean"),
            ((kind == "string") & two & F.col("value_pair").isin(*BOOLEAN_PAIRS), "boolean"),
            ((kind == "string") & two, "categorical"),
        ]
    else:
        raise ValueError(f"unknown typing mode {mode!r}")
    rest = [
        (kind == "datetime", "datetime"),
        ((kind == "string") & F.coalesce("all_datetime", F.lit(False)), "datetime"),
        ((kind == "string") & (F.col("avg_tokens") >= SEMANTIC_TOKENS), "text"),
        (kind.isin("int", "float"), "numerical"),
    ]
    return _case(head + rest, "categorical")


def ordinal_rank(value: Column) -> Column:
    """Rank of the first ordinal word contained in a lower-case value, else null."""
    return _case([(value.contains(word), rank) for word, rank in ORDINAL_WORDS.items()], F.lit(None).cast("int"))


def categorical_kind() -> Column:
    return F.when(F.coalesce("n_ordinal_matches", F.lit(0)) >= 2, "categorical_ordinal").otherwise("categorical_nominal")


def is_cyclic() -> Column:
    """Column name holds a periodic word and the value range fits that domain."""
    name, hit = F.lower("column"), F.lit(False)
    for low, high, words in CYCLIC_DOMAINS:
        named = F.lit(False)
        for w in words:
            named = named | name.contains(w)
        hit = hit | (named & (F.col("min") >= low) & (F.col("max") <= high))
    return F.coalesce(hit, F.lit(False))


def numeric_subtype() -> Column:
    whole = F.coalesce("is_integer", F.lit(False))
    counting = whole & ~F.coalesce("has_negative", F.lit(False))
    card = F.col("cardinality")
    zero_one = whole & ((card == 0) | ((F.col("min") >= 0) & (F.col("max") <= 1)))
    return _case(
        [
            (zero_one, "binary_encoded"),
            (whole & is_cyclic(), "cyclic"),
            (counting & (card <= LOW_CARDINALITY_COUNT), "low_cardinality_count"),
            (counting & (card <= COUNT_CARDINALITY), "count"),
            (whole & (card <= ORDINAL_CARDINALITY) & F.coalesce("uniform_gaps", F.lit(False)), "ordinal_encoded"),
        ],
        "continuous",
    )


# ---- preparation decisions of numeric columns ----------------------------------------

_ENCODED = ("binary_encoded", "cyclic", "ordinal_encoded", "low_cardinality_count")


def transformation() -> Column:
    sub = F.col("subtype")
    zeros = F.col("zero_ratio") > 0
    return _case(
        [
            (sub.isin(*_ENCODED), "none"),
            ((sub == "count") & zeros, "log1p"),
            (sub == "count", "log"),
            (F.col("has_negative"), "yeo_johnson"),
            (~is_skewed(), "none"),
            (zeros, "log1p"),
            (F.col("skewness") > SKEW_LIMIT, "log"),
        ],
        "yeo_johnson",
    )


def scaler() -> Column:
    sub = F.col("subtype")
    return _case(
        [
            (sub.isin(*_ENCODED), F.lit(None).cast("string")),
            (sub == "count", "robust"),
            (has_outliers() | is_skewed(), "robust"),
        ],
        "standard",
    )


def imputer() -> Column:
    sub = F.col("subtype")
    return _case(
        [
            (sub == "binary_encoded", "mode"),
            (sub.isin("cyclic", "ordinal_encoded", "low_cardinality_count", "count"), "median"),
            (has_outliers() | is_skewed(), "median"),
        ],
        "mean",
    )


def numeric_encoding() -> Column:
    sub = F.col("subtype")
    return _case(
        [
            (sub == "binary_encoded", "binary"),
            (sub == "cyclic", "frequency"),
            (sub == "ordinal_encoded", "ordinal"),
            (sub == "low_cardinality_count", "onehot"),
        ],
        F.lit(None).cast("string"),
    )


# ---- decisions of the other types -----------------------------------------------------


def categorical_encoding() -> Column:
    card, rare = F.col("cardinality"), F.coalesce("has_rare", F.lit(False))
    return _case(
        [
            (F.col("feature_type") == "categorical_ordinal", "ordinal"),
            (card > VERY_HIGH_CARDINALITY, "hashing"),
            ((card > HIGH_CARDINALITY) & rare, "frequency"),
            (card > HIGH_CARDINALITY, "target"),
            (rare, "frequency"),
        ],
        "onehot",
    )


def vectorization() -> Column:
    return _case(
        [(F.col("avg_tokens") >= SEMANTIC_TOKENS, "embeddings"), (F.col("vocab_size") > HUGE_VOCABULARY, "hash")],
        "tfidf",
    )


def decide(facts: DataFrame, mode: str = "effective") -> DataFrame:
    """Add type, subtype, predicates and all decisions to a frame of column facts."""
    typed = facts.withColumn("detected", feature_type(mode)).withColumn(
        "feature_type",
        F.when(F.col("drop_reason").isNotNull(), "identifier")
        .when(F.col("detected") == "categorical", categorical_kind())
        .otherwise(F.col("detected")),
    )
    is_num = F.col("feature_type") == "numerical"
    is_cat = F.col("feature_type").isin("categorical_nominal", "categorical_ordinal")
    sub = typed.withColumn("subtype", F.when(is_num, numeric_subtype()))
    return sub.select(
        "*",
        F.when(is_num, transformation()).alias("transformation"),
        F.when(is_num, scaler()).alias("scaler"),
        F.when(is_num, imputer()).when(is_cat | (F.col("feature_type") == "boolean"), "mode").alias("imputer"),
        F.when(is_num, numeric_encoding()).when(is_cat, categorical_encoding()).alias("encoding"),
        F.when(F.col("feature_type") == "text", vectorization()).alias("vectorization"),
        F.when(F.col("has_time"), "datetime").when(F.col("kind") == "datetime", "date").alias("granularity"),
        F.col("drop_reason").isNotNull().alias("drop"),
        (F.col("cardinality_with_null") == F.col("n")).alias("is_primary_key"),
        is_high_missing().alias("is_high_missing"),
        needs_imputation().alias("needs_imputation"),
        is_skewed().alias("is_skewed"),
        is_near_zero_variance().alias("is_near_zero_variance"),
        has_outliers().alias("has_outliers"),
        is_high_cardinality().alias("is_high_cardinality"),
        is_quasi_constant().alias("is_quasi_constant"),
        is_imbalanced().alias("is_imbalanced"),
    )
