"""Equivalent SQL text for profile-based queries, generated per frame."""

from __future__ import annotations

from collections.abc import Mapping

from tabloom.operators import rules

WORDS = "('true','yes','si','1','y')"


def with_frame(frame: str, body: str) -> str:
    return f"WITH t AS ({frame}) {body}"


def sig(x: str) -> str:
    """Nine significant digits."""
    p = f"pow(10.0, floor(log10(abs({x}))))"
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} = 0 THEN 0.0 ELSE round({x} / {p}, 8) * {p} END"


def hash_sql(key: str, seed: int = 42) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 13) AS BIGINT)"


def tokens_sql(c: str) -> str:
    return f"regexp_extract_all({c}, '\\S+')"


def _ordinal_case(v: str) -> str:
    whens = " ".join(f"WHEN contains({v}, '{w}') THEN {r}" for w, r in rules.ORDINAL_WORDS.items())
    return f"CASE {whens} END"


def ordinal_values_sql(frame: str, columns: list[str]) -> str:
    parts = [
        f"SELECT DISTINCT '{c}' AS \"column\", lower(trim({c})) AS value FROM t WHERE {c} IS NOT NULL" for c in columns
    ]
    return with_frame(frame, f'SELECT "column", value, {_ordinal_case("value")} AS rank FROM ({" UNION ALL ".join(parts)})')


def column_stats(c: str, kind: str) -> str:
    num, txt = kind in ("int", "float"), kind == "string"
    d, b = "CAST(NULL AS DOUBLE)", "CAST(NULL AS BOOLEAN)"
    x = f"CAST({c} AS DOUBLE)"
    freq = f"(SELECT {c} AS v, count(*) AS k FROM t WHERE {c} IS NOT NULL GROUP BY {c})"
    q = f"(SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.75) AS q3 FROM t)"
    outlier = (
        f"(SELECT CASE WHEN max(q3) = max(q1) THEN 0.0 ELSE coalesce(avg(CASE WHEN {c} < q1 - 1.5 * (q3 - q1) "
        f"OR {c} > q3 + 1.5 * (q3 - q1) THEN 1.0 ELSE 0.0 END), 0.0) END FROM t, {q} WHERE {c} IS NOT NULL)"
    )
    gaps = (
        f"(SELECT count(DISTINCT g) = 1 FROM (SELECT v - lag(v) OVER (ORDER BY v) AS g FROM "
        f"(SELECT DISTINCT {c} AS v FROM t WHERE {c} IS NOT NULL)) WHERE g IS NOT NULL)"
    )
    true = (
        f"avg(CASE WHEN lower(trim({c})) IN {WORDS} THEN 1.0 WHEN {c} IS NOT NULL THEN 0.0 END)"
        if txt
        else f"avg(CASE WHEN {c} THEN 1.0 WHEN NOT {c} THEN 0.0 END)"
        if kind == "bool"
        else f"avg(CASE WHEN {c} <> 0 THEN 1.0 WHEN {c} = 0 THEN 0.0 END)"
        if num
        else d
    )
    words = (
        f"(SELECT count(*) FROM (SELECT DISTINCT lower(trim({c})) AS v FROM t WHERE {c} IS NOT NULL) "
        f"WHERE {_ordinal_case('v')} IS NOT NULL)"
        if txt
        else "0"
    )
    fields = {
        '"column"': f"'{c}'",
        "kind": f"'{kind}'",
        "n": "count(*)",
        "n_null": f"count(*) - count({c})",
        "missing_ratio": f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)",
        "cardinality": f"count(DISTINCT {c})",
        "cardinality_with_null": f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)",
        "skewness": f"skewness({x})" if num else d,
        "zero_ratio": f"coalesce(avg(CASE WHEN {c} = 0 THEN 1.0 WHEN {c} IS NOT NULL THEN 0.0 END), 0.0)" if num else d,
        "has_negative": f"coalesce(bool_or({c} < 0), false)" if num else b,
        "variance": f"var_samp({x})" if num else d,
        "q25": f"quantile_cont({x}, 0.25)" if num else d,
        "q50": f"quantile_cont({x}, 0.5)" if num else d,
        "q75": f"quantile_cont({x}, 0.75)" if num else d,
        "vmin": f"CAST(min({c}) AS DOUBLE)" if num else d,
        "vmax": f"CAST(max({c}) AS DOUBLE)" if num else d,
        "is_integer": f"coalesce(bool_and({x} = floor({x})), true)" if num else b,
        "outlier_ratio": outlier if num else d,
        "uniform_gaps": gaps if kind == "int" else ("false" if kind == "float" else b),
        "most_frequent_ratio": f"(SELECT coalesce(max(k) / CAST(sum(k) AS DOUBLE), 0.0) FROM {freq})",
        "has_rare": f"(SELECT coalesce(min(k) / CAST(sum(k) AS DOUBLE) < 0.01, false) FROM {freq})",
        "true_ratio": true,
        "avg_tokens": f"avg(CASE WHEN {c} IS NOT NULL THEN len({tokens_sql(c)}) END)" if txt else d,
        "all_datetime": f"coalesce(bool_and(try_cast({c} AS TIMESTAMP) IS NOT NULL), false)" if txt else b,
        "value_pair": (
            f"(SELECT CASE WHEN count(*) = 2 THEN string_agg(v, '|' ORDER BY v) END FROM "
            f"(SELECT DISTINCT lower(trim({c})) AS v FROM t WHERE {c} IS NOT NULL))"
            if txt
            else "CAST(NULL AS VARCHAR)"
        ),
        "n_words": words,
    }
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in fields.items()) + " FROM t"


def _cyclic() -> str:
    tests = []
    for low, high, words in rules.CYCLIC_DOMAINS:
        named = " OR ".join(f"contains(lower(\"column\"), '{w}')" for w in words)
        tests.append(f"(({named}) AND vmin >= {low} AND vmax <= {high})")
    return "coalesce(" + " OR ".join(tests) + ", false)"


def typed(frame: str, columns: Mapping[str, str], mode: str = "effective") -> str:
    """CTEs ``t``, ``s`` (statistics), ``d`` (decisions); append a SELECT over d."""
    stats = " UNION ALL ".join(column_stats(c, k) for c, k in columns.items())
    drop = (
        "CASE WHEN missing_ratio > 0.9 THEN 'high_null' WHEN cardinality_with_null <= 1 THEN 'constant' "
        "WHEN kind IN ('string', 'int') AND cardinality / CAST(n AS DOUBLE) > 0.9 THEN 'identifier' END"
    )
    if mode == "effective":
        head = "WHEN kind = 'bool' THEN 'boolean' WHEN cardinality = 2 THEN 'boolean'"
    else:
        head = (
            "WHEN kind = 'bool' THEN 'boolean' WHEN kind IN ('int','float') AND cardinality = 2 THEN 'boolean' "
            "WHEN kind = 'string' AND cardinality = 2 AND value_pair IN ('false|true','no|yes','no|si','0|1','n|y') "
            "THEN 'boolean' WHEN kind = 'string' AND cardinality = 2 THEN 'categorical'"
        )
    detect = (
        f"CASE {head} WHEN kind = 'datetime' THEN 'datetime' WHEN kind = 'string' AND all_datetime THEN 'datetime' "
        "WHEN kind = 'string' AND avg_tokens >= 6 THEN 'text' WHEN kind IN ('int','float') THEN 'numerical' ELSE 'categorical' END"
    )
    skewed = "coalesce(abs(skewness) > 1.0, false)"
    outl = "coalesce(outlier_ratio > 0.05, false)"
    enc = "('binary_encoded','cyclic','ordinal_encoded','low_cardinality_count')"
    return f"""
WITH t AS ({frame}), s AS ({stats}),
d0 AS (SELECT *, {drop} AS drop_reason, {detect} AS detected FROM s),
d1 AS (SELECT *, CASE WHEN drop_reason IS NOT NULL THEN 'identifier' WHEN detected = 'categorical' THEN
  CASE WHEN n_words >= 2 THEN 'categorical_ordinal' ELSE 'categorical_nominal' END ELSE detected END AS feature_type FROM d0),
d2 AS (SELECT *, CASE WHEN feature_type = 'numerical' THEN CASE
  WHEN is_integer AND vmin >= 0 AND vmax <= 1 THEN 'binary_encoded'
  WHEN is_integer AND {_cyclic()} THEN 'cyclic'
  WHEN is_integer AND NOT has_negative AND cardinality <= 10 THEN 'low_cardinality_count'
  WHEN is_integer AND NOT has_negative AND cardinality <= 30 THEN 'count'
  WHEN is_integer AND cardinality <= 15 AND uniform_gaps THEN 'ordinal_encoded'
  ELSE 'continuous' END END AS subtype FROM d1),
d AS (SELECT *, {skewed} AS is_skewed, {outl} AS has_outliers,
  CASE WHEN feature_type = 'numerical' THEN CASE WHEN subtype IN {enc} THEN 'none'
    WHEN subtype = 'count' AND zero_ratio > 0 THEN 'log1p' WHEN subtype = 'count' THEN 'log'
    WHEN has_negative THEN 'yeo_johnson' WHEN NOT {skewed} THEN 'none' WHEN zero_ratio > 0 THEN 'log1p'
    WHEN skewness > 1.0 THEN 'log' ELSE 'yeo_johnson' END END AS transformation,
  CASE WHEN feature_type = 'numerical' AND subtype NOT IN {enc} THEN CASE WHEN subtype = 'count' OR {outl} OR {skewed}
    THEN 'robust' ELSE 'standard' END END AS scaler,
  CASE WHEN feature_type = 'numerical' THEN CASE WHEN subtype = 'binary_encoded' THEN 'mode'
    WHEN subtype <> 'continuous' OR {outl} OR {skewed} THEN 'median' ELSE 'mean' END
    WHEN feature_type IN ('boolean', 'categorical_nominal', 'categorical_ordinal') THEN 'mode' END AS imputer,
  CASE WHEN feature_type = 'numerical' THEN CASE subtype WHEN 'binary_encoded' THEN 'binary' WHEN 'cyclic' THEN 'frequency'
      WHEN 'ordinal_encoded' THEN 'ordinal' WHEN 'low_cardinality_count' THEN 'onehot' END
    WHEN feature_type = 'categorical_ordinal' THEN 'ordinal'
    WHEN feature_type = 'categorical_nominal' THEN CASE WHEN cardinality > 50 THEN 'hashing'
      WHEN cardinality > 20 AND has_rare THEN 'frequency' WHEN cardinality > 20 THEN 'target'
      WHEN has_rare THEN 'frequency' ELSE 'onehot' END END AS encoding
  FROM d2)
"""


def per_column_sql(frame: str, exprs: Mapping[str, Mapping[str, str]]) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", " + ", ".join(f"{e} AS {n}" for n, e in stats.items()) + " FROM t"
        for c, stats in exprs.items()
    ]
    return with_frame(frame, " UNION ALL ".join(parts))
