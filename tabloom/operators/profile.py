"""Column profiling in a fixed number of scans, however many columns there are.

scan 1  every moment, range and flag of every number, date and boolean in one aggregation
scan 2  value frequencies of every column: unpivot, count per (column, value), roll up; wording of texts once per value
scan 3  exact quartiles (one aggregation when small, from counts where values are few, bracketed otherwise)
scan 4  outlier share and gap regularity with literal fences
scan 5  only if text columns exist: vocabulary size
Only O(columns) scalars reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.order_stats import exact_quantiles
from tabloom.functions.running import dense_codes
from tabloom.functions.scalars import (
    INTEGRAL,
    NUMERIC,
    TEMPORAL,
    TRUE_WORDS,
    is_whole,
    safe_div,
    token_array,
    token_count,
    trimmed_lower,
)
from tabloom.operators import rules
from tabloom.session import together
from tabloom.sources.tables import normalise_nan

LONG_VALUE = 64  # longer strings are counted by digest, so a shuffle never carries whole texts


def kind_of(dtype: T.DataType) -> str:
    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, INTEGRAL):
        return "int"
    if isinstance(dtype, NUMERIC):
        return "float"
    if isinstance(dtype, TEMPORAL):
        return "datetime"
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return "string"
    return "other"


def kinds(df: DataFrame, columns: Iterable[str] | None = None) -> dict[str, str]:
    """Physical kind per column; nested columns are not profiled."""
    wanted = set(columns) if columns is not None else None
    out = {f.name: kind_of(f.dataType) for f in df.schema.fields if wanted is None or f.name in wanted}
    return {c: k for c, k in out.items() if k != "other"}


def ident(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def per_column(df: DataFrame, stats: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """One aggregation, one output row per column: ``column`` plus the named statistics."""
    names = list(stats)
    row = df.agg(
        *[F.struct(F.lit(c).alias("column"), *[e.alias(s) for s, e in stats[c].items()]).alias(f"s{i}") for i, c in enumerate(names)]
    )
    return row.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(names))])))


# ---- scan 1: moments, ranges, flags -------------------------------------------------


def missing_ratio(c: Column) -> Column:
    return F.avg(c.isNull().cast("double"))


def zero_ratio(c: Column) -> Column:
    return F.coalesce(F.avg((c == 0).cast("double")), F.lit(0.0))


def has_negative(c: Column) -> Column:
    return F.coalesce(F.bool_or(c < 0), F.lit(False))


def skewness(c: Column) -> Column:
    """Bias-corrected (adjusted Fisher-Pearson) skewness; 0 for a constant, null below three values."""
    n = F.count(c).cast("double")
    factor = F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    return F.when(F.count(c) >= 3, F.coalesce(F.skewness(c.cast("double")), F.lit(0.0)) * factor)


def variance(c: Column) -> Column:
    return F.var_samp(c.cast("double"))


def all_whole(c: Column) -> Column:
    return F.coalesce(F.bool_and(is_whole(c)), F.lit(True))


def true_ratio(c: Column, kind: str) -> Column:
    if kind == "string":
        return F.avg(trimmed_lower(c).isin(*TRUE_WORDS).cast("double"))
    if kind == "bool":
        return F.avg(c.cast("double"))
    return F.avg((c != 0).cast("double"))


def has_time(c: Column) -> Column:
    return F.coalesce(F.bool_or((F.hour(c) != 0) | (F.minute(c) != 0)), F.lit(False))


def parses_as_datetime(c: Column) -> Column:
    """Every non-null value reads as a date or timestamp."""
    return F.coalesce(F.bool_and(F.try_to_timestamp(c).isNotNull()), F.lit(False))


def mean_tokens(c: Column) -> Column:
    return F.avg(F.when(c.isNotNull(), token_count(c).cast("double")))


_MOMENTS = {
    "skew_pop": "skewness(value)",
    "zero_ratio": "coalesce(avg(cast(value = 0 as double)), 0d)",
    "variance": "var_samp(value)",
    "mean": "avg(value)",
    "min": "min(value)",
    "max": "max(value)",
    "whole": "coalesce(bool_and(value = floor(value)), true)",
}
#: of one text; null where there is none
_WORDING = {
    "is_true": f"lower(trim(text)) in ({', '.join(repr(w) for w in TRUE_WORDS)})",
    "tokens": r"case when text is not null then size(array_remove(split(text, '\\\\s+'), '')) end",
    "is_datetime": "case when text is not null then try_to_timestamp(text) is not null end",
}
_MOMENTS_IN_TIME = {
    "min_date": "cast(min(value) as string)",
    "max_date": "cast(max(value) as string)",
    "has_time": "coalesce(bool_or(hour(value) != 0 or minute(value) != 0), false)",
}


def _long_stats(df: DataFrame, columns: Sequence[str], cast: str | None, stats: Mapping[str, str]) -> DataFrame:
    """``column, n, n_seen`` and the given aggregates of ``value`` per column.

    One group per column over the unpivoted values keeps the generated aggregation loop
    small however many columns there are; partial aggregation leaves one row per column
    and task, so nothing but those rows is shuffled.
    """
    cols = [(ident(c).cast(cast) if cast else ident(c)).alias(c) for c in columns]
    long = df.select(*cols).unpivot([], [f"`{c}`" for c in columns], "column", "value")
    base = {"n": "count(1)", "n_seen": "count(value)"}
    return long.groupBy("column").agg(*[F.expr(e).alias(s) for s, e in {**base, **stats}.items()])


def _scan(df: DataFrame, ks: Mapping[str, str]) -> list[dict]:
    """``column, n, n_seen`` and the moments or flags of every column but the texts, whose wording the frequencies have."""
    types = dict(df.dtypes)
    plans: dict[tuple, list[str]] = {}
    for c, k in ks.items():
        if k != "string":
            plans.setdefault(("number",) if k in ("int", "float") else (k, types[c] if k == "datetime" else ""), []).append(c)
    wanted = {"number": ("double", _MOMENTS), "bool": (None, {"true_ratio": "avg(cast(value as double))"})}

    def one(kind: str, columns: list[str]) -> list[dict]:
        cast, stats = wanted.get(kind, (None, _MOMENTS_IN_TIME))
        if kind == "datetime" and types[columns[0]] == "date":
            stats = {**stats, "has_time": "false"}
        return [r.asDict() for r in _long_stats(df, columns, cast, stats).collect()]

    return [r for rows in together(*[lambda k=k, c=c: one(k[0], c) for k, c in plans.items()]) for r in rows]


def _facts(ks: Mapping[str, str], scanned: Iterable[dict]) -> dict[str, dict]:
    found = {r["column"]: r for r in scanned}
    facts: dict[str, dict] = {}
    for c, k in ks.items():
        # an empty table yields no group at all
        f = {"kind": k, **found.get(c, {"column": c, "n": 0, "n_seen": 0, "zero_ratio": 0.0, "min": None, "skew_pop": None, "whole": True})}
        seen = f.pop("n_seen")
        f["n_null"] = f["n"] - seen
        f["missing_ratio"] = f["n_null"] / f["n"] if f["n"] else None
        if k in ("int", "float"):
            f["skewness"] = _corrected_skewness(f.pop("skew_pop"), seen)
            f["has_negative"] = f["min"] is not None and f["min"] < 0
            f["true_ratio"] = 1.0 - f["zero_ratio"] if seen else None
            f["is_integer"] = f.pop("whole") or k == "int"
        for end in ("min_date", "max_date"):
            if f.get(end) is not None:
                f[end] = f[end][:10]
        facts[c] = f
    return facts


def _corrected_skewness(population: float | None, n: int) -> float | None:
    if n < 3:
        return None
    return (population or 0.0) * (n * (n - 1)) ** 0.5 / (n - 2)


# ---- scan 2: frequencies ------------------------------------------------------------


def _as_text(name: str, kind: str) -> Column:
    c = ident(name)
    if kind == "float":
        c = c.cast("double") + F.lit(0.0)  # -0.0 and 0.0 are one value
    text = c.cast("string")
    return F.when(F.length(text) > LONG_VALUE, F.md5(text)).otherwise(text) if kind == "string" else text


def value_frequencies(df: DataFrame, columns: Mapping[str, str], digest: bool = True) -> DataFrame:
    """``column, value, cnt``: one shuffle, combined map-side, hot values included."""
    cols = [(_as_text(c, k) if digest else ident(c).cast("string")).alias(c) for c, k in columns.items()]
    long = df.select(*cols).unpivot([], [f"`{c}`" for c in columns], "column", "value")
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))


def _typed_groups(df: DataFrame, columns: Mapping[str, str]) -> list[tuple[str, list[Column], list[str]]]:
    """Columns grouped by one common native type, so that counting needs no text conversion."""
    types = dict(df.dtypes)
    groups: dict[str, list[str]] = {}
    for c, k in columns.items():
        native = {"int": "bigint", "float": "double", "bool": "boolean", "string": "string"}.get(k, types[c])
        groups.setdefault(native, []).append(c)
    out = []
    for native, names in groups.items():
        cols = []
        for c in names:
            x = _as_text(c, "string") if native == "string" else ident(c).cast(native)
            cols.append((x + F.lit(0.0) if native == "double" else x).alias(c))
        out.append((native, cols, names))
    return out


def frequency_rollup(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Distinct counts and dominance per column.

    One unpivot and one count per native type; each reads only its own columns, so all
    types together are still a single pass over the table's bytes.
    """
    out = None
    for _native, cols, names in _typed_groups(df, columns):
        long = df.select(*cols).unpivot([], [f"`{c}`" for c in names], "column", "value")
        rolled = _rolled(long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt")))
        out = rolled if out is None else out.unionAll(rolled)
    return out


def _rolled(counts: DataFrame, more: Mapping[str, Column] | None = None) -> DataFrame:
    seen = F.col("value").isNotNull()
    cnt = F.when(seen, F.col("cnt"))
    return counts.groupBy("column").agg(
        F.count_if(seen).alias("cardinality"),
        F.count(F.lit(1)).alias("cardinality_with_null"),
        safe_div(F.max(cnt).cast("double"), F.sum(cnt)).alias("most_frequent_ratio"),
        F.coalesce(F.try_divide(F.min(cnt).cast("double"), F.sum(cnt)) < 0.01, F.lit(False)).alias("has_rare"),
        *[e.alias(c) for c, e in (more or {}).items()],
    )


def worded_rollup(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """:func:`frequency_rollup` of texts with ``n, n_seen, true_ratio, avg_tokens, all_datetime``.

    What is asked of a text is worked out once per value and task, not per row: a pattern or a parse costs more than a count.
    """
    long = df.select(*[ident(c).cast("string").alias(c) for c in columns]).unpivot([], [f"`{c}`" for c in columns], "column", "text")
    asked = [F.first(F.expr(e)).alias(s) for s, e in _WORDING.items()]
    counts = long.groupBy("column", _as_text("text", "string").alias("value")).agg(F.count(F.lit(1)).alias("cnt"), *asked)
    n, seen = F.sum("cnt"), F.sum(F.when(F.col("value").isNotNull(), F.col("cnt")))
    return _rolled(
        counts,
        {
            "n": n,
            "n_seen": F.coalesce(seen, F.lit(0)),
            "true_ratio": F.try_divide(F.sum(F.when(F.col("is_true"), F.col("cnt")).otherwise(0)).cast("double"), seen),
            "avg_tokens": F.try_divide(F.sum(F.col("tokens") * F.col("cnt")).cast("double"), seen),
            "all_datetime": F.coalesce(F.bool_and("is_datetime"), F.lit(False)),
        },
    )


def approximate_cardinality(df: DataFrame, columns: Iterable[str], rsd: float = 0.02) -> DataFrame:
    """Sketch-based alternative to the exact distinct counts: no shuffle of values."""
    return per_column(df, {c: {"cardinality": F.approx_count_distinct(ident(c), rsd)} for c in columns})


# ---- scans 3 and 4: quartiles, fences, gaps -----------------------------------------


def quartiles(
    df: DataFrame, columns: Iterable[str], rows: int | None = None, distinct: Mapping[str, int] | None = None
) -> dict[str, list[float | None]]:
    return exact_quantiles(df, {c: ident(c) for c in columns}, [0.25, 0.5, 0.75], rows, distinct=distinct)


def outlier_expr(c: Column, q25: float | None, q75: float | None) -> Column:
    """Share of non-null values strictly outside the 1.5 IQR fences; 0 when the IQR is 0."""
    if q25 is None or q75 is None or q75 == q25:
        return F.lit(0.0)
    iqr = q75 - q25
    outside = (c < F.lit(q25 - 1.5 * iqr)) | (c > F.lit(q75 + 1.5 * iqr))
    return F.coalesce(F.avg(outside.cast("double")), F.lit(0.0))


def uniform_gap_expr(c: Column, low: float | None, high: float | None, cardinality: int) -> Column:
    """True when the distinct values are evenly spaced.

    With ``cardinality`` distinct values between ``low`` and ``high``, even spacing means
    every value is a whole number of steps above ``low``: no sort and no distinct needed.
    """
    if low is None or high is None or cardinality < 2 or high == low:
        return F.lit(False)
    steps = (c.cast("double") - F.lit(low)) * F.lit(cardinality - 1) / F.lit(high - low)
    return F.coalesce(F.bool_and(F.abs(steps - F.round(steps)) < 1e-9), F.lit(False))


def outlier_ratios(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    q = quartiles(df, columns)
    return per_column(df, {c: {"outlier_ratio": outlier_expr(ident(c), q[c][0], q[c][2])} for c in columns})


def uniform_gaps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    ks = kinds(df, columns)
    card = {r["column"]: r["cardinality"] for r in frequency_rollup(df, ks).collect()}
    rng = df.agg(*[f(ident(c)).cast("double") for c in ks for f in (F.min, F.max)]).first()
    ends = {c: (rng[2 * i], rng[2 * i + 1]) for i, c in enumerate(ks)}
    return per_column(df, {c: {"uniform_gaps": uniform_gap_expr(ident(c), *ends[c], card[c])} for c in ks})


# ---- scan 5: text -------------------------------------------------------------------


def vocabulary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, vocab_size``: distinct lower-case tokens."""
    long = df.select(*[ident(c).alias(c) for c in columns]).unpivot([], [f"`{c}`" for c in columns], "column", "text")
    tokens = long.select("column", F.explode(token_array(F.lower("text"))).alias("token"))
    return tokens.groupBy("column", "token").agg(F.count(F.lit(1))).groupBy("column").agg(F.count(F.lit(1)).alias("vocab_size"))


def text_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    stats = per_column(df, {c: {"avg_tokens": mean_tokens(ident(c))} for c in columns})
    return (
        stats.join(F.broadcast(vocabulary(df, columns)), "column", "left")
        .select(
            "column",
            "avg_tokens",
            F.coalesce("vocab_size", F.lit(0)).cast("bigint").alias("vocab_size"),
            (F.col("avg_tokens") >= rules.SEMANTIC_TOKENS).alias("is_semantic"),
        )
    )


def datetime_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    aware = {f.name: isinstance(f.dataType, T.TimestampType) for f in df.schema.fields}
    return per_column(
        df,
        {
            c: {
                "min_date": F.min(F.to_date(ident(c))).cast("string"),
                "max_date": F.max(F.to_date(ident(c))).cast("string"),
                "granularity": F.when(has_time(ident(c)), "datetime").otherwise("date"),
                "has_timezone": F.lit(aware[c]),
            }
            for c in columns
        },
    )


# ---- ordinal wording ----------------------------------------------------------------

ORDER_ARRAY_LIMIT = 1000


def ordinal_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, value, rank``: distinct lower/trimmed values that contain an ordinal word."""
    long = df.select(*[trimmed_lower(ident(c).cast("string")).alias(c) for c in columns]).unpivot(
        [], [f"`{c}`" for c in columns], "column", "value"
    )
    ranked = long.withColumn("rank", rules.ordinal_rank(F.col("value"))).where(F.col("rank").isNotNull())
    return ranked.groupBy("column", "value").agg(F.first("rank").alias("rank"))


def ordinal_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, n_matches, category_order``; the order is null below two matches.

    Ties of rank sort by value.  The array is only built for at most ORDER_ARRAY_LIMIT
    matching values; :func:`ordinal_codes` has the positions of any number of them as a table.
    """
    values = ordinal_values(df, columns)
    counts = values.groupBy("column").agg(F.count(F.lit(1)).alias("n_matches"))
    fits = counts.where(F.col("n_matches").between(2, ORDER_ARRAY_LIMIT))
    arrays = (
        values.join(F.broadcast(fits.select("column")), "column", "left_semi")
        .groupBy("column")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "value"))), lambda s: s["value"]).alias("category_order"))
    )
    return counts.join(F.broadcast(arrays), "column", "left")


def ordinal_codes(df: DataFrame, column: str) -> DataFrame:
    """``value, code, n``: position of every ordinal wording in the order of :func:`ordinal_order`, as a table."""
    order = F.struct("rank", "value").alias("_order")
    return dense_codes(ordinal_values(df, [column]).select(order), "_order").select("_order.value", "code", "n")


def ordinal_positions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, value, position``: every ordinal wording of the columns with at least two, in the order of
    :func:`ordinal_order`, as rows, so that any number of wordings is whole."""
    order = F.struct("column", "rank", "value").alias("_order")
    codes = dense_codes(ordinal_values(df, columns).select(order), "_order").select("_order.column", "_order.value", "code")
    first = codes.groupBy("column").agg(F.min("code").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n >= 2")
    return codes.join(F.broadcast(first), "column").select("column", "value", (F.col("code") - F.col("_first")).cast("bigint").alias("position"))


# ---- the whole profile --------------------------------------------------------------

PROFILE_SCHEMA = T.StructType(
    [
        T.StructField("column", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("dtype", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("n_null", T.LongType()),
        T.StructField("missing_ratio", T.DoubleType()),
        T.StructField("cardinality", T.LongType()),
        T.StructField("cardinality_with_null", T.LongType()),
        T.StructField("skewness", T.DoubleType()),
        T.StructField("zero_ratio", T.DoubleType()),
        T.StructField("has_negative", T.BooleanType()),
        T.StructField("outlier_ratio", T.DoubleType()),
        T.StructField("variance", T.DoubleType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("q25", T.DoubleType()),
        T.StructField("q50", T.DoubleType()),
        T.StructField("q75", T.DoubleType()),
        T.StructField("min", T.DoubleType()),
        T.StructField("max", T.DoubleType()),
        T.StructField("is_integer", T.BooleanType()),
        T.StructField("uniform_gaps", T.BooleanType()),
        T.StructField("most_frequent_ratio", T.DoubleType()),
        T.StructField("has_rare", T.BooleanType()),
        T.StructField("true_ratio", T.DoubleType()),
        T.StructField("min_date", T.StringType()),
        T.StructField("max_date", T.StringType()),
        T.StructField("has_time", T.BooleanType()),
        T.StructField("has_timezone", T.BooleanType()),
        T.StructField("avg_tokens", T.DoubleType()),
        T.StructField("vocab_size", T.LongType()),
        T.StructField("all_datetime", T.BooleanType()),
        T.StructField("value_pair", T.StringType()),
        T.StructField("n_ordinal_matches", T.LongType()),
        T.StructField("category_order", T.ArrayType(T.StringType())),
        T.StructField("drop_reason", T.StringType()),
    ]
)


def column_facts(
    df: DataFrame, columns: Iterable[str] | None = None, exempt: Sequence[str] = ()
) -> list[dict]:
    """All facts per column as plain records (driver size: O(columns)).

    ``exempt`` names columns that are never dropped as redundant, such as text columns
    the caller wants profiled even though nearly every value is unique.
    """
    df = normalise_nan(df)
    ks = kinds(df, columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    texts = [c for c, k in ks.items() if k == "string"]
    others = {c: k for c, k in ks.items() if k != "string"}
    scanned, counted, worded = together(
        lambda: _scan(df, others),
        lambda: frequency_rollup(df, others).collect() if others else [],
        lambda: worded_rollup(df, texts).collect() if texts else [],
    )
    worded = [r.asDict() for r in worded]
    facts = _facts(ks, [*scanned, *worded])
    for c, f in facts.items():
        f["dtype"] = types[c].simpleString()
        f["has_timezone"] = isinstance(types[c], T.TimestampType) if ks[c] == "datetime" else None
    for r in counted:
        facts[r["column"]].update(r.asDict())
    for c, f in facts.items():
        f.setdefault("cardinality", 0)
        f.setdefault("cardinality_with_null", 1 if f["n"] else 0)
        f["drop_reason"] = None if c in exempt else rules.drop_reason(f)
    live = {c: f for c, f in facts.items() if f["drop_reason"] is None}
    numeric = [c for c in live if ks[c] in ("int", "float")]
    rows = next(iter(facts.values()))["n"] if facts else 0
    strings = [c for c in live if ks[c] == "string"]
    pairs = [c for c in strings if live[c]["cardinality"] == 2]
    wordy = [c for c in strings if c not in pairs and (live[c]["avg_tokens"] or 0) >= rules.SEMANTIC_TOKENS]
    short = [c for c in strings if c not in wordy]

    def numbers():
        q = quartiles(df, numeric, rows, {c: live[c]["cardinality"] for c in numeric})
        stats = {}
        for c in numeric:
            live[c].update(zip(("q25", "q50", "q75"), q[c]))
            gaps = F.lit(False)
            if live[c]["is_integer"] and live[c]["cardinality"] <= rules.ORDINAL_CARDINALITY:
                gaps = uniform_gap_expr(ident(c), live[c]["min"], live[c]["max"], live[c]["cardinality"])
            stats[c] = {"outlier_ratio": outlier_expr(ident(c), q[c][0], q[c][2]), "uniform_gaps": gaps}
        return per_column(df, stats).collect()

    def value_pairs():
        row = df.agg(*[F.array_join(F.array_sort(F.collect_set(trimmed_lower(ident(c)))), "|") for c in pairs]).first()
        return [{"column": c, "value_pair": row[i]} for i, c in enumerate(pairs)]

    def orders():
        return [
            {"column": r["column"], "n_ordinal_matches": r["n_matches"], "category_order": r["category_order"]}
            for r in ordinal_order(df, short).collect()
        ]

    jobs = [
        job
        for job, wanted in (
            (numbers, numeric), (value_pairs, pairs), (lambda: vocabulary(df, wordy).collect(), wordy), (orders, short),
        )
        if wanted
    ]
    for rows_found in together(*jobs):
        for r in rows_found:
            facts[r["column"]].update(r if isinstance(r, dict) else r.asDict())
    return list(facts.values())


def redundancy_facts(df: DataFrame, columns: Iterable[str] | None = None) -> list[dict]:
    """Null and distinct counts only: enough to decide which columns are redundant."""
    ks = kinds(df, columns)
    row = df.agg(F.count(F.lit(1)), *[F.count(ident(c)) for c in ks]).first()
    n = row[0]
    facts = {
        c: {"column": c, "kind": k, "n": n, "n_null": n - row[i + 1], "missing_ratio": (n - row[i + 1]) / n if n else None}
        for i, (c, k) in enumerate(ks.items())
    }
    for r in frequency_rollup(df, ks).collect():
        facts[r["column"]].update(r.asDict())
    for f in facts.values():
        f.setdefault("cardinality", 0)
        f.setdefault("cardinality_with_null", 0)
        f["drop_reason"] = rules.drop_reason(f)
    return list(facts.values())


def facts_frame(df: DataFrame, facts: Sequence[Mapping]) -> DataFrame:
    rows = [tuple(f.get(field.name) for field in PROFILE_SCHEMA.fields) for f in facts]
    return df.sparkSession.createDataFrame(rows, PROFILE_SCHEMA)


def profile(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    mode: str = "effective",
    exempt: Sequence[str] = (),
) -> DataFrame:
    """The full profile: facts, semantic type, subtype and every preparation decision."""
    return rules.decide(facts_frame(df, column_facts(df, columns, exempt)), mode)


def profile_summary(profiled: DataFrame) -> DataFrame:
    """Preparation decisions of the numeric columns only."""
    return profiled.where((F.col("feature_type") == "numerical") & F.col("drop_reason").isNull()).select(
        "column", "subtype", "transformation", "scaler", "imputer", "is_skewed", "has_outliers", "needs_imputation"
    )
