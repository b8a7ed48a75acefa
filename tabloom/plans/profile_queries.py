"""Sources, splits, column filters, profiling and typing rules as named queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.scalars import at_least
from tabloom.operators import columns as col_ops
from tabloom.operators import profile as prof
from tabloom.operators import rules
from tabloom.plans.frames import (
    DOCS_SQL,
    EVENTS_SQL,
    LINES_SQL,
    ORDERS_SQL,
    docs_frame,
    events_frame,
    lines_frame,
    orders_frame,
    table,
)
from tabloom.plans.registry import query
from tabloom.plans.sqltext import (
    hash_sql,
    ordinal_values_sql,
    per_column_sql,
    sig,
    tokens_sql,
    typed,
    with_frame,
)
from tabloom.session import keep, shared_folder, together
from tabloom.sources import tables as src


def profiled(frame: Callable[[SparkSession, str], DataFrame], spark: SparkSession, sf: str, columns: Sequence[str] | None = None, mode: str = "effective"):
    """The profile of a frame.  A profile reads its frame in many passes, so a frame that joins large tables is joined once."""
    df = frame(spark, sf)
    joined = keep(df.select(*columns) if columns else df) if frame is orders_frame else None
    if joined is None:
        return prof.profile(df, columns, mode)
    joined.count()
    out = prof.profile(joined, columns, mode)
    joined.unpersist()
    return out


ORDER_KINDS = {
    "o_orderkey": "int", "o_custkey": "int", "o_orderstatus": "string", "o_orderdate": "datetime",
    "o_orderpriority": "string", "price_known": "float", "price_urgent": "float", "final_flag": "int",
    "is_big": "bool", "order_month": "int", "priority_shift": "int", "record_kind": "string", "c_name": "string",
    "c_acctbal": "float", "c_mktsegment": "string", "c_nationkey": "int",
}
LINE_NUMBERS = ("l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
ORDER_NUMBERS = ("price_known", "c_acctbal", "c_nationkey", "priority_shift")


def sig_col(x: Column) -> Column:
    """Nine significant digits, the twin of :func:`sig`."""
    p = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(x))))
    return F.when(x == 0, 0.0).otherwise(F.round(x / F.nullif(p, F.lit(0.0)), 8) * p)


# ---- sources and splits -----------------------------------------------------------------


def _csv_copy(df: DataFrame) -> str:
    """Write a table as CSV into a fresh folder (the session's scratch root where one is set)."""
    path = f"{shared_folder(df.sparkSession)}/csv-{uuid.uuid4().hex}"
    df.write.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return path


@query("src_csv", sql="SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus <> 'P' THEN round(o_totalprice, 2) END AS price, o_orderpriority FROM orders")
def src_csv(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.when(F.col("o_orderstatus") != "P", F.round("o_totalprice", 2)).alias("price"), "o_orderpriority",
    )
    return src.read_csv(spark, _csv_copy(o))


@query("src_csv_text", sql="SELECT doc_id, nullif(text, '') AS text, lang FROM documents")
def src_csv_text(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with line breaks and quotes survive the way through CSV."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return src.read_csv(spark, _csv_copy(docs), "doc_id bigint, text string, lang string")


@query("src_validate", sql="SELECT count(*) AS n, 'l_returnflag' AS target FROM lineitem")
def src_validate(spark: SparkSession, sf: str) -> DataFrame:
    ok = src.validate(table(spark, sf, "lineitem"), "l_returnflag")
    return ok.agg(F.count(F.lit(1)).alias("n"), F.lit("l_returnflag").alias("target"))


_COUNTED = ("region", "nation", "supplier", "customer", "part", "orders", "lineitem", "documents")


@query(
    "split_ratio",
    sql=" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n, CASE WHEN count(*) > 1000 THEN 0.2 ELSE 0.1 END::DOUBLE AS test_ratio FROM {t}"
        for t in _COUNTED
    ),
)
def split_ratio(spark: SparkSession, sf: str) -> DataFrame:
    parts = [table(spark, sf, t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n")) for t in _COUNTED]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out.withColumn("test_ratio", src.test_ratio(F.col("n")).cast("double"))


@query(
    "split_train_test",
    sql=f"""SELECT o_orderkey, CASE WHEN {hash_sql('o_orderkey')} < CAST(floor((SELECT CASE WHEN count(*) > 1000 THEN 0.2 ELSE 0.1 END
    FROM orders)::DOUBLE * 4503599627370496) AS BIGINT) THEN 'test' ELSE 'train' END AS split FROM orders""",
)
def split_train_test(spark: SparkSession, sf: str) -> DataFrame:
    return src.with_split(table(spark, sf, "orders"), ["o_orderkey"]).select("o_orderkey", "split")


@query(
    "load_bundle",
    sql=f"""SELECT o_orderkey, o_orderstatus AS target, CASE WHEN {hash_sql('o_orderkey')} < CAST(floor((SELECT CASE WHEN count(*) > 1000
    THEN 0.2 ELSE 0.1 END FROM orders)::DOUBLE * 4503599627370496) AS BIGINT) THEN 'test' ELSE 'train' END AS split FROM orders""",
)
def load_bundle(spark: SparkSession, sf: str) -> DataFrame:
    path = _csv_copy(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"))
    b = src.load_bundle(spark, path, "o_orderstatus", ["o_orderkey"], "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderstatus string")
    return b.data.select("o_orderkey", F.col(b.target).alias("target"), "split")


@query(
    "split_stratified",
    sql=f"""SELECT o_orderkey, o_orderstatus, CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY {hash_sql('o_orderkey')}, o_orderkey)
    <= floor(0.2 * count(*) OVER (PARTITION BY o_orderstatus) + 1e-9) THEN 'test' ELSE 'train' END AS split FROM orders""",
)
def split_stratified(spark: SparkSession, sf: str) -> DataFrame:
    return src.with_stratified_split(table(spark, sf, "orders"), "o_orderstatus", ["o_orderkey"]).select(
        "o_orderkey", "o_orderstatus", "split"
    )


def _fold_sql(partition: str, k: int) -> str:
    return " + ".join(f"CASE WHEN rn > ({i} * cnt) // {k} THEN 1 ELSE 0 END" for i in range(1, k))


@query(
    "folds_kfold",
    sql=f"""WITH r AS (SELECT o_orderkey, o_orderstatus,
      row_number() OVER (PARTITION BY o_orderstatus ORDER BY {hash_sql('o_orderkey')}) AS rn, count(*) OVER (PARTITION BY o_orderstatus) AS cnt,
      row_number() OVER (ORDER BY {hash_sql('o_orderkey')}) AS rn3, count(*) OVER () AS cnt3 FROM orders)
    SELECT o_orderkey, o_orderstatus, CAST({_fold_sql('', 5)} AS INTEGER) AS fold5,
      CAST({_fold_sql('', 3).replace('rn', 'rn3').replace('cnt', 'cnt3')} AS INTEGER) AS fold3 FROM r""",
)
def folds_kfold(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    strat = src.with_folds(o, 5, ["o_orderkey"], "o_orderstatus").withColumnRenamed("fold", "fold5")
    return src.with_folds(strat, 3, ["o_orderkey"]).select("o_orderkey", "o_orderstatus", "fold5", F.col("fold").alias("fold3"))


# ---- column filters ----------------------------------------------------------------------

_ORDERS_D = typed(ORDERS_SQL, ORDER_KINDS)


def _drop_sql(where: str) -> str:
    return _ORDERS_D + (
        'SELECT "column", drop_reason AS reason, greatest(cardinality_with_null, 1) AS cardinality, '
        f"cardinality_with_null = n AS is_primary_key FROM d WHERE {where}"
    )


@query("drop_high_null", sql=_drop_sql("drop_reason = 'high_null'"))
def drop_high_null(spark: SparkSession, sf: str) -> DataFrame:
    return col_ops.redundant_columns(orders_frame(spark, sf), reason="high_null")


@query("drop_constant", sql=_drop_sql("drop_reason = 'constant'"))
def drop_constant(spark: SparkSession, sf: str) -> DataFrame:
    return col_ops.redundant_columns(orders_frame(spark, sf), reason="constant")


@query("drop_id_like", sql=_drop_sql("drop_reason = 'identifier'"))
def drop_id_like(spark: SparkSession, sf: str) -> DataFrame:
    return col_ops.redundant_columns(orders_frame(spark, sf), reason="identifier")


@query("identifier_report", sql=_drop_sql("drop_reason IS NOT NULL"))
def identifier_report(spark: SparkSession, sf: str) -> DataFrame:
    return col_ops.redundant_columns(orders_frame(spark, sf))


_KEPT = [c for c in ORDER_KINDS if c not in ("o_orderkey", "price_urgent", "record_kind")]


@query(
    "drop_redundant",
    sql=with_frame(ORDERS_SQL, f"SELECT {', '.join(c if c != 'price_known' else 'round(price_known, 2) AS price_known' for c in _KEPT)} FROM t"),
)
def drop_redundant(spark: SparkSession, sf: str) -> DataFrame:
    kept, _report = col_ops.drop_redundant(orders_frame(spark, sf))
    return kept.withColumn("price_known", F.round("price_known", 2))


@query(
    "route_features",
    sql=typed(ORDERS_SQL, ORDER_KINDS)
    + """, o AS (SELECT *, """
    + "CASE \"column\" " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(ORDER_KINDS)) + """ END AS p FROM d)
    SELECT feature_type, count(*) AS n_columns, string_agg("column", ',' ORDER BY p) AS columns FROM o WHERE drop_reason IS NULL GROUP BY feature_type""",
)
def route_features(spark: SparkSession, sf: str) -> DataFrame:
    return col_ops.route(profiled(orders_frame, spark, sf))


@query("project_selected", sql="SELECT l_orderkey, l_linenumber, l_quantity AS f0, l_tax AS f1 FROM lineitem")
def project_selected(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    df = table(spark, sf, "lineitem")
    v = VectorAssembler(inputCols=["l_quantity", "l_extendedprice", "l_discount", "l_tax"], outputCol="features").transform(df)
    out = col_ops.project_vector(v, [0, 3]).withColumn("a", vector_to_array("selected"))
    return out.select("l_orderkey", "l_linenumber", F.col("a")[0].alias("f0"), F.col("a")[1].alias("f1"))


@query("remainder_drop", sql="SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, l_discount FROM lineitem")
def remainder_drop(spark: SparkSession, sf: str) -> DataFrame:
    return col_ops.project(table(spark, sf, "lineitem"), ["l_quantity", "l_discount"], keep=["l_orderkey", "l_linenumber", "l_returnflag"])


_PREDICATES = {
    "pred_is_high_missing": ("is_high_missing", "coalesce(missing_ratio > 0.6, false)"),
    "pred_needs_imputation": ("needs_imputation", "coalesce(missing_ratio > 0, false)"),
    "pred_is_skewed": ("is_skewed", "coalesce(abs(skewness) > 1.0, false)"),
    "pred_near_zero_variance": ("is_near_zero_variance", "coalesce(variance < 1e-6, false)"),
    "pred_has_outliers": ("has_outliers", "coalesce(outlier_ratio > 0.05, false)"),
    "pred_high_cardinality": ("is_high_cardinality", "coalesce(cardinality > 20, false)"),
    "pred_quasi_constant": ("is_quasi_constant", "coalesce(most_frequent_ratio > 0.95, false)"),
    "pred_bool_imbalanced": ("is_imbalanced", "coalesce(true_ratio < 0.05 OR true_ratio > 0.95, false)"),
}
_DOC_KINDS = {"doc_id": "int", "lang": "string", "source": "string", "n_chars": "int", "quality": "int", "toxic": "int"}
_DOCS_D = typed(DOCS_SQL, _DOC_KINDS)
_PRED_ORDER_COLUMNS = [c for c in ORDER_KINDS if c not in ("o_orderkey", "price_urgent", "record_kind", "o_orderdate")]


def _register_predicate(name: str, flag: str, sql: str) -> None:
    docs_wanted = "', '".join(c for c in _DOC_KINDS if c != "doc_id")
    body = f"SELECT \"column\", {sql} AS {flag} FROM d WHERE \"column\" IN ('{docs_wanted}')"
    orders_wanted = "', '".join(_PRED_ORDER_COLUMNS)
    order_body = f"SELECT \"column\", {sql} AS {flag} FROM d WHERE \"column\" IN ('{orders_wanted}')"
    whole = f"SELECT * FROM ({_DOCS_D} {body}) UNION ALL SELECT * FROM ({_ORDERS_D} {order_body})"

    @query(name, sql=whole)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        docs = prof.profile(docs_frame(spark, sf), [c for c in _DOC_KINDS if c != "doc_id"])
        orders = profiled(orders_frame, spark, sf, _PRED_ORDER_COLUMNS)
        return docs.select("column", flag).unionAll(orders.select("column", flag))


for _name, (_flag, _sql) in _PREDICATES.items():
    _register_predicate(_name, _flag, _sql)


# ---- aggregations -------------------------------------------------------------------------


def _stat_query(name: str, stat: str, frame, frame_sql: str, columns, spark_expr, sql_expr, rounded: bool | str = True):
    def wrap_sql(c: str) -> str:
        e = sql_expr(c)
        return sig(e) if rounded == "sig" else f"round({e}, 8)" if rounded else e

    def wrap(c: Column) -> Column:
        e = spark_expr(c)
        return sig_col(e) if rounded == "sig" else F.round(e, 8) if rounded else e

    @query(name, sql=per_column_sql(frame_sql, {c: {stat: wrap_sql(c)} for c in columns}))
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return prof.per_column(frame(spark, sf), {c: {stat: wrap(prof.ident(c))} for c in columns})


_stat_query(
    "prof_missing", "missing_ratio", docs_frame, DOCS_SQL, list(_DOC_KINDS), prof.missing_ratio,
    lambda c: f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)",
)
_stat_query(
    "prof_skewness", "skewness", lines_frame, LINES_SQL, LINE_NUMBERS, prof.skewness, lambda c: f"skewness({c}::DOUBLE)"
)
_stat_query(
    "prof_zero_ratio", "zero_ratio", lines_frame, LINES_SQL, LINE_NUMBERS, prof.zero_ratio,
    lambda c: f"avg(CASE WHEN {c} = 0 THEN 1.0 ELSE 0.0 END)",
)
_stat_query(
    "prof_has_negative", "has_negative", orders_frame, ORDERS_SQL, ORDER_NUMBERS, prof.has_negative,
    lambda c: f"coalesce(bool_or({c} < 0), false)", rounded=False,
)
_stat_query(
    "prof_variance", "variance", lines_frame, LINES_SQL, LINE_NUMBERS, prof.variance, lambda c: f"var_samp({c}::DOUBLE)", "sig"
)
_stat_query(
    "prof_is_integer", "is_integer", orders_frame, ORDERS_SQL, ORDER_NUMBERS, prof.all_whole,
    lambda c: f"coalesce(bool_and({c} = floor({c}::DOUBLE)), true)", rounded=False,
)

_CARD_COLUMNS = [c for c in ORDER_KINDS]


@query(
    "prof_cardinality",
    sql=per_column_sql(
        ORDERS_SQL,
        {
            c: {
                "cardinality": f"count(DISTINCT {c})",
                "cardinality_with_null": f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)",
            }
            for c in _CARD_COLUMNS
        },
    ),
)
def prof_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    df = orders_frame(spark, sf)
    return prof.frequency_rollup(df, prof.kinds(df, _CARD_COLUMNS)).select("column", "cardinality", "cardinality_with_null")


@query(
    "prof_outlier_ratio",
    sql=with_frame(
        LINES_SQL,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", round(CASE WHEN max(q3) = max(q1) THEN 0.0 ELSE avg(CASE WHEN {c} < q1 - 1.5 * (q3 - q1)
            OR {c} > q3 + 1.5 * (q3 - q1) THEN 1.0 ELSE 0.0 END) END, 8) AS outlier_ratio
            FROM t, (SELECT quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM t)"""
            for c in LINE_NUMBERS
        ),
    ),
)
def prof_outlier_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return prof.outlier_ratios(lines_frame(spark, sf), LINE_NUMBERS).withColumn("outlier_ratio", F.round("outlier_ratio", 8))


@query(
    "prof_quantiles",
    sql=per_column_sql(
        LINES_SQL,
        {c: {n: f"round(quantile_cont({c}::DOUBLE, {p}), 6)" for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))} for c in LINE_NUMBERS},
    ),
)
def prof_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    q = prof.quartiles(lines_frame(spark, sf), LINE_NUMBERS)
    rows = [(c, *v) for c, v in q.items()]
    out = spark.createDataFrame(rows, "column string, q25 double, q50 double, q75 double")
    return out.select("column", *[F.round(x, 6).alias(x) for x in ("q25", "q50", "q75")])


@query(
    "prof_value_counts",
    sql=with_frame(
        ORDERS_SQL,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS cnt, round(count(*) / (SELECT count({c}) FROM t)::DOUBLE, 8) AS share
            FROM t WHERE {c} IS NOT NULL GROUP BY {c}"""
            for c in ("o_orderpriority", "c_mktsegment", "c_nationkey")
        ),
    ),
)
def prof_value_counts(spark: SparkSession, sf: str) -> DataFrame:
    df = orders_frame(spark, sf)
    freq = prof.value_frequencies(df, prof.kinds(df, ["o_orderpriority", "c_mktsegment", "c_nationkey"]), digest=False)
    seen = freq.where(F.col("value").isNotNull())
    totals = seen.groupBy("column").agg(F.sum("cnt").alias("total"))
    return seen.join(F.broadcast(totals), "column").select(
        "column", "value", "cnt", F.round(F.col("cnt") / F.col("total"), 8).alias("share")
    )


_FREQ_COLUMNS = ("o_orderstatus", "o_orderpriority", "c_name", "c_mktsegment", "record_kind")


def _freq_sql(expr: str, name: str) -> str:
    return with_frame(
        ORDERS_SQL,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", {expr} AS {name} FROM (SELECT count(*)::DOUBLE AS k FROM t WHERE {c} IS NOT NULL GROUP BY {c})"""
            for c in _FREQ_COLUMNS
        ),
    )


@query("prof_most_frequent", sql=_freq_sql("round(max(k) / sum(k), 8)", "most_frequent_ratio"))
def prof_most_frequent(spark: SparkSession, sf: str) -> DataFrame:
    df = orders_frame(spark, sf)
    r = prof.frequency_rollup(df, prof.kinds(df, _FREQ_COLUMNS))
    return r.select("column", F.round("most_frequent_ratio", 8).alias("most_frequent_ratio"))


@query("prof_rare", sql=_freq_sql("min(k) / sum(k) < 0.01", "has_rare"))
def prof_rare(spark: SparkSession, sf: str) -> DataFrame:
    df = orders_frame(spark, sf)
    return prof.frequency_rollup(df, prof.kinds(df, _FREQ_COLUMNS)).select("column", "has_rare")


@query(
    "prof_true_ratio",
    sql=with_frame(
        ORDERS_SQL,
        """SELECT 'is_big' AS "column", round(avg(is_big::INT), 8) AS true_ratio FROM t
        UNION ALL SELECT 'final_flag', round(avg(CASE WHEN final_flag <> 0 THEN 1.0 WHEN final_flag = 0 THEN 0.0 END), 8) FROM t
        UNION ALL SELECT 'o_orderstatus', round(avg(CASE WHEN lower(trim(o_orderstatus)) IN ('true','yes','si','1','y') THEN 1.0 ELSE 0.0 END), 8) FROM t""",
    ),
)
def prof_true_ratio(spark: SparkSession, sf: str) -> DataFrame:
    df = orders_frame(spark, sf)
    ks = {"is_big": "bool", "final_flag": "int", "o_orderstatus": "string"}
    return prof.per_column(df, {c: {"true_ratio": F.round(prof.true_ratio(prof.ident(c), k), 8)} for c, k in ks.items()})


def _dt_sql(c: str, t: str) -> str:
    return f"""SELECT '{c}' AS "column", CAST(CAST(min({c}) AS DATE) AS VARCHAR) AS min_date, CAST(CAST(max({c}) AS DATE) AS VARCHAR) AS max_date,
    CASE WHEN bool_or(hour({c}) <> 0 OR minute({c}) <> 0) THEN 'datetime' ELSE 'date' END AS granularity, false AS has_timezone FROM {t}"""


@query("prof_datetime", sql=_dt_sql("l_shipdate", "lineitem") + " UNION ALL " + _dt_sql("ts", "events"))
def prof_datetime(spark: SparkSession, sf: str) -> DataFrame:
    return prof.datetime_profile(table(spark, sf, "lineitem"), ["l_shipdate"]).unionAll(
        prof.datetime_profile(table(spark, sf, "events"), ["ts"])
    )


def _text_sql(t: str, c: str, label: str) -> str:
    return f"""SELECT '{label}' AS source, round(avg(len({tokens_sql(c)})), 8) AS avg_tokens,
    (SELECT count(DISTINCT w) FROM (SELECT unnest({tokens_sql(f'lower({c})')}) AS w FROM {t})) AS vocab_size,
    avg(len({tokens_sql(c)})) >= 6 AS is_semantic FROM {t}"""


@query(
    "prof_text",
    sql=_text_sql("documents", "text", "documents") + " UNION ALL " + _text_sql("conversations", "text", "conversations"),
)
def prof_text(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        prof.text_profile(table(spark, sf, t), ["text"]).select(
            F.lit(t).alias("source"), F.round("avg_tokens", 8).alias("avg_tokens"), "vocab_size", "is_semantic"
        )
        for t in ("documents", "conversations")
    ]
    return parts[0].unionAll(parts[1])


@query(
    "prof_minmax",
    sql=per_column_sql(ORDERS_SQL, {c: {"vmin": f"min({c})::DOUBLE", "vmax": f"max({c})::DOUBLE"} for c in (*ORDER_NUMBERS, "order_month")}),
)
def prof_minmax(spark: SparkSession, sf: str) -> DataFrame:
    return prof.per_column(
        orders_frame(spark, sf),
        {c: {"vmin": F.min(c).cast("double"), "vmax": F.max(c).cast("double")} for c in (*ORDER_NUMBERS, "order_month")},
    )


_GAP_COLUMNS = ("priority_shift", "order_month", "c_nationkey", "o_custkey")


@query(
    "prof_uniform_gaps",
    sql=with_frame(
        ORDERS_SQL,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(DISTINCT g) = 1 AS uniform_gaps FROM (SELECT v - lag(v) OVER (ORDER BY v) AS g
            FROM (SELECT DISTINCT {c} AS v FROM t)) WHERE g IS NOT NULL"""
            for c in _GAP_COLUMNS
        ),
    ),
)
def prof_uniform_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return prof.uniform_gaps(orders_frame(spark, sf), _GAP_COLUMNS)


_LINE_KINDS = {
    "l_orderkey": "int", "l_partkey": "int", "l_suppkey": "int", "l_linenumber": "int", "l_quantity": "float",
    "l_extendedprice": "float", "l_discount": "float", "l_tax": "float", "l_returnflag": "string",
    "l_linestatus": "string", "l_shipdate": "datetime",
}


@query(
    "prof_full",
    sql=typed("SELECT * FROM lineitem", _LINE_KINDS)
    + f"""SELECT "column", n, n_null, round(missing_ratio, 8) AS missing_ratio, cardinality, round(skewness, 8) AS skewness,
    round(zero_ratio, 8) AS zero_ratio, has_negative, round(outlier_ratio, 8) AS outlier_ratio, {sig('variance')} AS variance,
    round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75, vmin, vmax, round(most_frequent_ratio, 8) AS most_frequent_ratio,
    has_rare, feature_type, subtype, transformation, scaler, imputer, encoding FROM d""",
)
def prof_full(spark: SparkSession, sf: str) -> DataFrame:
    p = prof.profile(table(spark, sf, "lineitem"))
    r8 = ("missing_ratio", "skewness", "zero_ratio", "outlier_ratio", "most_frequent_ratio")
    return p.select(
        "column", "n", "n_null", "cardinality", "has_negative", "has_rare", "feature_type", "subtype", "transformation",
        "scaler", "imputer", "encoding", *[F.round(c, 8).alias(c) for c in r8], sig_col(F.col("variance")).alias("variance"),
        *[F.round(c, 6).alias(c) for c in ("q25", "q50", "q75")], F.col("min").alias("vmin"), F.col("max").alias("vmax"),
    )


@query(
    "profile_summary",
    sql=_ORDERS_D
    + """SELECT "column", subtype, transformation, scaler, imputer, is_skewed, has_outliers, missing_ratio > 0 AS needs_imputation
    FROM d WHERE feature_type = 'numerical' AND drop_reason IS NULL""",
)
def profile_summary(spark: SparkSession, sf: str) -> DataFrame:
    return prof.profile_summary(profiled(orders_frame, spark, sf))


# ---- typing and decision rules --------------------------------------------------------------

_EVENT_KINDS = {
    "event_id": "int", "ts": "datetime", "user_id": "int", "event_type": "string", "value": "float", "props": "string",
    "event_hour": "int",
}
_LINE2_KINDS = {
    "l_orderkey": "int", "l_linenumber": "int", "l_quantity": "float", "l_extendedprice": "float", "l_discount": "float",
    "l_tax": "float", "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "datetime", "score": "float",
    "label": "int",
}
_RULE_FRAMES = (
    ("orders", orders_frame, ORDERS_SQL, ORDER_KINDS),
    ("lines", lines_frame, LINES_SQL, _LINE2_KINDS),
    ("docs", docs_frame, DOCS_SQL, _DOC_KINDS),
    ("events", events_frame, EVENTS_SQL, _EVENT_KINDS),
)


def _rule_query(name: str, fields: tuple[str, ...], mode: str = "effective", frames=_RULE_FRAMES) -> None:
    sql = " UNION ALL ".join(
        f"SELECT * FROM ({typed(fs, ks, mode)} SELECT '{n}' AS source, \"column\", {', '.join(fields)} FROM d)" for n, _f, fs, ks in frames
    )

    @query(name, sql=sql)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        profiles = together(*[lambda f=f, ks=ks: profiled(f, spark, sf, list(ks), mode) for _n, f, _s, ks in frames])
        parts = [p.select(F.lit(n).alias("source"), "column", *fields) for p, (n, _f, _s, _k) in zip(profiles, frames)]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionAll(p)
        return out


_rule_query("type_detect", ("feature_type",))
_rule_query("type_detect_strict", ("feature_type",), "strict")
_ORDERS_EVENTS = (_RULE_FRAMES[0], _RULE_FRAMES[3])
_rule_query("num_subtype", ("subtype",))
_rule_query("rule_transformation", ("transformation",), frames=_ORDERS_EVENTS)
_rule_query("rule_scaler", ("scaler",), frames=_ORDERS_EVENTS)
_rule_query("rule_imputer", ("imputer",), frames=_ORDERS_EVENTS)
_rule_query("rule_num_encoding", ("subtype", "encoding"), frames=(_RULE_FRAMES[0],))
_rule_query("rule_categorical_encoding", ("feature_type", "encoding"), frames=(_RULE_FRAMES[0], _RULE_FRAMES[3], _RULE_FRAMES[2]))

_CYCLIC_PARTS = (("orders", "order_month"), ("orders", "c_nationkey"), ("events", "event_hour"), ("events", "user_id"))


@query(
    "num_cyclic",
    sql=f"""WITH o AS ({ORDERS_SQL}), e AS ({EVENTS_SQL}),
    r AS (SELECT 'order_month' AS "column", min(order_month) AS vmin, max(order_month) AS vmax FROM o
      UNION ALL SELECT 'c_nationkey', min(c_nationkey), max(c_nationkey) FROM o
      UNION ALL SELECT 'event_hour', min(event_hour), max(event_hour) FROM e
      UNION ALL SELECT 'user_id', min(user_id), max(user_id) FROM e)
    SELECT "column", vmin::DOUBLE AS vmin, vmax::DOUBLE AS vmax, (contains("column", 'hour') AND vmin >= 0 AND vmax <= 23)
      OR (contains("column", 'month') AND vmin >= 1 AND vmax <= 12) AS is_cyclic FROM r""",
)
def num_cyclic(spark: SparkSession, sf: str) -> DataFrame:
    def ranges(df: DataFrame, cols: list[str]) -> DataFrame:
        return prof.per_column(df, {c: {"min": F.min(c).cast("double"), "max": F.max(c).cast("double")} for c in cols})

    r = ranges(orders_frame(spark, sf), ["order_month", "c_nationkey"]).unionAll(
        ranges(events_frame(spark, sf), ["event_hour", "user_id"])
    )
    return r.select("column", F.col("min").alias("vmin"), F.col("max").alias("vmax"), rules.is_cyclic().alias("is_cyclic"))


_ORD_COLUMNS = ["o_orderpriority", "o_orderstatus", "c_mktsegment"]


@query(
    "cat_ordinal_detect",
    sql=f"""SELECT "column", count(rank) AS n_matches, count(rank) >= 2 AS is_ordinal FROM ({ordinal_values_sql(ORDERS_SQL, _ORD_COLUMNS)})
    GROUP BY "column" HAVING count(rank) > 0""",
)
def cat_ordinal_detect(spark: SparkSession, sf: str) -> DataFrame:
    found = prof.ordinal_order(orders_frame(spark, sf), _ORD_COLUMNS)
    return found.select("column", "n_matches", (F.col("n_matches") >= 2).alias("is_ordinal"))


@query(
    "cat_ordinal_order",
    sql=f"""SELECT "column", value, row_number() OVER (PARTITION BY "column" ORDER BY rank, value) - 1 AS position
    FROM ({ordinal_values_sql(ORDERS_SQL, _ORD_COLUMNS)}) WHERE rank IS NOT NULL QUALIFY count(*) OVER (PARTITION BY "column") >= 2""",
)
def cat_ordinal_order(spark: SparkSession, sf: str) -> DataFrame:
    return prof.ordinal_positions(orders_frame(spark, sf), _ORD_COLUMNS)


@query(
    "cat_dispatch",
    sql=_ORDERS_D
    + """SELECT "column", feature_type, cardinality, round(most_frequent_ratio, 8) AS most_frequent_ratio, has_rare FROM d
    WHERE feature_type IN ('categorical_nominal', 'categorical_ordinal')""",
)
def cat_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    p = profiled(orders_frame, spark, sf)
    return p.where(F.col("feature_type").startswith("categorical")).select(
        "column", "feature_type", "cardinality", F.round("most_frequent_ratio", 8).alias("most_frequent_ratio"), "has_rare"
    )


@query(
    "rule_vectorization",
    sql=" UNION ALL ".join(
        f"""SELECT '{t}.{c}' AS source, CASE WHEN tok >= 6 THEN 'embeddings' WHEN vocab > 100000 THEN 'hash' ELSE 'tfidf' END AS vectorization
        FROM (SELECT avg(len({tokens_sql(c)})) AS tok, (SELECT count(DISTINCT w) FROM (SELECT unnest({tokens_sql(f'lower({c})')}) AS w FROM {t})) AS vocab FROM {t})"""
        for t, c in (("documents", "text"), ("conversations", "text"), ("part", "p_name"))
    ),
)
def rule_vectorization(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        prof.text_profile(table(spark, sf, t), [c]).select(F.lit(f"{t}.{c}").alias("source"), rules.vectorization().alias("vectorization"))
        for t, c in (("documents", "text"), ("conversations", "text"), ("part", "p_name"))
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("fn_threshold", sql=with_frame(LINES_SQL, "SELECT l_orderkey, l_linenumber, CASE WHEN score >= 50 THEN 1 ELSE 0 END AS prediction FROM t"))
def fn_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return lines_frame(spark, sf).select("l_orderkey", "l_linenumber", at_least(F.col("score"), 50).alias("prediction"))
