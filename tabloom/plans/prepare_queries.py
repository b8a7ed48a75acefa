"""Fitted preprocessing transforms as named queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators import dates, encode, impute, power, scale, text, word_vectors
from tabloom.operators.preprocess import TabularPreprocessor
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
from tabloom.plans.sqltext import hash_sql, tokens_sql, with_frame
from tabloom.sources import tables as src

KEY2 = ["l_orderkey", "l_linenumber"]


def r6(c: str, alias: str | None = None):
    return F.round(c, 6).alias(alias or c)


# ---- imputation ---------------------------------------------------------------------------


def _impute_query(name: str, strategy: str, agg: str) -> None:
    @query(name, sql=with_frame(ORDERS_SQL, f"SELECT o_orderkey, round(coalesce(price_known, (SELECT {agg} FROM t)), 3) AS price_known FROM t"))
    def run(spark: SparkSession, sf: str) -> DataFrame:
        df = impute.impute(orders_frame(spark, sf), strategy, ["price_known"])
        return df.select("o_orderkey", F.round("price_known", 3).alias("price_known"))


_impute_query("impute_mean", "mean", "avg(price_known)")
_impute_query("impute_median", "median", "quantile_cont(price_known, 0.5)")


def _mode_sql(c: str, t: str = "t") -> str:
    return f"(SELECT v FROM (SELECT {c} AS v, count(*) AS k FROM {t} WHERE {c} IS NOT NULL GROUP BY {c}) ORDER BY k DESC, v LIMIT 1)"


_NULLED_SQL = f"""SELECT doc_id, n_chars, quality, CASE WHEN quality = 1 THEN lang END AS good_lang FROM ({DOCS_SQL})"""


def _nulled_docs(spark: SparkSession, sf: str) -> DataFrame:
    return docs_frame(spark, sf).select("doc_id", "n_chars", "quality", F.when(F.col("quality") == 1, F.col("lang")).alias("good_lang"))


@query(
    "impute_mode",
    sql=with_frame(
        _NULLED_SQL,
        f"SELECT doc_id, coalesce(quality, {_mode_sql('quality')}) AS quality, coalesce(good_lang, {_mode_sql('good_lang')}) AS good_lang FROM t",
    ),
)
def impute_mode(spark: SparkSession, sf: str) -> DataFrame:
    return impute.impute(_nulled_docs(spark, sf), "mode", ["quality", "good_lang"]).select(
        "doc_id", F.col("quality").cast("int").alias("quality"), "good_lang"
    )


@query("impute_constant", sql=with_frame(_NULLED_SQL, "SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(good_lang, 'missing') AS good_lang FROM t"))
def impute_constant(spark: SparkSession, sf: str) -> DataFrame:
    df = impute.impute(_nulled_docs(spark, sf), "constant", ["quality"], -1)
    return impute.impute(df, "constant", ["good_lang"], "missing").select("doc_id", "quality", "good_lang")


@query("impute_indicator", sql=with_frame(_NULLED_SQL, "SELECT doc_id, quality, CASE WHEN quality IS NULL THEN 1 ELSE 0 END AS quality_missing FROM t"))
def impute_indicator(spark: SparkSession, sf: str) -> DataFrame:
    return impute.add_indicators(_nulled_docs(spark, sf), ["quality"]).select("doc_id", "quality", "quality_missing")


def _det3(rows) -> str:
    (a, b, c), (d, e, f), (g, h, i) = rows
    return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"


def _slopes_sql(y: str, xs: tuple[str, str, str]) -> str:
    """Least-squares slopes w_<y>_<x> by Cramer's rule over the covariances of ``s``."""
    cov = lambda p, q: f"s_{min(p, q)}{max(p, q)}"
    full = [[cov(p, q) for q in xs] for p in xs]
    with_y = lambda k: [[cov(p, y) if j == k else v for j, v in enumerate(row)] for p, row in zip(xs, full)]
    return ", ".join(f"{_det3(with_y(k))} / {_det3(full)} AS w_{y}_{x}" for k, x in enumerate(xs))


def _iterative_sql() -> str:
    names = "abqx"
    cov = ", ".join(f"covar_pop({p}, {q}) AS s_{p}{q}" for i, p in enumerate(names) for q in names[i:])
    guess = lambda y, o, v: f"m_{y} + w_{y}_{o} * ({v} - m_{o}) + w_{y}_a * (a - m_a) + w_{y}_b * (b - m_b)"
    return f"""WITH t AS (SELECT doc_id, n_chars::DOUBLE AS a, (length(text) - length(replace(text, ' ', '')) + 1)::DOUBLE AS b,
      quality::DOUBLE AS q, toxic::DOUBLE AS x FROM ({DOCS_SQL})),
    s AS (SELECT {", ".join(f"avg({c}) AS m_{c}" for c in names)}, {cov} FROM t WHERE q IS NOT NULL),
    w AS (SELECT *, {_slopes_sql("q", ("x", "a", "b"))}, {_slopes_sql("x", ("q", "a", "b"))} FROM s),
    r1 AS (SELECT *, {guess("q", "x", "m_x")} AS q1 FROM t, w), r2 AS (SELECT *, {guess("x", "q", "q1")} AS x1 FROM r1),
    r3 AS (SELECT *, {guess("q", "x", "x1")} AS q2 FROM r2), r4 AS (SELECT *, {guess("x", "q", "q2")} AS x2 FROM r3)
    SELECT doc_id, round(coalesce(q, q2), 6) AS quality, round(coalesce(x, x2), 6) AS toxic FROM r4"""


@query("impute_iterative", sql=_iterative_sql())
def impute_iterative(spark: SparkSession, sf: str) -> DataFrame:
    df = docs_frame(spark, sf).select("doc_id", "n_chars", F.length("text").alias("len"), F.size(F.split("text", " ")).alias("words"), "quality", "toxic")
    return impute.impute_iterative(df, ["quality", "toxic"], ["n_chars", "words"], ["doc_id"], rounds=2).select(
        "doc_id", r6("quality"), r6("toxic")
    )


# ---- scalers --------------------------------------------------------------------------------


def _scale_query(name: str, strategy: str, columns: tuple[str, ...], sql_expr) -> None:
    body = ", ".join(f"round({sql_expr(c)}, 6) AS {c}" for c in columns)

    @query(name, sql=with_frame(LINES_SQL, f"SELECT l_orderkey, l_linenumber, {body} FROM t"))
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return scale.scale(lines_frame(spark, sf), strategy, columns).select(*KEY2, *[r6(c) for c in columns])


_NUM = ("l_quantity", "l_extendedprice", "l_discount")
_scale_query("scale_standard", "standard", _NUM, lambda c: f"({c} - (SELECT avg({c}) FROM t)) / (SELECT stddev_pop({c}) FROM t)")
_scale_query(
    "scale_robust", "robust", _NUM,
    lambda c: f"({c} - (SELECT quantile_cont({c}, 0.5) FROM t)) / (SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM t)",
)
_scale_query("scale_minmax", "min_max_scaler", _NUM, lambda c: f"({c} - (SELECT min({c}) FROM t)) / (SELECT max({c}) - min({c}) FROM t)")
_scale_query("scale_maxabs", "max_abs_scaler", _NUM, lambda c: f"{c} / (SELECT max(abs({c})) FROM t)")


# ---- distribution transforms -------------------------------------------------------------------


def _transform_query(name: str, kind: str, expr: str) -> None:
    @query(name, sql=f"SELECT event_id, round({expr}, 6) AS value FROM events")
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return power.transform(table(spark, sf, "events"), kind, ["value"]).select("event_id", r6("value"))


_transform_query("tf_log", "log", "CASE WHEN value > 0 THEN ln(value) END")
_transform_query("tf_log1p", "log1p", "CASE WHEN value > -1 THEN ln(1 + value) END")
_transform_query("tf_sqrt", "sqrt", "CASE WHEN value >= 0 THEN sqrt(value) END")

_YJ = """CASE WHEN x >= 0 THEN CASE WHEN lam = 0 THEN ln(1 + x) ELSE (pow(1 + x, lam) - 1) / lam END
  ELSE CASE WHEN lam = 2 THEN -ln(1 - x) ELSE -(pow(1 - x, 2 - lam) - 1) / (2 - lam) END END"""
_BC = "CASE WHEN lam = 0 THEN ln(x) ELSE (pow(x, lam) - 1) / lam END"


def _power_sql(t: str, key: str, col: str, expr: str, jac: str, varied: str) -> str:
    return f"""WITH x AS (SELECT {key}, {col}::DOUBLE AS x FROM {t}), g AS (SELECT round(range / 100.0, 2)::DOUBLE AS lam FROM range(-500, 501)),
    j AS (SELECT sum({jac}) AS jac, count(*) AS n FROM x),
    v AS (SELECT lam, var_pop({varied}) AS v FROM x CROSS JOIN g GROUP BY lam),
    best AS (SELECT lam FROM v, j WHERE v > 0 AND isfinite(v) ORDER BY -n / 2.0 * ln(v) + (lam - 1) * jac DESC LIMIT 1),
    y AS (SELECT {key}, lam, {expr} AS y FROM x, best)
    SELECT {key}, lam, round((y - (SELECT avg(y) FROM y)) / (SELECT stddev_pop(y) FROM y), 5) AS z FROM y"""


def _power_query(name: str, kind: str, t: str, key: str, col: str, expr: str, jac: str, varied: str) -> None:
    @query(name, sql=_power_sql(t, key, col, expr, jac, varied))
    def run(spark: SparkSession, sf: str) -> DataFrame:
        df = table(spark, sf, t).select(key, F.col(col).alias("z"))
        lams = power.fit_lambdas(df, kind, {"z": F.col("z")}, digits=2)
        out = power.power_transform(df, kind, ["z"], lams=lams)
        return out.select(key, F.lit(lams["z"]).alias("lam"), F.round("z", 5).alias("z"))


_power_query("tf_yeo_johnson", "yeo_johnson", "customer", "c_custkey", "c_acctbal", _YJ, "sign(x) * ln(1 + abs(x))", _YJ)
_power_query("tf_box_cox", "box_cox", "part", "p_partkey", "p_retailprice", _BC, "ln(x)", "CASE WHEN lam = 0 THEN ln(x) ELSE pow(x, lam) / lam END")


@query(
    "tf_scaler_as_transform",
    sql=with_frame(
        LINES_SQL,
        """SELECT l_orderkey, l_linenumber, round((l_quantity - (SELECT avg(l_quantity) FROM t)) / (SELECT stddev_pop(l_quantity) FROM t), 6) AS l_quantity,
        round((l_tax - (SELECT min(l_tax) FROM t)) / (SELECT max(l_tax) - min(l_tax) FROM t), 6) AS l_tax, round(l_discount, 6) AS l_discount FROM t""",
    ),
)
def tf_scaler_as_transform(spark: SparkSession, sf: str) -> DataFrame:
    df = power.transform(lines_frame(spark, sf), "standard", ["l_quantity"])
    df = power.transform(power.transform(df, "minmax", ["l_tax"]), "not_a_transform", ["l_discount"])
    return df.select(*KEY2, r6("l_quantity"), r6("l_tax"), r6("l_discount"))


def _std(e: str) -> str:
    return f"round(({e} - (SELECT avg({e}) FROM t)) / (SELECT stddev_pop({e}) FROM t), 6)"


_PRICE = "coalesce(price_known, (SELECT avg(price_known) FROM t))"
_NATION = "ln(1 + c_nationkey)"
_ROBUST_NATION = f"""round(({_NATION} - (SELECT quantile_cont({_NATION}, 0.5) FROM t)) / (SELECT quantile_cont({_NATION}, 0.75)
 - quantile_cont({_NATION}, 0.25) FROM t), 6)"""
_PRICE_STD = f"""round(({_PRICE} - (SELECT avg(price_known) FROM t)) / (SELECT stddev_pop(p) FROM (SELECT {_PRICE} AS p FROM t)), 6)"""


@query(
    "prep_numeric_scaled",
    sql=with_frame(ORDERS_SQL, f"SELECT o_orderkey, {_std('o_custkey')} AS o_custkey, {_PRICE_STD} AS price_known, {_ROBUST_NATION} AS c_nationkey FROM t"),
)
def prep_numeric_scaled(spark: SparkSession, sf: str) -> DataFrame:
    df = orders_frame(spark, sf)
    m = TabularPreprocessor(inputCols=["o_custkey", "price_known", "c_nationkey"], keepCols=["o_orderkey"]).fit(df)
    return m.transform(df).select("o_orderkey", *[F.round(F.col(c) + 0.0, 6).alias(c) for c in ("o_custkey", "price_known", "c_nationkey")])


# ---- encoders -----------------------------------------------------------------------------------


@query("enc_passthrough", sql=with_frame(ORDERS_SQL, "SELECT o_orderkey, final_flag, order_month FROM t"))
def enc_passthrough(spark: SparkSession, sf: str) -> DataFrame:
    df = orders_frame(spark, sf)
    m = TabularPreprocessor(inputCols=["final_flag", "order_month"], keepCols=["o_orderkey"]).fit(df)
    return m.transform(df)


@query("enc_ordinal_numeric", sql=with_frame(ORDERS_SQL, "SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY priority_shift) - 1 AS INTEGER) AS priority_shift FROM t"))
def enc_ordinal_numeric(spark: SparkSession, sf: str) -> DataFrame:
    df = orders_frame(spark, sf)
    filled = impute.impute(df, "median", ["priority_shift"])
    return encode.ordinal(filled, "priority_shift", "code").select("o_orderkey", F.col("code").alias("priority_shift"))


def _onehot_sql(c: str, values) -> str:
    return ", ".join(f"CASE WHEN {c} = {v!r} THEN 1 ELSE 0 END AS \"{encode.category_name(c, v)}\"" for v in values)


@query("enc_onehot_numeric", sql=with_frame(LINES_SQL, f"SELECT l_orderkey, l_linenumber, {_onehot_sql('l_linenumber', range(1, 8))} FROM t"))
def enc_onehot_numeric(spark: SparkSession, sf: str) -> DataFrame:
    df = impute.impute(lines_frame(spark, sf), "mode", ["l_linenumber"])
    out = encode.onehot(df, "l_linenumber")
    return out.select(*KEY2, *[c for c in out.columns if c.startswith("l_linenumber_")])


_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("enc_onehot_nominal", sql=f"SELECT c_custkey, {_onehot_sql('c_mktsegment', _SEGMENTS)} FROM customer")
def enc_onehot_nominal(spark: SparkSession, sf: str) -> DataFrame:
    df = impute.impute(table(spark, sf, "customer"), "mode", ["c_mktsegment"])
    out = encode.onehot(df, "c_mktsegment")
    return out.select("c_custkey", *[c for c in out.columns if c.startswith("c_mktsegment_")])


@query("enc_ordinal_nominal", sql="SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS brand_code, CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS INTEGER) AS name_code FROM part")
def enc_ordinal_nominal(spark: SparkSession, sf: str) -> DataFrame:
    df = encode.ordinal(encode.ordinal(table(spark, sf, "part"), "p_brand", "brand_code"), "p_name", "name_code")
    return df.select("p_partkey", "brand_code", "name_code")


@query("enc_fallback_onehot", sql="SELECT p_partkey, p_brand AS value, 1 AS hot, (SELECT count(DISTINCT p_brand) FROM part) AS width FROM part")
def enc_fallback_onehot(spark: SparkSession, sf: str) -> DataFrame:
    """p_brand asks for target encoding; the fallback one-hot is read back as (row, hot value)."""
    df = table(spark, sf, "part").select("p_partkey", "p_brand")
    m = TabularPreprocessor(inputCols=["p_brand"], keepCols=["p_partkey"], encodings="onehot").fit(df)
    names = m.feature_names
    wide = m.transform(df)
    pairs = F.array(*[F.struct(F.lit(n[len("p_brand_"):]).alias("value"), F.col(f"`{n}`").alias("hot")) for n in names])
    return wide.select("p_partkey", F.inline(pairs)).where("hot = 1").withColumn("width", F.lit(len(names)).cast("bigint"))


@query("enc_ordinal_ordered", sql="SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '3-MEDIUM' THEN 1 WHEN '2-HIGH' THEN 2 ELSE -1 END AS code FROM orders")
def enc_ordinal_ordered(spark: SparkSession, sf: str) -> DataFrame:
    from tabloom.operators.profile import ordinal_order

    df = table(spark, sf, "orders")
    order = ordinal_order(df, ["o_orderpriority"]).first()["category_order"]
    return encode.ordinal_ordered(df, "o_orderpriority", order, "code").select("o_orderkey", "code")


@query("enc_bool_numeric", sql=with_frame(DOCS_SQL, f"SELECT doc_id, CAST(coalesce(quality, {_mode_sql('quality')}) AS INTEGER) AS quality, CAST(coalesce(toxic, {_mode_sql('toxic')}) AS INTEGER) AS toxic FROM t"))
def enc_bool_numeric(spark: SparkSession, sf: str) -> DataFrame:
    df = docs_frame(spark, sf).select("doc_id", "quality", "toxic")
    m = TabularPreprocessor(inputCols=["quality", "toxic"], keepCols=["doc_id"]).fit(df)
    return m.transform(df)


@query("enc_bool_string", sql="SELECT l_orderkey, l_linenumber, CASE l_linestatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE -1 END AS l_linestatus FROM lineitem")
def enc_bool_string(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem")
    fill = impute.learn_mode(df, ["l_linestatus"])
    return encode.fill_then_code(df, "l_linestatus", fill, "code").select(*KEY2, F.col("code").alias("l_linestatus"))


_LANGS = ("de", "en", "es", "fr")
_STATUS = ("F", "O", "P")


@query(
    "prep_nominal_groups",
    sql=with_frame(
        ORDERS_SQL,
        f"SELECT o_orderkey, {_onehot_sql('o_orderstatus', _STATUS)}, {_onehot_sql('c_mktsegment', _SEGMENTS)}, "
        "CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '3-MEDIUM' THEN 1 WHEN '2-HIGH' THEN 2 ELSE -1 END AS o_orderpriority FROM t",
    ),
)
def prep_nominal_groups(spark: SparkSession, sf: str) -> DataFrame:
    df = orders_frame(spark, sf)
    m = TabularPreprocessor(inputCols=["o_orderstatus", "c_mktsegment", "o_orderpriority"], keepCols=["o_orderkey"]).fit(df)
    return m.transform(df)


_BUILD_COLUMNS = ["o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "price_known", "price_urgent", "is_big", "order_month", "priority_shift", "record_kind", "c_mktsegment", "c_nationkey"]
_BUILD_SQL = f"""SELECT o_orderkey, {_std('o_custkey')} AS o_custkey, {_onehot_sql('o_orderstatus', _STATUS)},
CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '3-MEDIUM' THEN 1 WHEN '2-HIGH' THEN 2 ELSE -1 END AS o_orderpriority,
{_PRICE_STD} AS price_known, CAST(is_big AS INTEGER) AS is_big, order_month,
CAST(dense_rank() OVER (ORDER BY priority_shift) - 1 AS INTEGER) AS priority_shift,
{_onehot_sql('c_mktsegment', _SEGMENTS)}, {_ROBUST_NATION} AS c_nationkey FROM t"""


@query("prep_build", sql=with_frame(ORDERS_SQL, _BUILD_SQL))
def prep_build(spark: SparkSession, sf: str) -> DataFrame:
    df = orders_frame(spark, sf)
    m = TabularPreprocessor(inputCols=_BUILD_COLUMNS, keepCols=["o_orderkey"]).fit(df)
    return m.transform(df).withColumns({c: F.round(F.col(c) + 0.0, 6) for c in ("o_custkey", "price_known", "c_nationkey")})


_TRAIN = f"({hash_sql('o_orderkey')} >= CAST(floor(0.2::DOUBLE * 4503599627370496) AS BIGINT))"


@query(
    "prep_fit_transform",
    sql=f"""WITH o AS ({ORDERS_SQL}), t AS (SELECT * FROM o WHERE {_TRAIN})
    SELECT o_orderkey, {_TRAIN} AS is_train,
    round((o_custkey - (SELECT avg(o_custkey) FROM t)) / (SELECT stddev_pop(o_custkey) FROM t), 6) AS o_custkey,
    round((coalesce(price_known, (SELECT avg(price_known) FROM t)) - (SELECT avg(price_known) FROM t))
      / (SELECT stddev_pop(p) FROM (SELECT coalesce(price_known, (SELECT avg(price_known) FROM t)) AS p FROM t)), 6) AS price_known,
    {_onehot_sql('o_orderstatus', _STATUS)} FROM o""",
)
def prep_fit_transform(spark: SparkSession, sf: str) -> DataFrame:
    df = src.with_split(orders_frame(spark, sf), ["o_orderkey"], ratio=0.2)
    prep = TabularPreprocessor(inputCols=["o_custkey", "price_known", "o_orderstatus"], keepCols=["o_orderkey", "split"])
    out = prep.fit(df.where("split = 'train'")).transform(df)
    return out.withColumn("is_train", F.col("split") == "train").drop("split").withColumns(
        {c: F.round(F.col(c) + 0.0, 6) for c in ("o_custkey", "price_known")}
    )


@query("enc_frequency", sql="SELECT p_partkey, round(count(*) OVER (PARTITION BY p_name) / (SELECT count(*) FROM part)::DOUBLE, 8) AS name_freq FROM part")
def enc_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return encode.frequency(table(spark, sf, "part"), "p_name", "f").select("p_partkey", F.round("f", 8).alias("name_freq"))


# order and line number repeat in this table; part and supplier make the row key unique
LINE_KEY = [*KEY2, "l_partkey", "l_suppkey"]
_LINE_HASH = hash_sql(" || ':' || ".join(LINE_KEY))


@query(
    "enc_target",
    sql=f"""WITH t AS (SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_returnflag = 'R' AS DOUBLE) AS y, row_number() OVER (ORDER BY {_LINE_HASH}) AS rn, count(*) OVER () AS cnt FROM lineitem),
    f AS (SELECT *, {' + '.join(f'CASE WHEN rn > ({i} * cnt) // 5 THEN 1 ELSE 0 END' for i in range(1, 5))} AS fold FROM t),
    c AS (SELECT l_suppkey, fold, sum(y) AS s, count(*) AS n FROM f GROUP BY 1, 2), a AS (SELECT l_suppkey, sum(s) AS s, sum(n) AS n FROM c GROUP BY 1)
    SELECT l_orderkey, l_linenumber, round(coalesce((a.s - c.s) / nullif(a.n - c.n, 0), (SELECT avg(y) FROM f)), 8) AS supp_target
    FROM f JOIN c USING (l_suppkey, fold) JOIN a USING (l_suppkey)""",
)
def enc_target(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem").select(*LINE_KEY, (F.col("l_returnflag") == "R").cast("double").alias("y"))
    folded = src.with_folds(df, 5, LINE_KEY)
    return encode.target_oof(folded, "l_suppkey", "y", to="t").select(*KEY2, F.round("t", 8).alias("supp_target"))


@query(
    "enc_leave_one_out",
    sql="""SELECT l_orderkey, l_linenumber, round((sum(y) OVER w - y) / nullif(count(*) OVER w - 1, 0), 8) AS part_loo
    FROM (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_returnflag = 'R' AS DOUBLE) AS y FROM lineitem) WINDOW w AS (PARTITION BY l_partkey)""",
)
def enc_leave_one_out(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem").select(*KEY2, "l_partkey", (F.col("l_returnflag") == "R").cast("double").alias("y"))
    return encode.leave_one_out(df, "l_partkey", "y", "v").select(*KEY2, F.round("v", 8).alias("part_loo"))


@query("enc_hashing", sql=f"SELECT event_id, CAST({hash_sql('props', 0)} % 16 AS INTEGER) AS props_bucket FROM events")
def enc_hashing(spark: SparkSession, sf: str) -> DataFrame:
    return encode.hashed(table(spark, sf, "events"), "props", 16).select("event_id", "props_bucket")


@query(
    "enc_binary",
    sql="WITH c AS (SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) AS INTEGER) AS k FROM part) SELECT p_partkey, "
    + ", ".join(f"(k >> {4 - b}) & 1 AS p_brand_bit{b}" for b in range(5))
    + " FROM c",
)
def enc_binary(spark: SparkSession, sf: str) -> DataFrame:
    out = encode.binary(table(spark, sf, "part"), "p_brand")
    return out.select("p_partkey", *[c for c in out.columns if c.startswith("p_brand_bit")])


# ---- dates ------------------------------------------------------------------------------------------

_PARTS = {
    "year": "year(ts)", "month": "month(ts)", "day": "day(ts)", "hour": "hour(ts)", "minute": "minute(ts)",
    "dayofweek": "isodow(ts) - 1", "quarter": "quarter(ts)", "weekofyear": "weekofyear(ts)",
}


@query("dt_components", sql="SELECT event_id, " + ", ".join(f"CAST({e} AS INTEGER) AS ts_{n}" for n, e in _PARTS.items()) + " FROM events")
def dt_components(spark: SparkSession, sf: str) -> DataFrame:
    return dates.components(table(spark, sf, "events"), "ts", list(_PARTS)).select("event_id", *[f"ts_{n}" for n in _PARTS])


@query(
    "dt_cyclic",
    sql="""SELECT l_orderkey, l_linenumber, round(sin(2 * pi() / 12 * month(l_shipdate)), 6) AS month_sin, round(cos(2 * pi() / 12 * month(l_shipdate)), 6) AS month_cos,
    round(sin(2 * pi() / 7 * (isodow(l_shipdate) - 1)), 6) AS dow_sin, round(cos(2 * pi() / 7 * (isodow(l_shipdate) - 1)), 6) AS dow_cos FROM lineitem""",
)
def dt_cyclic(spark: SparkSession, sf: str) -> DataFrame:
    d = dates.cyclic_components(table(spark, sf, "lineitem"), "l_shipdate")
    names = {"month": "month", "dayofweek": "dow"}
    return d.select(*KEY2, *[F.round(F.col(f"l_shipdate_{w}_{f}"), 6).alias(f"{n}_{f}") for w, n in names.items() for f in ("sin", "cos")])


@query("num_cyclic_encode", sql=f"WITH e AS ({EVENTS_SQL}) SELECT event_id, round(sin(2 * pi() / 24 * event_hour), 6) AS hour_sin, round(cos(2 * pi() / 24 * event_hour), 6) AS hour_cos FROM e")
def num_cyclic_encode(spark: SparkSession, sf: str) -> DataFrame:
    d = dates.cyclic_number(events_frame(spark, sf), "event_hour", 24)
    return d.select("event_id", F.round("event_hour_sin", 6).alias("hour_sin"), F.round("event_hour_cos", 6).alias("hour_cos"))


@query("dt_delta_days", sql="SELECT l_orderkey, l_linenumber, CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS INTEGER) AS ship_days FROM lineitem")
def dt_delta_days(spark: SparkSession, sf: str) -> DataFrame:
    d = dates.delta_days(table(spark, sf, "lineitem"), "l_shipdate", "1992-01-01")
    return d.select(*KEY2, F.col("l_shipdate_days").alias("ship_days"))


@query(
    "dt_granularity",
    sql=" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CASE WHEN bool_or(hour({c}) <> 0 OR minute({c}) <> 0) THEN 'datetime' WHEN bool_and(day({c}) = 1) THEN 'year_month' ELSE 'date' END AS granularity FROM {t}"""
        for t, c in (("lineitem", "l_shipdate"), ("events", "ts"))
    )
    + """ UNION ALL SELECT 'ship_month', CASE WHEN bool_and(day(date_trunc('month', l_shipdate)) = 1) THEN 'year_month' ELSE 'date' END FROM lineitem""",
)
def dt_granularity(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumn("ship_month", F.date_trunc("month", "l_shipdate"))
    return dates.granularity(lines, ["l_shipdate", "ship_month"]).unionAll(dates.granularity(table(spark, sf, "events"), ["ts"]))


# ---- text -------------------------------------------------------------------------------------------

_TERMS_SQL = f"""WITH c AS (SELECT doc_id, w AS term, count(*) AS tf FROM (SELECT doc_id, unnest({tokens_sql('lower(text)')}) AS w FROM documents) GROUP BY 1, 2),
v AS (SELECT term, count(*) AS df, sum(tf) AS total FROM c GROUP BY 1 ORDER BY total DESC, term LIMIT 5000)"""


@query(
    "txt_tfidf",
    sql=_TERMS_SQL
    + """, w AS (SELECT doc_id, term, tf * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1.0) AS w FROM c JOIN v USING (term))
    SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 8) AS tfidf FROM w""",
)
def txt_tfidf(spark: SparkSession, sf: str) -> DataFrame:
    out = text.tfidf(table(spark, sf, "documents"), "doc_id", "text")
    return out.select("doc_id", "term", F.round("tfidf", 8).alias("tfidf"))


@query("txt_count", sql=_TERMS_SQL + " SELECT doc_id, term, tf FROM c JOIN v USING (term)")
def txt_count(spark: SparkSession, sf: str) -> DataFrame:
    return text.count_vectors(table(spark, sf, "documents"), "doc_id", "text")


@query(
    "txt_hash",
    sql=_TERMS_SQL + f" SELECT doc_id, CAST({hash_sql('term', 0)} % 262144 AS INTEGER) AS bucket, CAST(sum(tf) AS BIGINT) AS tf FROM c GROUP BY 1, 2",
)
def txt_hash(spark: SparkSession, sf: str) -> DataFrame:
    return text.hash_counts(table(spark, sf, "documents"), "doc_id", "text")


@query(
    "txt_word_pmi",
    sql=f"""WITH d AS (SELECT {tokens_sql('lower(text)')} AS t FROM documents), h AS (SELECT unnest(list_zip(t[:len(t) - k], t[k + 1:])) AS p FROM d, range(1, 6) r(k) WHERE len(t) > k),
    g AS (SELECT p[1] AS x, p[2] AS y, count(*) AS n FROM h GROUP BY 1, 2), s AS (SELECT x AS a, y AS b, n FROM g UNION ALL SELECT y, x, n FROM g),
    c AS (SELECT a, b, sum(n)::BIGINT AS n FROM s GROUP BY 1, 2), m AS (SELECT a, sum(n)::DOUBLE AS w FROM c GROUP BY 1),
    v AS (SELECT c.a, c.b, n, ln(n * (SELECT sum(w) FROM m) / (x.w * y.w)) AS pmi FROM c JOIN m x ON c.a = x.a JOIN m y ON c.b = y.a)
    SELECT a, b, n, round(pmi, 6) AS pmi FROM v WHERE round(pmi, 6) > 0""",
)
def txt_word_pmi(spark: SparkSession, sf: str) -> DataFrame:
    """Every pair of words that stand near each other more often than by chance."""
    docs = table(spark, sf, "documents")
    words = word_vectors.vocabulary(docs, "text")
    out = word_vectors.positive_information(word_vectors.cooccurrences(docs, "text", words=words), words)
    return out.select("a", "b", "n", F.round("pmi", 6).alias("pmi")).where("pmi > 0")


@query("txt_embeddings")
def txt_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    out = text.embeddings(table(spark, sf, "documents"), "doc_id", "text")
    return out.select("doc_id", F.size("embedding").alias("dims"), "embedding")
