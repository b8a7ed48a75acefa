"""Labelled frames over the given tables, each with the same frame as SQL.

The tables hold no nulls, so missing values come from the data's own states: the price
of a pending order is not known yet, and most documents carry no label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.attach import gathered, spread
from tabloom.functions.scalars import token_array
from tabloom.session import keep


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


ORDERS_SQL = """
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderdate, o.o_orderpriority,
       CASE WHEN o.o_orderstatus <> 'P' THEN o.o_totalprice END AS price_known,
       CASE WHEN o.o_orderstatus = 'F' AND o.o_orderpriority = '1-URGENT' THEN o.o_totalprice END AS price_urgent,
       CASE WHEN o.o_orderstatus = 'F' THEN 1 END AS final_flag,
       o.o_totalprice > 250000 AS is_big,
       CAST(month(o.o_orderdate) AS INTEGER) AS order_month,
       CAST(CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) - 3 AS INTEGER) AS priority_shift,
       'order' AS record_kind,
       c.c_name, c.c_acctbal, c.c_mktsegment, c.c_nationkey
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""


def orders_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their customer: numeric, ordinal, nominal, boolean, cyclic, id and null-bearing columns."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    final = F.col("o_orderstatus") == "F"
    return o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price_known"),
        F.when(final & (F.col("o_orderpriority") == "1-URGENT"), F.col("o_totalprice")).alias("price_urgent"),
        F.when(final, 1).alias("final_flag"),
        (F.col("o_totalprice") > 250000).alias("is_big"),
        F.month("o_orderdate").alias("order_month"),
        (F.substring("o_orderpriority", 1, 1).cast("int") - 3).alias("priority_shift"),
        F.lit("order").alias("record_kind"),
        "c_name", "c_acctbal", "c_mktsegment", "c_nationkey",
    )


LINES_SQL = """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
       l_shipdate, round(l_extendedprice / 1000, 0) AS score, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label
FROM lineitem
"""


def lines_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with a binary label (returned) and a coarse, tie-rich score."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
        "l_linestatus", "l_shipdate", F.round(F.col("l_extendedprice") / 1000, 0).alias("score"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
    )


DOCS_SQL = """
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


def docs_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their sparse labels."""
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")


def doc_features(spark: SparkSession, sf: str, labelled: bool = True) -> DataFrame:
    """Documents with twelve standardised text statistics and a label that depends on them; with ``labelled=False`` also those
    without a label."""
    from tabloom.operators.scale import scale

    return scale(gathered(keep(raw_doc_features(spark, sf, labelled))), "standard", DOC_FEATURES)


def raw_doc_features(spark: SparkSession, sf: str, labelled: bool = True) -> DataFrame:
    texts = spread(table(spark, sf, "documents").select("doc_id", "text", "lang"))
    docs = texts.join(table(spark, sf, "labels"), "doc_id", "inner" if labelled else "left")
    t, n = F.col("text"), F.length("text").cast("double")
    tokens = token_array(t)

    def share(pattern: str) -> F.Column:
        """Share of the characters outside ``pattern``, which takes whole runs: far fewer matches than one per character."""
        return F.coalesce(F.try_divide(F.length(F.regexp_replace(t, pattern, "")).cast("double"), n), F.lit(0.0))

    return (
        docs.withColumn("_tok", tokens)
        .select(
            "doc_id",
            F.col("quality").cast("double").alias("label"),
            "toxic",
            F.log1p(n).alias("log_chars"),
            F.log1p(F.size("_tok").cast("double")).alias("log_tokens"),
            F.coalesce(F.try_divide(n, F.size("_tok").cast("double")), F.lit(0.0)).alias("chars_per_token"),
            share("[^A-Z]+").alias("upper_share"),
            share("[^0-9]+").alias("digit_share"),
            share("[^.,;:!?]+").alias("punct_share"),
            share(r"[\p{L}\p{N}\s.,;:!?]+").alias("symbol_share"),
            share(r"\S+").alias("space_share"),
            F.coalesce(
                F.try_divide(F.size(F.array_distinct("_tok")).cast("double"), F.size("_tok").cast("double")), F.lit(0.0)
            ).alias("distinct_share"),
            F.log1p(F.size(F.split("text", "\n")).cast("double")).alias("log_lines"),
            F.coalesce(F.array_max(F.transform("_tok", F.length)), F.lit(0)).cast("double").alias("longest_token"),
            (F.col("lang") == "en").cast("double").alias("is_english"),
        )
    )


DOC_FEATURES = (
    "log_chars", "log_tokens", "chars_per_token", "upper_share", "digit_share", "punct_share", "symbol_share",
    "space_share", "distinct_share", "log_lines", "longest_token", "is_english",
)


EVENTS_SQL = "SELECT event_id, ts, user_id, event_type, value, props, CAST(hour(ts) AS INTEGER) AS event_hour FROM events"


def events_frame(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("event_hour", F.hour("ts"))
