"""Column-level projections and filters driven by the profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.profile import redundancy_facts, facts_frame, ident


def redundant_columns(df: DataFrame, columns: Sequence[str] | None = None, reason: str | None = None) -> DataFrame:
    """Report of droppable columns: ``column, reason, cardinality, is_primary_key``.

    With ``reason`` only that test applies; otherwise the first applicable reason wins.
    """
    facts = facts_frame(df, redundancy_facts(df, columns))
    report = facts.where(F.col("drop_reason").isNotNull())
    if reason is not None:
        report = report.where(F.col("drop_reason") == reason)
    return report.select(
        "column",
        F.col("drop_reason").alias("reason"),
        F.greatest(F.col("cardinality_with_null"), F.lit(1)).alias("cardinality"),
        (F.col("cardinality_with_null") == F.col("n")).alias("is_primary_key"),
    )


def drop_redundant(
    df: DataFrame, columns: Sequence[str] | None = None, protect: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Narrowed frame and the report; the narrowing reaches the scan as column pruning."""
    report = redundant_columns(df, columns)
    gone = {r["column"] for r in report.select("column").collect()} - set(protect)
    return df.select(*[ident(c) for c in df.columns if c not in gone]), report


def route(profiled: DataFrame) -> DataFrame:
    """``feature_type, n_columns, columns``: live columns grouped by type, table order kept."""
    position = F.monotonically_increasing_id()
    live = profiled.where(F.col("drop_reason").isNull() & (F.col("feature_type") != "identifier")).withColumn("_p", position)
    return (
        live.groupBy("feature_type")
        .agg(F.array_sort(F.collect_list(F.struct("_p", "column"))).alias("_c"))
        .select(
            "feature_type",
            F.size("_c").cast("bigint").alias("n_columns"),
            F.array_join(F.transform("_c", lambda s: s["column"]), ",").alias("columns"),
        )
    )


def project(df: DataFrame, selected: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Only the selected feature columns (plus keys or label); everything else is dropped."""
    return df.select(*[ident(c) for c in [*keep, *selected]])


def project_vector(df: DataFrame, indices: Sequence[int], column: str = "features", to: str = "selected") -> DataFrame:
    """Keep the given positions of an assembled vector."""
    return VectorSlicer(inputCol=column, outputCol=to, indices=list(indices)).transform(df)
