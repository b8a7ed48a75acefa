"""Datetime features: components, cyclic pairs, elapsed days, granularity."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.profile import ident

# Component names and the default choice.
COMPONENTS = {
    "year": F.year,
    "month": F.month,
    "day": F.dayofmonth,
    "hour": F.hour,
    "minute": F.minute,
    "dayofweek": F.weekday,  # Monday = 0
    "quarter": F.quarter,
    "weekofyear": F.weekofyear,
}
DEFAULT_COMPONENTS = ("year", "month", "dayofweek")
PERIODS = {"month": 12, "dayofweek": 7, "hour": 24, "minute": 60, "quarter": 4, "day": 31}


def components(df: DataFrame, column: str, wanted: Sequence[str] = DEFAULT_COMPONENTS) -> DataFrame:
    return df.withColumns({f"{column}_{w}": COMPONENTS[w](ident(column)).cast("int") for w in wanted})


def cyclic_pair(c: Column, period: float) -> tuple[Column, Column]:
    angle = c.cast("double") * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def cyclic_components(df: DataFrame, column: str, wanted: Sequence[str] = ("month", "dayofweek")) -> DataFrame:
    out = {}
    for w in wanted:
        out[f"{column}_{w}_sin"], out[f"{column}_{w}_cos"] = cyclic_pair(COMPONENTS[w](ident(column)), PERIODS[w])
    return df.withColumns(out)


def cyclic_number(df: DataFrame, column: str, period: float) -> DataFrame:
    s, c = cyclic_pair(ident(column), period)
    return df.withColumns({f"{column}_sin": s, f"{column}_cos": c})


def delta_days(df: DataFrame, column: str, reference: str) -> DataFrame:
    return df.withColumn(f"{column}_days", F.date_diff(ident(column), F.to_date(F.lit(reference))))


def granularity(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """datetime when any value has a time of day; year_month when all fall on a month's first day; else date."""
    from tabloom.operators.profile import has_time, per_column

    return per_column(
        df,
        {
            c: {
                "granularity": F.when(has_time(ident(c)), "datetime")
                .when(F.bool_and(F.dayofmonth(ident(c)) == 1), "year_month")
                .otherwise("date")
            }
            for c in columns
        },
    )
