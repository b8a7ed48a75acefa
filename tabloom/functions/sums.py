"""Sums of numpy arrays over a table: one array per partition, added on the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUPS = 32  # the sums of more partitions than this meet in so many tasks first


def sum_over(rows: DataFrame, one: Callable[[pd.DataFrame], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``one(batch)`` over all batches; only the ``size`` numbers of the total reach the driver.  ``rows``
    must not be empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for pdf in batches:
            if len(pdf):
                total += one(pdf)
        yield pd.DataFrame({"v": [total]})

    part = rows.mapInPandas(run, "v array<double>").select(array_to_vector("v").alias("v"))
    if rows.rdd.getNumPartitions() > GROUPS:
        part = part.groupBy(F.pmod(F.spark_partition_id(), F.lit(GROUPS))).agg(Summarizer.sum(F.col("v")).alias("v"))
    return part.agg(Summarizer.sum(F.col("v")).alias("v")).first()["v"].toArray()


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)
