"""Score a stream with a fitted pipeline.

Fitted preparation holds only literal expressions and library models are stateless, so
the batch pipeline runs on a streaming frame unchanged; no state, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def score_stream(
    model: Transformer, stream: DataFrame, path: str, checkpoint: str, columns: Sequence[str] | None = None
) -> StreamingQuery:
    """Write scored rows as parquet, processing what is available now and then stopping."""
    out = model.transform(stream)
    if columns is not None:
        out = out.select(*columns)
    return (
        out.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
