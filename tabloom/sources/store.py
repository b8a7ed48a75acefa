"""Versioned model folders: the fitted pipeline plus a metadata file."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

METADATA_SCHEMA = "name string, metrics map<string,double>, selected_features array<string>, created_at string"


def save_model(
    spark: SparkSession,
    base: str,
    name: str,
    model: PipelineModel,
    metrics: Mapping[str, float],
    selected_features: Sequence[str] | None = None,
    result_name: str | None = None,
) -> str:
    """Write ``<base>/<name>_<YYYYmmdd_HHMMSS>_<6 hex>/{pipeline,metadata.json}``; return the folder."""
    created = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    folder = f"{base}/{name}_{created}_{uuid.uuid4().hex[:6]}"
    model.write().save(f"{folder}/pipeline")
    row = (result_name or name, {k: float(v) for k, v in metrics.items()}, list(selected_features or []), created)
    spark.createDataFrame([row], METADATA_SCHEMA).coalesce(1).write.json(f"{folder}/metadata.json")
    return folder


def load_model(folder: str) -> PipelineModel:
    """Read a stored pipeline; a missing folder is FileNotFoundError."""
    try:
        return PipelineModel.load(f"{folder}/pipeline")
    except Exception as err:  # the reader surfaces a missing path in several exception types
        text = str(err)
        if any(m in text for m in ("PATH_NOT_FOUND", "does not exist", "Input path", "empty collection")):
            raise FileNotFoundError(folder) from err
        raise


def load_metadata(spark: SparkSession, folder: str) -> DataFrame:
    try:
        return spark.read.schema(METADATA_SCHEMA).json(f"{folder}/metadata.json")
    except AnalysisException as err:
        raise FileNotFoundError(folder) from err


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Apply a fitted pipeline to new rows, batch or streaming."""
    return model.transform(df)
