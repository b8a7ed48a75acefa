"""What the operators of this subpackage share: scratch tables, folds, labels, text batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local master (tests, a laptop) gets a temporary folder; a cluster is refused,
    because executors do not see the driver's disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="tabloom-")
    return _OWN[app]


def stash(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as a table of the shared folder and read it back: lineage ends, lost executors cost nothing.
    ``by``: a column of few values to lay the table out by, so that reading one value skips the rest."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as the empty text, whose remainder is 0."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5).cast("int")


def one_label(labels: DataFrame, id_col: str, label: str) -> DataFrame:
    """One 0/1 label per id as ``label``: the majority of its non-null rows, 1 at a tie; rows without id go."""
    return (
        labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(id_col).alias("_label_id"))
        .agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("_label"))
    )


def training_labels(labels: DataFrame, id_col: str, label: str, most: int) -> DataFrame:
    """(_label_id, _label) of the ids whose fold is not 0: all of them, or about ``most`` chosen by a hash of the id.
    So bounded, the table is broadcast and training texts are not shuffled."""
    known = stash(one_label(labels, id_col, label).where(fold(F.col("_label_id")) != 0), "labels")
    n = known.count()
    if n > most:
        known = known.where(F.pmod(F.xxhash64("_label_id"), F.lit(1_000_000)) < int(950_000 * most / n))
    return F.broadcast(known)


def binaries(texts: pa.Array) -> list[bytes]:
    """UTF-8 of each text of an Arrow batch; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    return [b or b"" for b in texts.cast(kind).to_pylist()]


def star_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between ids as one edge per id: (id, smallest id it reaches through these links)."""
    ids, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = where[: len(a)], where[len(a) :]
    low = np.arange(len(ids))
    while True:
        before = low.copy()
        np.minimum.at(low, i, low[j])
        np.minimum.at(low, j, low[i])
        low = low[low]
        if np.array_equal(low, before):
            break
    moved = low != np.arange(len(ids))
    return ids[moved], ids[low[moved]]


def sum_cells(rows: DataFrame, width: int) -> np.ndarray:
    """Sum rows (r int, v array<double>) by r into a matrix; rows and width are model sizes, not data sizes."""
    cells = (
        rows.select("r", F.posexplode("v").alias("c", "x"))
        .groupBy("r", "c")
        .agg(F.sum("x").alias("x"))
        .select(F.col("r").cast("long"), F.col("c").cast("long"), "x")
        .toArrow()
    )
    out = np.zeros((width, width))
    if cells.num_rows:
        out[cells["r"].to_numpy(), cells["c"].to_numpy()] = cells["x"].to_numpy()
    return out


def batches_of(sizes: Iterable[int], most: int) -> list[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to at most ``most`` (a single larger one stands alone)."""
    out, start, total = [], 0, 0
    n = 0
    for n, s in enumerate(sizes, 1):
        if total and total + s > most:
            out.append((start, n - 1))
            start, total = n - 1, 0
        total += s
    if n > start:
        out.append((start, n))
    return out
