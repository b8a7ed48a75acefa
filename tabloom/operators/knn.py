"""Exact k nearest neighbours as a partitioned join with distance bounds.

Rows of both sides are assigned to the nearest of a bounded set of pivots.  Per training
cell only (count, distance range) by ring is kept; from these, the triangle inequality
gives each query cell a radius that must hold k neighbours, and a ring is sent to a
query cell only if it can reach inside that radius.  A (cell, ring) pair is cut into
blocks of bounded size by row hash, each block pair is a numpy product in slices in a task that
emits at most k rows per query, and partial results merge per query.  No pair of rows
is ever materialised and a crowded cell spreads over many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIVOTS, RINGS = 64, 8
BLOCK_ROWS = 2048
BLOCK_MOST, BLOCK_CELLS = 1 << 15, 1 << 21  # rows and numbers that a block never exceeds, except for its least rows
BLOCKS = 8  # blocks of a side aimed at: every block of one side is a copy of the other
BLOCK_SLICE = 1024  # queries compared by key at a time
QUERY_SLICE = 64  # queries per matrix product
ROUNDING = 1e-9  # relative slack of squared distances from products
MERGE_BLOCKS = 64


def _pivots(train: DataFrame, vector: str) -> np.ndarray:
    rows = train.select(F.col(vector).cast("array<double>").alias("v")).orderBy(F.xxhash64(vector)).limit(PIVOTS).collect()
    return np.unique(np.array([r["v"] for r in rows], dtype=float), axis=0)


def _assign(df: DataFrame, key: str, vector: str, pivots: np.ndarray, extra: Sequence[str]) -> DataFrame:
    """``key, extra, v, cell, dist``: the nearest pivot and the distance to it."""
    types = dict(df.dtypes)
    shared = df.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = shared.value
        for pdf in batches:
            if len(pdf):
                m = _matrix(pdf["v"])
                d = np.concatenate([_all_distances(m[i : i + 256], p) for i in range(0, len(m), 256)])
                pdf["cell"], pdf["dist"] = d.argmin(axis=1).astype("int32"), d.min(axis=1)
            else:
                pdf["cell"], pdf["dist"] = pd.Series([], dtype="int32"), pd.Series([], dtype=float)
            yield pdf

    # single-precision vectors travel as such: widening them in the task gives the same numbers
    kind = types[vector] if types[vector] == "array<float>" else "array<double>"
    schema = ", ".join(f"`{c}` {types[c]}" for c in (key, *extra)) + f", v {kind}, cell int, dist double"
    return df.select(key, *extra, F.col(vector).cast(kind).alias("v")).mapInPandas(run, schema)


def _matrix(s: pd.Series) -> np.ndarray:
    return np.stack(s.to_numpy()).astype(float)


def _distances(x: np.ndarray, others: np.ndarray) -> np.ndarray:
    diff = others - x
    return np.sqrt(np.einsum("ij,ij->i", diff, diff))


def _all_distances(x: np.ndarray, others: np.ndarray) -> np.ndarray:
    diff = x[:, None, :] - others[None, :, :]
    return np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))


def _plan(stats: list, radii: dict[int, float], pivots: np.ndarray, k: int, drop_self: bool) -> list[tuple[int, int, int]]:
    """(query cell, train cell, ring) triples that may hold neighbours; at most PIVOTS^2 x RINGS rows."""
    need = k + (1 if drop_self else 0)
    out = []
    for qc, u in radii.items():
        gap = _distances(pivots[qc], pivots)
        reach = sorted((u + gap[s["cell"]] + s["hi"], s["n"]) for s in stats)
        total, theta = 0, math.inf
        for bound, n in reach:
            total += n
            if total >= need:
                theta = bound
                break
        for s in stats:
            lower = max(0.0, gap[s["cell"]] - u - s["hi"], s["lo"] - gap[s["cell"]] - u)
            if lower <= theta * (1 + 1e-9):
                out.append((qc, s["cell"], s["ring"]))
    return out


def _nearest(q: np.ndarray, t: np.ndarray, k: int, same: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query row, training row and distance of the ``k`` nearest training rows of each query; ties by position.

    A matrix product per slice of queries proposes every row within rounding of the k-th, and only these get their
    distance from differences.
    """
    tt, found = np.einsum("ij,ij->i", t, t), []
    for lo in range(0, len(q), QUERY_SLICE):
        part = q[lo : lo + QUERY_SLICE]
        size = np.einsum("ij,ij->i", part, part)
        rough = size[:, None] + tt[None, :] - 2.0 * (part @ t.T)
        if same is not None:
            rough[same[lo : lo + QUERY_SLICE]] = np.inf
        kth = np.partition(rough, min(k, len(t)) - 1, axis=1)[:, min(k, len(t)) - 1]
        limit = kth + ROUNDING * (size + tt.max())
        qi, ti = np.nonzero((rough <= limit[:, None]) & np.isfinite(rough))
        diff = part[qi] - t[ti]
        d = np.sqrt(np.einsum("ij,ij->i", diff, diff))
        order = np.lexsort((ti, d, qi))
        qi, ti, d = qi[order], ti[order], d[order]
        place = np.arange(len(qi)) - np.searchsorted(qi, qi)
        found.append((qi[place < k] + lo, ti[place < k], d[place < k]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _blocks(n: int, size: int) -> int:
    """Blocks that ``n`` rows of ``size`` numbers are cut into: about ``BLOCKS`` while these fit, so copies grow with the rows."""
    most = max(BLOCK_ROWS, min(BLOCK_MOST, BLOCK_CELLS // max(size, 1)))
    return math.ceil(n / min(most, max(BLOCK_ROWS, math.ceil(n / BLOCKS))))


def neighbours(
    queries: DataFrame, train: DataFrame, key: str, vector: str, k: int, extra: Sequence[str] = (), drop_self: bool = False
) -> DataFrame:
    """``key, rank (1..k), neighbour, distance, extra...``: exact k nearest training rows of each query.

    ``key`` names the id on both sides; ``extra`` are training columns carried along.
    Ties in distance go to the smaller neighbour id.
    """
    spark = queries.sparkSession
    pivots = _pivots(train, vector)
    t = _assign(train, key, vector, pivots, extra)
    q = _assign(queries, key, vector, pivots, ())
    span = t.agg(F.max("dist")).first()[0] or 0.0
    width = span / RINGS or 1.0
    t = t.withColumn("ring", F.least(F.floor(F.col("dist") / F.lit(width)), F.lit(RINGS - 1)).cast("int"))
    stats = t.groupBy("cell", "ring").agg(F.count(F.lit(1)).alias("n"), F.min("dist").alias("lo"), F.max("dist").alias("hi")).collect()
    cells = q.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("u")).collect()
    triples = _plan(stats, {r["cell"]: r["u"] for r in cells}, pivots, k, drop_self)
    sizes = {(s["cell"], s["ring"]): s["n"] for s in stats}
    t_rows: dict[int, int] = {}
    for qc, c, r in triples:
        t_rows[qc] = t_rows.get(qc, 0) + sizes[(c, r)]
    blocks = [(r["cell"], _blocks(r["n"], pivots.shape[1]), _blocks(t_rows[r["cell"]], pivots.shape[1])) for r in cells]
    grid = F.broadcast(spark.createDataFrame(blocks, "qcell int, qblocks int, tblocks int"))
    plan = F.broadcast(spark.createDataFrame(triples, "qcell int, cell int, ring int"))
    # a query row visits every training block of its cell, a training row every query block
    qs = (
        q.withColumnRenamed("cell", "qcell").join(grid, "qcell")
        .withColumn("qb", F.pmod(F.xxhash64(key), F.col("qblocks")))
        .withColumn("tb", F.explode(F.sequence(F.lit(0).cast("bigint"), (F.col("tblocks") - 1).cast("bigint"))))
        .select("qcell", "qb", "tb", key, "v")
    )
    ts = (
        t.join(plan, ["cell", "ring"]).join(grid, "qcell")
        .withColumn("tb", F.pmod(F.xxhash64(key), F.col("tblocks")))
        .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("bigint"), (F.col("qblocks") - 1).cast("bigint"))))
        .select("qcell", "qb", "tb", F.col(key).alias("neighbour"), "v", *extra)
    )
    types = dict(train.dtypes)
    schema = f"`{key}` {types[key]}, tg bigint, neighbour {types[key]}, distance double" + "".join(f", `{e}` {types[e]}" for e in extra)

    def block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({key: [], "tg": [], "neighbour": [], "distance": [], **{e: [] for e in extra}})
        if not len(left) or not len(right):
            return empty
        right = right.sort_values("neighbour")
        q, t, names, others = _matrix(left["v"]), _matrix(right["v"]), left[key].to_numpy(), right["neighbour"].to_numpy()
        found = []
        for lo in range(0, len(q), BLOCK_SLICE):
            same = (names[lo : lo + BLOCK_SLICE, None] == others[None, :]) if drop_self else None
            qi, ti, d = _nearest(q[lo : lo + BLOCK_SLICE], t, k, same)
            found.append((qi + lo, ti, d))
        qi, ti, d = (np.concatenate(x) for x in zip(*found))
        out = right.iloc[ti][["neighbour", *extra]].copy()
        out["distance"], out[key], out["tg"] = d, names[qi], int(left["tb"].iloc[0]) // MERGE_BLOCKS
        return out[[key, "tg", "neighbour", "distance", *extra]]

    partial = qs.groupBy("qcell", "qb", "tb").cogroup(ts.groupBy("qcell", "qb", "tb")).applyInPandas(block, schema)
    entry = F.struct("distance", "neighbour", *extra)
    best = F.slice(F.array_sort(F.collect_list(entry)), 1, k).alias("top")
    if max((b[2] for b in blocks), default=0) > MERGE_BLOCKS:
        # many training blocks: merge MERGE_BLOCKS of them at a time, then the survivors
        tier = partial.groupBy(key, "tg").agg(best).select(key, F.inline("top"))
        partial = tier
    merged = partial.groupBy(key).agg(best)
    return merged.select(key, F.posexplode("top").alias("_p", "_n")).select(
        key, (F.col("_p") + 1).alias("rank"), F.col("_n.neighbour").alias("neighbour"), F.col("_n.distance").alias("distance"),
        *[F.col(f"_n.{e}").alias(e) for e in extra],
    )


def _weight(weights: str):
    return F.lit(1.0) if weights == "uniform" else 1.0 / F.greatest("distance", F.lit(1e-12))


def classify(queries: DataFrame, train: DataFrame, key: str, vector: str, label: str, k: int = 5, weights: str = "uniform", drop_self: bool = False) -> DataFrame:
    """``key, prediction``: the label with the largest vote, ties to the smallest label."""
    n = neighbours(queries, train, key, vector, k, [label], drop_self)
    votes = n.groupBy(key, label).agg(F.sum(_weight(weights)).alias("w"))
    return votes.groupBy(key).agg(F.min_by(F.col(label), F.struct((-F.col("w")).alias("w"), F.col(label).alias("l"))).alias("prediction"))


def regress(queries: DataFrame, train: DataFrame, key: str, vector: str, label: str, k: int = 5, weights: str = "uniform", drop_self: bool = False) -> DataFrame:
    """``key, prediction``: the (weighted) mean label of the neighbours."""
    n = neighbours(queries, train, key, vector, k, [label], drop_self).withColumn("_w", _weight(weights))
    return n.groupBy(key).agg((F.sum(F.col(label) * F.col("_w")) / F.sum("_w")).alias("prediction"))


def impute(df: DataFrame, key: str, column: str, predictors: Sequence[str], k: int = 5) -> DataFrame:
    """Fill ``column`` with the mean over the k nearest rows (by ``predictors``) that have it."""
    vec = df.withColumn("_v", F.array(*[F.col(p).cast("double") for p in predictors]))
    known = vec.where(F.col(column).isNotNull()).select(key, "_v", F.col(column).cast("double").alias("_y"))
    gaps = vec.where(F.col(column).isNull()).select(key, "_v")
    if gaps.isEmpty():
        return df
    filled = regress(gaps, known, key, "_v", "_y", k).withColumnRenamed("prediction", "_fill")
    return df.join(filled, key, "left").withColumn(column, F.coalesce(F.col(column).cast("double"), F.col("_fill"))).drop("_fill")
