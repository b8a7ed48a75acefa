"""Near-duplicate vectors by cosine: a PCA-ordered comparison in tiles that stops early.

Unit vectors are rotated onto the principal axes of the whole table, largest variance first. Two vectors of a tile
accumulate the leading dimensions; what is left of their product is at most the product of the norms of their
suffixes (Cauchy-Schwarz), so a pair is given up as soon as prefix plus bound stays below the threshold. A
prefix with its suffix norm as one more coordinate makes that bound a single matrix product. What survives is
decided by the cosine of the vectors themselves in double precision.

* Equal vectors are one node (smallest id, number of copies), so a hot group of copies is compared once.
* Vectors are dealt by hash to blocks of about ``side`` vectors and pairs of blocks are the tasks: each vector
  is shuffled once per block. Inside, tiles of vectors sorted by the first axis are skipped when their boxes
  are too far apart. The comparison is exact, so its work is quadratic in the distinct vectors in the worst case.
* A task returns one row per linked vector: how many links it has there and one star edge. No pair leaves a task.

Defined results: null, zero-length or zero vectors and those with null or non-finite components link with nothing
and are their own component; vectors of different length never link; rows that share an id are one node; a row
without id links with nothing and has no component; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.attach import attach
from tabloom.llm.components import connected_components
from tabloom.llm.shared import star_edges, stash, sum_cells

SIDE = 16_384
TILE = 1024
#: axes after which a pair is weighed up again
CHECKS = (16, 32)
#: room for rounding in the bounds; the decision itself has none
SLACK = 1e-4


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_axes(vectors: DataFrame, dim: int) -> np.ndarray:
    """Axes (columns, largest variance first) of all unit vectors; second moments are summed per partition."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            if batch.num_rows:
                x = unit(_matrix(batch.column(0), dim))
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(total.tolist())], ["r", "v"])

    total = sum_cells(vectors.select("v").mapInArrow(moments, "r int, v array<double>"), dim)
    return np.linalg.eigh(total)[1][:, ::-1]


def _prepare(x: np.ndarray, axes: np.ndarray, checks: tuple) -> tuple:
    u = unit(x)
    y = u @ axes
    order = np.argsort(y[:, 0], kind="stable")
    u, y = u[order], y[order]
    left = np.sqrt(np.maximum(0, 1 - np.cumsum(y * y, axis=1)))
    bounds = [np.concatenate([y[:, :k], left[:, k - 1 : k]], axis=1).astype(np.float32) for k in checks]
    box = [(y[t : t + TILE, :8].min(0), y[t : t + TILE, :8].max(0)) for t in range(0, len(y), TILE)]
    return order, u, bounds, box


def linked(a: tuple, b: tuple, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (in the original order) of linked pairs, tile by tile; with ``same`` each pair once."""
    (order_a, ua, bound_a, box_a), (order_b, ub, bound_b, box_b) = a, b
    reach = 2 - 2 * threshold + SLACK
    for s, (low_a, high_a) in enumerate(box_a):
        for t, (low_b, high_b) in enumerate(box_b):
            if same and t < s:
                continue
            gap = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
            if gap @ gap > reach:
                continue
            p, q = s * TILE, t * TILE
            best = bound_a[0][p : p + TILE] @ bound_b[0][q : q + TILE].T
            i, j = np.divmod(np.flatnonzero(best.ravel() >= threshold - SLACK), best.shape[1])
            i, j = i + p, j + q
            if same and s == t:
                i, j = i[i < j], j[i < j]
            for k in range(1, len(bound_a)):
                if len(i) and len(i) < best.size // 4:
                    keep = np.einsum("ij,ij->i", bound_a[k][i], bound_b[k][j]) >= threshold - SLACK
                    i, j = i[keep], j[keep]
            for part in np.array_split(np.arange(len(i)), len(i) // 200_000 + 1):
                x, y = i[part], j[part]
                near = np.einsum("ij,ij->i", ua[x], ub[y]) >= threshold
                if near.any():
                    yield order_a[x[near]], order_b[y[near]]


def _cells(axes_of, threshold: float, dim: int):
    def cell(table: pa.Table) -> pa.Table:
        axes = axes_of.value
        checks = tuple(sorted({min(k, dim) for k in CHECKS}))
        side = table["side"].to_numpy()
        same = bool(table["same"][0].as_py())
        ids, copies = table["id"].to_numpy(), table["copies"].to_numpy().astype(np.float64)
        x = _matrix(table["v"], dim)
        at = [np.flatnonzero(side == 0), np.flatnonzero(side == (0 if same else 1))]
        a = _prepare(x[at[0]], axes, checks) if len(at[0]) else None
        b = a if same else _prepare(x[at[1]], axes, checks) if len(at[1]) else None
        n, star_a, star_b = np.zeros(len(ids)), [ids[:0]], [ids[:0]]
        for i, j in linked(a, b, threshold, same) if a and b else ():
            i, j = at[0][i], at[1][j]
            n += np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
            star = star_edges(np.concatenate([star_a[-1], ids[i]]), np.concatenate([star_b[-1], ids[j]]))
            star_a, star_b = [star[0]], [star[1]]
        root = dict(zip(star_a[-1].tolist(), star_b[-1].tolist()))
        hit = np.flatnonzero(n)
        out = [ids[hit], n[hit].astype(np.int64), np.array([root.get(v, v) for v in ids[hit].tolist()], np.int64)]
        return pa.table([pa.array(c, pa.int64()) for c in out], ["id", "n", "root"])

    return cell


def near_vectors(
    table: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, side: int = SIDE
) -> DataFrame:
    """One row per vector: id (long), n_links (other vectors within reach), component_id, kept."""
    rows = table.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    sound = (
        F.col("id").isNotNull()
        & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    rows = rows.withColumn("v", F.when(F.coalesce(sound, F.lit(False)), F.col("v")))
    classes = stash(
        rows.where("v is not null").groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "pca-classes"
    )
    sizes = [(r["d"], r["n"]) for r in classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()]
    found = None
    for dim, n in sizes:  # one entry per vector length that occurs
        some = classes.where(F.size("v") == dim)
        axes = classes.sparkSession.sparkContext.broadcast(principal_axes(some, dim))
        blocks = max(1, min(-(-n // 1024), max(4, -(-n // side))))
        block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
        others = F.sequence(F.lit(0), F.lit(blocks - 1))
        spot = lambda c: F.struct(
            F.least(c, block).alias("i"), F.greatest(c, block).alias("j"), F.when(c < block, 1).otherwise(0).alias("side"), (c == block).alias("same")
        )
        cells = some.select("id", "copies", "v", F.explode(F.transform(others, spot)).alias("c")).select("c.*", "id", "copies", "v")
        part = cells.groupBy("i", "j").applyInArrow(_cells(axes, threshold, dim), "id bigint, n bigint, root bigint")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    found = stash(found, "pca-links")
    again = rows.where("v is not null").join(classes.select(F.col("id").alias("rep"), "v"), "v").where("id <> rep")
    edges = found.select(F.col("id").alias("a"), F.col("root").alias("b"))
    edges = edges.unionByName(again.select(F.col("id").alias("a"), F.col("rep").alias("b")).distinct())
    component = connected_components(edges)
    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    learned = stash(
        classes.join(links, "id", "left").join(component, "id", "left").select(
            "v", "copies", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")
        ),
        "pca-learned",
    )
    out = attach(rows, learned, ["v"], "copies")
    return out.select(
        "id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
