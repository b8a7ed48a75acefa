"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.shared import stash


def _mark(edges: DataFrame) -> tuple:
    wide = [F.sum(F.col(c).cast("decimal(20,0)")) for c in ("a", "b")]  # sums of hashed ids exceed a long
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), *wide).first()
    return tuple(row)


def _to_minimum(edges: DataFrame, symmetric: bool) -> DataFrame:
    """Point each node's neighbours at the smallest node around it. The minimum is combined map-side and
    written, so that the join has two plain shuffles and a hub's rows can be split at run time."""
    if symmetric:  # large star: all neighbours count, larger ones move
        around = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stash(around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "cc-low")
        moved = around.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # small star: a > b, smaller neighbours and the node itself move
        low = stash(edges.groupBy("a").agg(F.min("b").alias("m")), "cc-low")
        both = edges.join(low, "a")
        moved = both.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b"))
        )
    return stash(moved.where("a <> b").distinct(), "cc-edges")


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) links of long ids -> (id, component): every id that is linked to a smaller one through any
    path, with the smallest id it reaches. Ids that are absent are their own component. Null ends, loops and
    repeated links are ignored; an empty table gives an empty one."""
    links = edges.where("a is not null and b is not null and a <> b")
    now = stash(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-edges")
    seen = _mark(now)
    while seen[0]:
        now = _to_minimum(_to_minimum(now, True), False)
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
