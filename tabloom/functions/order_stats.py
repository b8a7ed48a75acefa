"""Exact order statistics and quantiles of many expressions at once.

``percentile`` keeps a value -> count map of everything it sees in one task, which is
fine for a bounded number of rows only.  Beyond :data:`EXACT_ROWS` the wanted ranks are
narrowed first: a bounded sketch gives a bracket around each rank, one scan counts the
rows below and inside all brackets, and this repeats until a bracket holds few rows or
a single value.  NaN counts as null, at every size.  Only bracket ends and counts (one row per scan) reach the driver, no
shuffle of raw rows takes place, and the answer is exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.scalars import nan_to_null

EXACT_ROWS = 200_000
FEW_VALUES = 10_000
SKETCH_ACCURACY = 10_000


def _rank_points(n: int, probs: Sequence[float]) -> list[int]:
    points: set[int] = set()
    for p in probs:
        pos = (n - 1) * p
        points.update((math.floor(pos) + 1, math.ceil(pos) + 1))
    return sorted(points)


def _interpolate(n: int, p: float, at: Mapping[int, float]) -> float:
    pos = (n - 1) * p
    low, high = math.floor(pos), math.ceil(pos)
    if low == high:
        return at[low + 1]
    return at[low + 1] * (high - pos) + at[high + 1] * (pos - low)


def order_statistics(
    df: DataFrame,
    exprs: Mapping[str, Column],
    ranks: Callable[[str, int], Sequence[int]],
    exact_rows: int | None = None,
) -> dict[str, tuple[int, dict[int, float]]]:
    """``{name: (n_non_null, {rank: value})}`` for 1-based ranks of each double expression."""
    exact_rows = EXACT_ROWS if exact_rows is None else exact_rows
    names = list(exprs)
    if not names:
        return {}
    work = df.select(*[nan_to_null(exprs[c].cast("double")).alias(f"x{i}") for i, c in enumerate(names)])
    counts = work.agg(*[F.count(f"x{i}").alias(f"x{i}") for i in range(len(names))]).first()
    found: dict[str, dict[int, float]] = {c: {} for c in names}
    # open targets: (column index, rank) -> (low, high, rows in bracket, rows below bracket)
    todo: dict[tuple[int, int], tuple[float, float, int, int]] = {}
    for i, c in enumerate(names):
        for r in ranks(c, counts[i]):
            if 1 <= r <= counts[i]:
                todo[(i, r)] = (-math.inf, math.inf, counts[i], 0)
    while todo:
        small = {t: b for t, b in todo.items() if b[2] <= exact_rows}
        large = {t: b for t, b in todo.items() if b[2] > exact_rows}
        if small:
            for t, v in _finish(work, small).items():
                found[names[t[0]]][t[1]] = v
        todo = {}
        for t, b in (_narrow(work, large) if large else {}).items():
            if b[0] == b[1]:
                found[names[t[0]]][t[1]] = b[0]
            else:
                todo[t] = b
    return {c: (counts[i], found[c]) for i, c in enumerate(names)}


def _inside(i: int, low: float, high: float) -> Column:
    x = F.col(f"x{i}")
    inside = F.lit(True)
    if low > -math.inf:
        inside = inside & (x >= F.lit(low))
    if high < math.inf:
        inside = inside & (x <= F.lit(high))
    return F.when(inside, x)


def _by_bracket(targets):
    grouped: dict[tuple[int, float, float], list[tuple[int, int]]] = {}
    for t, b in targets.items():
        grouped.setdefault((t[0], b[0], b[1]), []).append(t)
    return grouped


def _finish(work: DataFrame, targets) -> dict[tuple[int, int], float]:
    """Exact values where every bracket is known to hold at most EXACT_ROWS rows."""
    grouped = _by_bracket(targets)
    cells = F.array(
        *[F.struct(F.lit(j).alias("j"), _inside(i, low, high).alias("x")) for j, (i, low, high) in enumerate(grouped)]
    )
    # one group per bracket: rows outside every bracket end here, brackets are sorted in different tasks
    lists = work.select(F.inline(cells)).where(F.col("x").isNotNull()).groupBy("j").agg(F.array_sort(F.collect_list("x")).alias("s"))
    ranks = F.create_map(
        *[e for j, ts in enumerate(grouped.values()) for e in (F.lit(j), F.array(*[F.lit(t[1] - targets[t][3]) for t in ts]))]
    )
    rows = lists.select("j", F.transform(F.element_at(ranks, F.col("j")), lambda r: F.element_at(F.col("s"), r)).alias("v")).collect()
    picked = {r["j"]: r["v"] for r in rows}
    return {t: picked[j][k] for j, ts in enumerate(grouped.values()) for k, t in enumerate(ts)}


def _narrow(work: DataFrame, targets):
    """One sketch scan proposes tighter brackets, one counting scan proves them."""
    grouped = _by_bracket(targets)
    cols, probs = [], []
    for j, ((i, low, high), ts) in enumerate(grouped.items()):
        inside = targets[ts[0]][2]
        wanted: list[float] = []
        for t in ts:
            p = (t[1] - targets[t][3]) / inside
            wanted += [max(0.0, p - 2 / SKETCH_ACCURACY), min(1.0, p + 2 / SKETCH_ACCURACY)]
        probs.append(wanted)
        cols.append(
            F.percentile_approx(_inside(i, low, high), F.array(*map(F.lit, wanted)), SKETCH_ACCURACY).alias(f"a{j}")
        )
    sketch = work.agg(*cols).first()
    proposal, count_cols = [], []
    for j, ((i, low, high), ts) in enumerate(grouped.items()):
        for k, t in enumerate(ts):
            lo = low if probs[j][2 * k] == 0.0 else sketch[j][2 * k]
            hi = high if probs[j][2 * k + 1] == 1.0 else sketch[j][2 * k + 1]
            m = len(proposal)
            proposal.append((t, lo, hi))
            x = F.col(f"x{i}")
            below = F.count_if(x < F.lit(lo)) if lo > -math.inf else F.lit(0).cast("bigint")
            count_cols += [below.alias(f"b{m}"), F.count(_inside(i, lo, hi)).alias(f"n{m}")]
    row = work.agg(F.count(F.lit(1)), *count_cols).first()
    out = {}
    for m, (t, lo, hi) in enumerate(proposal):
        below, inside = row[f"b{m}"], row[f"n{m}"]
        if below < t[1] <= below + inside and (lo, hi) != targets[t][:2]:
            out[t] = (lo, hi, inside, below)
        else:  # the sketch missed: split the old bracket at the proven end instead
            old_lo, old_hi, old_in, old_below = targets[t]
            if t[1] <= below:
                out[t] = (old_lo, lo, below - old_below + 1, old_below)
            else:
                out[t] = (hi, old_hi, old_in, below)
            raise_if_stuck(out[t], targets[t])
            out[t] = _recount(work, t, out[t])
    return out


def _recount(work: DataFrame, t, bracket):
    x = F.col(f"x{t[0]}")
    row = work.agg(
        F.count_if(x < F.lit(bracket[0])).alias("b"), F.count(_inside(t[0], bracket[0], bracket[1])).alias("n")
    ).first()
    return bracket[0], bracket[1], row["n"], row["b"]


def raise_if_stuck(new, old) -> None:
    if new[:2] == old[:2] or new[2] > old[2]:
        raise ValueError(f"quantile bracket {new[:2]} cannot be narrowed")


def exact_quantiles(
    df: DataFrame,
    exprs: Mapping[str, Column],
    probs: Sequence[float],
    rows: int | None = None,
    exact_rows: int | None = None,
    distinct: Mapping[str, int] | None = None,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles (pandas ``quantile``) of many expressions.

    ``rows`` may carry a row count the caller already knows: within the bound a single
    ``percentile`` aggregation answers everything.  ``distinct`` may carry numbers of distinct
    values: an expression of at most ``FEW_VALUES`` is answered from its counted values.
    """
    if not exprs:
        return {}
    limit = EXACT_ROWS if exact_rows is None else exact_rows
    rows = df.count() if rows is None else rows
    names = list(exprs)
    if rows <= limit:
        arr = F.array(*[F.lit(float(p)) for p in probs])
        row = df.agg(*[F.percentile(nan_to_null(exprs[c].cast("double")), arr).alias(f"q{i}") for i, c in enumerate(names)]).first()
        return {c: list(row[i]) if row[i] is not None else [None] * len(probs) for i, c in enumerate(names)}
    few = [c for c in names if distinct is not None and distinct.get(c, FEW_VALUES + 1) <= FEW_VALUES]
    many = {c: exprs[c] for c in names if c not in few}
    stats = order_statistics(df, many, lambda _c, n: _rank_points(n, probs) if n else [], exact_rows)
    found = {c: [_interpolate(n, p, at) if n else None for p in probs] for c, (n, at) in stats.items()}
    return {**found, **counted_quantiles(df, {c: exprs[c] for c in few}, probs)}


def counted_quantiles(df: DataFrame, exprs: Mapping[str, Column], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """The same quantiles where every expression has few distinct values: these are counted map-side, the counts answer."""
    if not exprs:
        return {}
    names = list(exprs)
    cols = [nan_to_null(exprs[c].cast("double")).alias(f"x{i}") for i, c in enumerate(names)]
    long = df.select(*cols).unpivot([], [f"x{i}" for i in range(len(names))], "c", "x").where(F.col("x").isNotNull())
    counts = long.groupBy("c", "x").agg(F.count(F.lit(1)).alias("n"))
    arr = F.array(*[F.lit(float(p)) for p in probs])
    told = {r["c"]: list(r["q"]) for r in counts.groupBy("c").agg(F.percentile("x", arr, F.col("n")).alias("q")).collect()}
    return {c: told.get(f"x{i}", [None] * len(probs)) for i, c in enumerate(names)}
