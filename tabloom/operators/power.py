"""Distribution transforms: log, log1p, sqrt, Yeo-Johnson and Box-Cox with likelihood lambda."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.profile import ident
from tabloom.operators.scale import learn_scaler, scaled

LAMBDA_RANGE = 5
FIXED = {
    "none": lambda c: c,
    "log": lambda c: F.when(c > 0, F.ln(c)),
    "log1p": lambda c: F.when(c > -1, F.log1p(c)),
    "sqrt": lambda c: F.when(c >= 0, F.sqrt(c)),
}
POWER = ("yeo_johnson", "box_cox")
SCALER_ALIASES = {"standard": "standard", "robust": "robust", "minmax": "min_max_scaler"}


def yeo_johnson(c: Column, lam: float) -> Column:
    c = c.cast("double")
    up = F.log1p(F.greatest(c, F.lit(0.0)))
    down = F.log1p(F.greatest(-c, F.lit(0.0)))
    right = up if abs(lam) < 1e-12 else (F.exp(up * lam) - 1) / F.lit(lam)
    left = -down if abs(lam - 2) < 1e-12 else -(F.exp(down * (2 - lam)) - 1) / F.lit(2 - lam)
    return F.when(c >= 0, right).otherwise(left)


def box_cox(c: Column, lam: float) -> Column:
    log = F.ln(F.when(c > 0, c.cast("double")))
    return log if abs(lam) < 1e-12 else (F.exp(log * lam) - 1) / F.lit(lam)


_TRANSFORM = {"yeo_johnson": yeo_johnson, "box_cox": box_cox}


def fit_lambdas(df: DataFrame, kind: str, exprs: Mapping[str, Column], digits: int = 3) -> dict[str, float]:
    """Maximum-likelihood lambda per expression, to ``digits`` decimals.

    A decimal grid search without outer bounds (a best candidate at an end widens the whole-number grid): each pass scores about twenty candidates of every column in
    one aggregation and zooms in by ten, so a fit costs ``digits + 1`` scans and no shuffle
    of rows.
    """
    names = list(exprs)
    if kind == "box_cox" and names:
        low = df.agg(*[F.min(exprs[c]) for c in names]).first()
        bad = [c for i, c in enumerate(names) if low[i] is not None and low[i] <= 0]
        if bad:
            raise ValueError(f"box_cox needs strictly positive values: {bad}")
    best = {c: 0.0 for c in names}
    if not names:
        return best
    work = df.select(*[exprs[c].cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    log = "signum({0}) * log1p(abs({0}))" if kind == "yeo_johnson" else "ln(case when {0} > 0 then {0} end)"
    base = work.agg(*[F.expr(e) for i in range(len(names)) for e in (f"count(x{i})", f"sum({log.format(f'x{i}')})")]).first()
    formula = _YEO_JOHNSON if kind == "yeo_johnson" else _BOX_COX
    grids = [(0, names)]
    while grids:
        digit, own = grids.pop(0)
        reach, step = (LAMBDA_RANGE if digit == 0 else 10), 10.0**-digit
        grid = {c: [round(best[c] + k * step, digit) for k in range(-reach, reach + 1)] for c in own}
        # every value meets its own column's candidates; partial aggregation keeps one row per candidate
        cells = [
            f"transform(array({', '.join(f'{lam!r}d' for lam in grid[c])}), l -> struct({i} as i, l as lam, x{i} as x))"
            for i, c in enumerate(names)
            if c in grid
        ]
        long = work.select(F.expr(f"inline(concat({', '.join(cells)}))"))
        scored = long.groupBy("i", "lam").agg(F.var_pop(F.expr(formula)).alias("v")).collect()
        at_end = []
        for i, c in enumerate(names):
            if c not in grid:
                continue
            var = {r["lam"]: r["v"] for r in scored if r["i"] == i}
            like = {lam: _loglik(base[2 * i], base[2 * i + 1], var.get(lam), lam) for lam in grid[c]}
            best[c] = max(grid[c], key=lambda lam: (like[lam], -lam))
            if digit == 0 and best[c] in (grid[c][0], grid[c][-1]) and like[best[c]] > -math.inf:
                at_end.append(c)
        if at_end:  # go on around the end that won
            grids.append((0, at_end))
        elif digit < digits:
            grids.append((digit + 1, names))
    return best


_YEO_JOHNSON = """case
  when x >= 0 and lam = 0 then log1p(x)
  when x >= 0 then (exp(log1p(x) * lam) - 1) / lam
  when lam = 2 then -log1p(-x)
  else -(exp(log1p(-x) * (2 - lam)) - 1) / (2 - lam) end"""
# the constant -1 / lam does not change the variance; without it nothing cancels
_BOX_COX = "case when lam = 0 then ln(x) else exp(ln(x) * lam) / lam end"


def _loglik(n: float, jac: float | None, var: float | None, lam: float) -> float:
    if not n or jac is None or not var or not math.isfinite(var):
        return -math.inf
    return -n / 2 * math.log(var) + (lam - 1) * jac


def transform_expr(kind: str, c: Column, lam: float | None = None) -> Column:
    if kind in FIXED:
        return FIXED[kind](c.cast("double"))
    return _TRANSFORM[kind](c, lam)


def power_transform(
    df: DataFrame, kind: str, columns: Sequence[str], digits: int = 3, lams: Mapping[str, float] | None = None
) -> DataFrame:
    """Yeo-Johnson or Box-Cox at the likelihood (or a given) lambda, then z-scored."""
    if lams is None:
        lams = fit_lambdas(df, kind, {c: ident(c) for c in columns}, digits)
    exprs = {c: _TRANSFORM[kind](ident(c), lams[c]) for c in columns}
    z = learn_scaler(df, "standard", exprs)
    return df.withColumns({c: scaled(exprs[c], *z[c]) for c in columns})


def transform(df: DataFrame, kind: str, columns: Sequence[str]) -> DataFrame:
    """Any distribution step by name; scalers are accepted, unknown names leave the data as is."""
    if kind in FIXED:
        return df.withColumns({c: FIXED[kind](ident(c).cast("double")) for c in columns})
    if kind in POWER:
        return power_transform(df, kind, columns)
    if kind in SCALER_ALIASES:
        from tabloom.operators.scale import scale

        return scale(df, SCALER_ALIASES[kind], columns)
    return df
