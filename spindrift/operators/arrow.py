"""Operators that columns cannot express: the seasonal model and the structural break search, per item in Arrow batches."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..params import HOLDOUT_ROWS, HORIZONS, MIN_POST_BREAK_ROWS

#: Settings of the seasonal model: ridge, weekly terms, multiplicative. The first is the default.
SEASONAL_GRID = tuple(itertools.product((1.0, 0.1, 10.0, 100.0), (3, 1, 2), (False, True)))


def seasonal_fit(q: np.ndarray, days: int = 365, weekly: int = 3, yearly: int = 10, ridge: float = 1.0, multiplicative: bool = False, weights: np.ndarray | None = None) -> np.ndarray:
    """Daily forecasts of a trend and Fourier model, fitted by ridge regression; never below 0.

    Additive, or multiplicative (additive in log(1 + q)). `weights`: of the rows, 1 each by default. The
    yearly terms need a year of rows, the weekly ones two weeks. A flat series forecasts its mean.
    """
    q = np.nan_to_num(np.asarray(q, dtype=float), nan=0.0, posinf=0.0, neginf=0.0)
    n = len(q)
    if n == 0:
        return np.zeros(days)
    if n < 14 or q.std() < 0.01:
        return np.full(days, max(0.0, q.mean()))
    y = np.log1p(np.maximum(q, 0.0)) if multiplicative else q
    u = np.ones(n) if weights is None else np.nan_to_num(np.asarray(weights, dtype=float), nan=1.0)

    def design(t: np.ndarray) -> np.ndarray:
        cols = [np.ones_like(t), t / n]
        for period, terms in ((7.0, weekly), (365.25, yearly if n >= 365 else 0)):
            for k in range(1, terms + 1):
                cols += [np.cos(2 * np.pi * k * t / period), np.sin(2 * np.pi * k * t / period)]
        return np.stack(cols, axis=1)

    x = design(np.arange(n, dtype=float))
    pull = ridge * np.eye(x.shape[1])
    pull[0, 0] = 0.0
    w = np.linalg.solve((x.T * u) @ x + pull, (x.T * u) @ y)
    ahead = design(np.arange(n, n + days, dtype=float)) @ w
    return np.maximum(0.0, np.expm1(np.minimum(ahead, y.max() + 1.0)) if multiplicative else ahead)


def seasonal_error(actual: np.ndarray, forecast: np.ndarray) -> float:
    """The mean relative error over the rows with demand, at most 99; 1 without any."""
    some = actual != 0
    return min(99.0, float(np.mean(np.abs((actual[some] - forecast[some]) / actual[some])))) if some.any() else 1.0


def seasonal_run(q: np.ndarray, window: int, weights: np.ndarray | None = None) -> tuple[float, list[float], list[float]]:
    """(val_mape, path, totals): the error of the best setting of the grid on the last 14 rows, its forecasts of the last `window` rows from those before, and the totals per horizon."""
    q = np.nan_to_num(np.asarray(q, dtype=float), nan=0.0, posinf=0.0, neginf=0.0)
    cut = lambda k: None if weights is None else weights[: len(q) - k]

    def fit(rows: int, days: int, g: tuple) -> np.ndarray:
        try:
            return seasonal_fit(q[: len(q) - rows], days, weekly=g[1], ridge=g[0], multiplicative=g[2], weights=cut(rows))
        except np.linalg.LinAlgError:
            return np.full(days, max(0.0, float(q[: len(q) - rows].mean())))

    held = min(HOLDOUT_ROWS, len(q))
    errors = [seasonal_error(q[len(q) - held :], fit(held, held, g)) for g in SEASONAL_GRID]
    best = SEASONAL_GRID[int(np.argmin(errors))]
    total = np.cumsum(fit(0, HORIZONS[-1], best))
    return min(errors), fit(window, window, best).tolist(), [float(total[h - 1]) for h in HORIZONS]


def seasonal_items(items: DataFrame) -> DataFrame:
    """(sku, val_mape, path, totals) of `seasonal_run` from `items` (sku, q, window, weights); weights may be null."""
    kind = items.schema["sku"].dataType.simpleString()

    def run(batches):
        for b in batches:
            rows = [(sku, *seasonal_run(q, int(k), None if w is None else np.asarray(w, dtype=float))) for sku, q, k, w in zip(b["sku"], b["q"], b["window"], b["weights"])]
            yield pd.DataFrame(rows, columns=["sku", "val_mape", "path", "totals"])

    return items.select("sku", "q", "window", "weights").mapInPandas(run, f"sku {kind}, val_mape double, path array<double>, totals array<double>")


def seasonal_forecast(series: DataFrame) -> DataFrame:
    """(sku, h7 .. h365) from `series` (sku, q): totals per horizon. A fit that fails falls back to the mean."""
    kind = series.schema["sku"].dataType.simpleString()

    def run(batches):
        for b in batches:
            rows = []
            for sku, q in zip(b["sku"], b["q"]):
                try:
                    total = np.cumsum(seasonal_fit(q))
                except np.linalg.LinAlgError:
                    total = np.cumsum(np.full(365, max(0.0, float(np.mean(q)))))
                rows.append((sku, *(float(total[h - 1]) for h in HORIZONS)))
            yield pd.DataFrame(rows, columns=["sku", *(f"h{h}" for h in HORIZONS)])

    return series.select("sku", "q").mapInPandas(run, f"sku {kind}, " + ", ".join(f"h{h} double" for h in HORIZONS))


def breaks(q: np.ndarray, sensitivity: float = 0.3, least: int = 7) -> list[int]:
    """Starts of the segments that PELT finds under an RBF kernel cost, with penalty max(1, round(3 / sensitivity)).

    The kernel is exp(-gamma (x - y)^2), gamma one over the median squared distance. The cost of rows s..e
    is their number less the mean of their kernel sums, read from summed-area sums.
    """
    q = np.nan_to_num(np.asarray(q, dtype=float))
    n = len(q)
    if n < 2 * least:
        return []
    d = (q[:, None] - q[None, :]) ** 2
    positive = d[d > 0]
    if not len(positive):
        return []
    area = np.zeros((n + 1, n + 1))
    area[1:, 1:] = np.exp(-d / np.median(positive)).cumsum(0).cumsum(1)
    penalty = max(1, round(3 / sensitivity))

    def cost(s: int, e: int) -> float:
        return (e - s) - (area[e, e] - area[s, e] - area[e, s] + area[s, s]) / (e - s)

    best, back, open_ = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=int), [0]
    best[0] = -penalty
    for e in range(least, n + 1):
        options = [(best[s] + cost(s, e) + penalty, s) for s in open_ if e - s >= least]
        if options:
            best[e], back[e] = min(options)
            open_ = [s for s in open_ if e - s < least or best[s] + cost(s, e) <= best[e]]
        if e - least + 1 >= least:
            open_.append(e - least + 1)
    out, e = [], n
    while e > 0 and back[e] > 0:
        out.append(int(back[e]))
        e = back[e]
    return out[::-1]


def structural_break(series: DataFrame, sensitivity: float = 0.3) -> DataFrame:
    """(sku, n, break_at, rows_after, state) from `series` (sku, q), over all rows of each item.

    break_at: the first row after the earliest break, null without one. state: "none", "truncated" if at
    least 30 rows follow, else "insufficient". The kernel matrix has the square of the rows, which `views.series`
    bounds at 730.
    """
    kind = series.schema["sku"].dataType.simpleString()

    def run(batches):
        for b in batches:
            out = []
            for sku, q in zip(b["sku"], b["q"]):
                q = np.asarray(q, dtype=float)
                found = breaks(q, sensitivity)
                at = found[0] if found else None
                after = len(q) - at if found else None
                out.append((sku, len(q), at, after, "none" if not found else "truncated" if after >= MIN_POST_BREAK_ROWS else "insufficient"))
            f = pd.DataFrame(out, columns=["sku", "n", "break_at", "rows_after", "state"])
            yield f.astype({"break_at": "Int64", "rows_after": "Int64"})

    return series.select("sku", "q").mapInPandas(run, f"sku {kind}, n bigint, break_at bigint, rows_after bigint, state string")
