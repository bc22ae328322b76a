"""Forecasting models as column expressions over ordered arrays of daily quantities.

The recurrences are folds in row order, so they are exact and stay in the JVM; a grid of settings is
columns (or exploded rows), never a loop over items. Not-a-number and infinite quantities count as 0.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# The settings that tuning may choose from, first of each the default.
SES_GRID = (0.3, 0.1, 0.2, 0.4, 0.5)
NAIVE_GRID = tuple((lag, how) for lag in (7, 1, 14) for how in ("mean_7d", "mean_3d", "last_value"))
CROSTON_GRID = tuple((a, v) for a in (0.1, 0.05, 0.2) for v in ("SBA", "classic", "TSB"))
HOLT_GRID = tuple((a, b, damped) for a in (0.3, 0.1, 0.2, 0.5) for b in (0.1, 0.05, 0.2) for damped in (True, False))
PHI = 0.95
INTERVAL_FLOOR = 1e-6
# Spread of the log-normal quantiles by pattern.
SPREAD = {"cold_start": 0.60, "intermittent": 0.50, "seasonal": 0.40, "trending": 0.35, "stable": 0.25}


def _c(x: Column | float) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def clean(q: Column) -> Column:
    """Quantities with null, NaN and infinite values as 0."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf))
    return F.transform(q, lambda x: F.when(bad(x), F.lit(0.0)).otherwise(x))


def mean(q: Column) -> Column:
    """The mean of an array; null if it is empty."""
    return F.aggregate(q, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(q), F.lit(0))


def last(q: Column, k: Column | int) -> Column:
    """The last k elements, all if there are fewer."""
    k = k if isinstance(k, Column) else F.lit(k)
    return F.slice(q, F.greatest(F.lit(1), F.size(q) - k + 1), F.greatest(k, F.lit(1)))


def naive_level(q: Column, lag: Column | int = 7, how: Column | str = "mean_7d") -> Column:
    """The mean of all rows under 7 rows; else the last value or last 3 or 7 rows' mean within the last `lag` rows."""
    how = how if isinstance(how, Column) else F.lit(how)
    recent = last(q, lag)
    size = F.when(how == "last_value", 1).when(how == "mean_3d", 3).otherwise(7)
    return F.coalesce(F.when(F.size(q) < 7, mean(q)).otherwise(mean(last(recent, size))), F.lit(0.0))


def ses_level(q: Column, alpha: Column | float = 0.3) -> Column:
    """Simple exponential smoothing from the first value; 0 for an empty array."""
    a = _c(alpha)
    return F.coalesce(F.aggregate(F.slice(q, 2, F.greatest(F.size(q), F.lit(1))), F.get(q, F.lit(0)), lambda s, y: a * y + (1 - a) * s), F.lit(0.0))


def holt_state(q: Column, alpha: Column | float = 0.3, beta: Column | float = 0.1, phi: Column | float = PHI) -> Column:
    """struct<l, t>: level and trend of Holt's method (phi 1: undamped); under two rows the mean and 0."""
    a, b, p = _c(alpha), _c(beta), _c(phi)
    first, second = F.get(q, F.lit(0)), F.get(q, F.lit(1))

    def step(s: Column, y: Column) -> Column:
        level = a * y + (1 - a) * (s["l"] + p * s["t"])
        return F.struct(level.alias("l"), (b * (level - s["l"]) + (1 - b) * p * s["t"]).alias("t"))

    run = F.aggregate(F.slice(q, 3, F.greatest(F.size(q), F.lit(1))), F.struct(first.alias("l"), (second - first).alias("t")), step)
    short = F.struct(F.coalesce(mean(q), F.lit(0.0)).alias("l"), F.lit(0.0).alias("t"))
    return F.when(F.size(q) < 2, short).otherwise(run)


def holt_total(state: Column, days: Column | int, phi: Column | float = PHI) -> Column:
    """The forecast of the next `days` days together; no day is below 0."""
    p = _c(phi)
    days = days if isinstance(days, Column) else F.lit(days)

    def day(s: Column, k: Column) -> Column:
        reach = s["g"] + F.pow(p, k)
        return F.struct(reach.alias("g"), (s["x"] + F.greatest(F.lit(0.0), state["l"] + state["t"] * reach)).alias("x"))

    return F.aggregate(F.sequence(F.lit(1), days), F.struct(F.lit(0.0).alias("g"), F.lit(0.0).alias("x")), day, lambda s: s["x"])


def croston_rate(q: Column, alpha: Column | float = 0.1, variant: Column | str = "SBA") -> Column:
    """Units per day by Croston's method ("classic", "SBA" or "TSB"); under two sales, exponential smoothing at 0.3."""
    a = _c(alpha)
    v = variant if isinstance(variant, Column) else F.lit(variant)
    sales = F.filter(F.transform(q, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda e: e["x"] > 0)
    one = F.get(sales, F.lit(0))
    rest = F.slice(sales, 2, F.greatest(F.size(sales), F.lit(1)))
    start = F.struct(one["x"].alias("z"), F.lit(1.0).alias("w"), one["i"].alias("i"))
    done = F.aggregate(rest, start, lambda s, e: F.struct((a * e["x"] + (1 - a) * s["z"]).alias("z"), (a * (e["i"] - s["i"]).cast("double") + (1 - a) * s["w"]).alias("w"), e["i"].alias("i")))
    rate = done["z"] / F.greatest(done["w"], F.lit(INTERVAL_FLOOR))
    rate = F.when(v == "SBA", rate * (1 - a / 2)).otherwise(rate)
    days = F.slice(q, one["i"] + 2, F.greatest(F.size(q), F.lit(1)))
    begin = F.struct(one["x"].alias("z"), F.when(one["i"] > 0, 1 / (one["i"] + 1).cast("double")).otherwise(F.lit(1.0)).alias("p"))
    hit = lambda x: F.when(x > 0, F.lit(1.0)).otherwise(F.lit(0.0))
    tsb = F.aggregate(days, begin, lambda s, x: F.struct(F.when(x > 0, a * x + (1 - a) * s["z"]).otherwise(s["z"]).alias("z"), (a * hit(x) + (1 - a) * s["p"]).alias("p")))
    return F.when(F.size(sales) < 2, ses_level(q, 0.3)).when(v == "TSB", tsb["z"] * tsb["p"]).otherwise(rate)


def residuals(q: Column, level: Column | None = None, alpha: float = 0.3, keep: int = 30) -> Column:
    """The last `keep` differences between rows and their fitted values: a constant level, or one-step smoothing."""
    if level is not None:
        return F.transform(last(q, keep), lambda y: y - level)
    fitted = F.aggregate(
        q,
        F.struct(F.get(q, F.lit(0)).alias("s"), F.array().cast("array<double>").alias("r")),
        lambda a, y: F.struct((alpha * y + (1 - alpha) * a["s"]).alias("s"), last(F.concat(a["r"], F.array(y - a["s"])), keep).alias("r")),
        lambda a: a["r"],
    )
    return fitted


def spread_quantiles(n: int = 1000, seed: int = 42) -> dict[str, tuple[float, float, float]]:
    """The factors of p50, p80 and p90 on a point forecast, by pattern: percentiles of a seeded log-normal sample."""
    out = {}
    for pattern, factor in {**SPREAD, "": 0.50}.items():
        s = np.random.default_rng(seed).lognormal(mean=0.0, sigma=math.log(1 + factor), size=n)
        out[pattern] = tuple(float(np.percentile(s, p)) for p in (50, 80, 90))
    return out


def resample_counts(n: int = 1000, seed: int = 42, least: int = 3, most: int = 30) -> dict[int, list[int]]:
    """How often each of k residuals is drawn by the seeded bootstrap, for k from `least` to `most`."""
    return {k: np.bincount(np.random.default_rng(seed).integers(0, k, n), minlength=k).tolist() for k in range(least, most + 1)}


#: The places (from 0) of the 1000 sorted samples that p50, p80 and p90 read, with the weight of the second.
PLACES = tuple((int(share * 999), min(int(share * 999) + 1, 999), share * 999 - int(share * 999)) for share in (0.5, 0.8, 0.9))


def order_statistics(res: Column) -> Column:
    """array<double>: the residuals at both places of each quantile in the seeded bootstrap sample; null under three residuals.

    The draw of a seeded bootstrap depends only on the number of residuals, so it is a table of counts; the
    sample is the sorted residuals repeated by it.
    """
    counts = resample_counts()
    table = F.create_map(*[x for k, c in counts.items() for x in (F.lit(k), F.expr("array(" + ",".join(map(str, c)) + ")"))])
    drawn = F.element_at(table, F.least(F.size(res), F.lit(30)))
    pairs = F.sort_array(F.zip_with(last(res, 30), drawn, lambda r, c: F.struct(r.alias("v"), c.alias("c"))))
    wanted = [k for lo, hi, _ in PLACES for k in (lo, hi)]
    none = F.lit(None).cast("double")

    def step(s: Column, e: Column) -> Column:
        upto = s["n"] + e["c"]
        return F.struct(upto.alias("n"), *[F.coalesce(s[f"s{k}"], F.when(upto > k, e["v"])).alias(f"s{k}") for k in dict.fromkeys(wanted)])

    zero = F.struct(F.lit(0).alias("n"), *[none.alias(f"s{k}") for k in dict.fromkeys(wanted)])
    found = F.aggregate(pairs, zero, step, lambda s: F.array(*[s[f"s{k}"] for k in wanted]))
    return F.when(F.coalesce(F.size(res), F.lit(0)) >= 3, found)


def quantiles_from(point: Column, stats: Column, pattern: Column) -> Column:
    """struct<mean, p50, p80, p90> about a point, from `order_statistics`; log-normal factors by pattern where that is null."""
    p = F.greatest(F.lit(0.0), point)
    factors = spread_quantiles()
    log = lambda k: p * F.coalesce(F.element_at(F.create_map(*[x for name, f in factors.items() for x in (F.lit(name), F.lit(f[k]))]), pattern), F.lit(factors[""][k]))
    at = lambda k: F.greatest(F.lit(0.0), p + F.get(stats, F.lit(k)))
    drawn = [at(2 * k) + (at(2 * k + 1) - at(2 * k)) * F.lit(w) for k, (_, _, w) in enumerate(PLACES)]
    q = [F.when(p == 0, F.lit(0.0)).when(stats.isNull(), log(k)).otherwise(drawn[k]) for k in range(3)]
    return F.struct(p.alias("mean"), F.least(*q).alias("p50"), F.greatest(F.least(q[0], q[1]), F.least(q[1], q[2]), F.least(q[0], q[2])).alias("p80"), F.greatest(*q).alias("p90"))


def bootstrap_quantiles(point: Column, res: Column, pattern: Column) -> Column:
    """struct<mean, p50, p80, p90>: resampled residuals about a point, or log-normal factors under three residuals."""
    return quantiles_from(point, order_statistics(res), pattern)
