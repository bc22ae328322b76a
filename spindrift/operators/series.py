"""Operators on ordered demand series: flags, windows, shapes, horizons, backtests and folds.

Rows are (sku, d, qty) or one array per sku. Windows count rows, not days. Everything per item runs after
a single shuffle by item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions import models as M


def rolling_mean(demand: DataFrame, rows: int, name: str) -> DataFrame:
    w = Window.partitionBy("sku").orderBy("d").rowsBetween(1 - rows, 0)
    return demand.withColumn(name, F.avg("qty").over(w))


def rolling_stats(demand: DataFrame, rows: int, least: int = 3) -> DataFrame:
    """roll_mean and sample roll_std; null and 0 where fewer than `least` rows are there."""
    w = Window.partitionBy("sku").orderBy("d").rowsBetween(1 - rows, 0)
    enough = F.count("qty").over(w) >= least
    return demand.withColumns({"roll_mean": F.when(enough, F.avg("qty").over(w)), "roll_std": F.when(enough, F.coalesce(F.stddev_samp("qty").over(w), F.lit(0.0))).otherwise(0.0)})


def forward_sum(demand: DataFrame, rows: int, name: str) -> DataFrame:
    w = Window.partitionBy("sku").orderBy("d").rowsBetween(0, rows - 1)
    return demand.withColumn(name, F.sum("qty").over(w))


def streaks(rows: DataFrame, mark: Column) -> DataFrame:
    """Runs of consecutive rows where `mark` holds: (sku, first_d, last_d, length)."""
    w = Window.partitionBy("sku").orderBy("d")
    r = rows.withColumn("_rn", F.row_number().over(w)).where(mark)
    r = r.withColumn("_g", F.col("_rn") - F.row_number().over(w))
    return r.groupBy("sku", "_g").agg(F.min("d").alias("first_d"), F.max("d").alias("last_d"), F.count("*").alias("length")).drop("_g")


def longest_run(marks: Column) -> Column:
    """The longest run of true in an array of booleans."""
    step = lambda s, x: F.struct(F.when(x, s["now"] + 1).otherwise(0).alias("now"), F.greatest(s["top"], F.when(x, s["now"] + 1).otherwise(0)).alias("top"))
    return F.aggregate(marks, F.struct(F.lit(0).alias("now"), F.lit(0).alias("top")), step, lambda s: s["top"])


def rolling_array(q: Column, rows: int = P.ROLLING_BASELINE_ROWS) -> Column:
    return F.transform(q, lambda x, i: M.mean(F.slice(q, F.greatest(F.lit(1), i + 2 - rows), F.least(i + 1, F.lit(rows)))))


def deviation(q: Column) -> Column:
    """The population standard deviation of an array."""
    m = M.mean(q)
    return F.sqrt(F.aggregate(q, F.struct(F.lit(0.0).alias("s"), m.alias("m")), lambda a, x: F.struct((a["s"] + (x - a["m"]) * (x - a["m"])).alias("s"), a["m"].alias("m")), lambda a: a["s"]) / F.nullif(F.size(q), F.lit(0)))


def with_flags(s: DataFrame, mape: Column | None = None) -> DataFrame:
    """`s` (sku, q) with stockout, promo_spike, unusual_drop, high_volatility, high_mape and the array `flags`."""
    s = s.withColumns({"_r": rolling_array(F.col("q")), "_m": M.mean(F.col("q")), "_sd": deviation(F.col("q"))})
    pairs = F.arrays_zip("q", "_r")
    ratio = F.exists(pairs, lambda e: (e["_r"] > 0) & (e["q"] / e["_r"] > P.PROMO_SPIKE_RATIO))
    z = F.exists("q", lambda x: (F.col("_sd") > 0) & ((x - F.col("_m")) / F.col("_sd") > P.PROMO_SPIKE_Z))
    drop = longest_run(F.transform(pairs, lambda e: (e["_r"] > 0) & (e["q"] < P.UNUSUAL_DROP_KEEP * e["_r"])))
    s = s.withColumns(
        {
            "stockout": longest_run(F.transform("q", lambda x: x == 0)) >= P.STOCKOUT_STREAK,
            "promo_spike": ratio | z,
            "unusual_drop": drop >= P.UNUSUAL_DROP_STREAK,
            "high_volatility": F.coalesce((F.col("_m") != 0) & (F.col("_sd") / F.col("_m") >= P.HIGH_VOLATILITY_CV), F.lit(False)),
            "high_mape": F.coalesce(mape > P.HIGH_MAPE, F.lit(False)) if mape is not None else F.lit(False),
        }
    ).drop("_r", "_m", "_sd")
    names = ("stockout", "promo_spike", "unusual_drop", "high_volatility", "high_mape")
    return s.withColumn("flags", F.array_compact(F.array(*[F.when(F.col(n), F.lit(n)) for n in names])))


def oos_rows(demand: DataFrame) -> DataFrame:
    """`demand` with in_oos: the row lies in a run of 3 or more rows without sales."""
    w = Window.partitionBy("sku").orderBy("d")
    r = demand.withColumns({"_rn": F.row_number().over(w), "_z": F.row_number().over(Window.partitionBy("sku", F.col("qty") == 0).orderBy("d"))})
    long = F.count("*").over(Window.partitionBy("sku", F.col("qty") == 0, F.col("_rn") - F.col("_z"))) >= P.STOCKOUT_STREAK
    return r.withColumn("in_oos", (F.col("qty") == 0) & long).drop("_rn", "_z")


def oos_stats(demand: DataFrame) -> DataFrame:
    """(sku, oos_pct, mean_streak, detection_confidence) from runs of 3 or more rows without sales."""
    runs = streaks(demand, F.col("qty") == 0).where(F.col("length") >= P.STOCKOUT_STREAK)
    per = runs.groupBy("sku").agg(F.sum("length").alias("_z"), F.avg("length").alias("mean_streak"))
    n = demand.groupBy("sku").agg(F.count("*").alias("_n"))
    j = n.join(per, "sku", "left")
    conf = F.when(F.col("mean_streak").isNotNull(), F.least(F.lit(0.95), 0.60 + F.col("mean_streak") / 60)).otherwise(0.0)
    return j.select("sku", (F.coalesce("_z", F.lit(0)) / F.col("_n")).alias("oos_pct"), F.coalesce("mean_streak", F.lit(0.0)).alias("mean_streak"), conf.alias("detection_confidence"))


def dow_multipliers(demand: DataFrame, b2b: Column | None = None) -> DataFrame:
    """(sku, m): 7 multipliers, Monday first: a weekday's mean over the overall mean; 1 where rows are too few."""
    day = F.weekday("d")
    aggs = [F.avg("qty").alias("_avg"), F.count("*").alias("_n")]
    aggs += [F.avg(F.when(day == k, F.col("qty"))).alias(f"_a{k}") for k in range(7)] + [F.count(F.when(day == k, 1)).alias(f"_c{k}") for k in range(7)]
    if b2b is not None:
        aggs.append(F.max(b2b).alias("_b"))
    g = demand.groupBy("sku").agg(*aggs)
    flat = (F.col("_n") < 28) | (F.col("_avg") <= 0)
    shut = F.col("_b") if b2b is not None else F.lit(False)
    m = [F.when(flat, 1.0).when(shut & F.lit(k >= 5), 0.0).when(F.col(f"_c{k}") < 4, 1.0).otherwise(F.col(f"_a{k}") / F.col("_avg")) for k in range(7)]
    return g.select("sku", F.array(*m).alias("m"))


def dow_total(total: Column, horizon: int, m: Column, last_day: Column) -> Column:
    """A horizon's total reshaped by the weekdays of its days: whole weeks plus the rest."""
    first = F.weekday(F.date_add(last_day, 1))
    weeks, rest = divmod(horizon, 7)
    week = F.aggregate(m, F.lit(0.0), lambda a, x: a + x)
    part = F.aggregate(F.sequence(F.lit(0), F.lit(rest - 1)), F.lit(0.0), lambda a, k: a + F.get(m, F.pmod(first + k, F.lit(7)))) if rest else F.lit(0.0)
    return total / horizon * (week * weeks + part)


def cap_horizons(points: list[Column], most: Column) -> list[Column]:
    """Totals held flat beyond the effective horizon."""
    out: list[Column] = []
    for h, x in zip(P.HORIZONS, points):
        out.append(F.when(most >= h, x).otherwise(out[-1]) if out else x)
    return out


def business_days(demand: DataFrame) -> DataFrame:
    """Weekday rows only for items that have any, all rows for the others."""
    w = Window.partitionBy("sku")
    some = F.max(F.when(F.weekday("d") < 5, 1).otherwise(0)).over(w)
    return demand.withColumn("_w", some).where((F.weekday("d") < 5) | (F.col("_w") == 0)).drop("_w")


def weekend_zero_ratio(demand: DataFrame) -> DataFrame:
    weekend = F.weekday("d") >= 5
    return demand.groupBy("sku").agg(F.coalesce(F.avg(F.when(weekend, F.when(F.col("qty") == 0, 1.0).otherwise(0.0))), F.lit(0.0)).alias("weekend_zero_ratio"))


def promo_capped(demand: DataFrame, promos: DataFrame, most: float = P.DEFAULTS["max_promo_multiplier"]) -> DataFrame:
    """`demand` with weight and qty_capped: on promotion days at most `most` times the 14-row mean."""
    r = rolling_mean(demand, P.PROMO_BASELINE_ROWS, "roll14").join(promos, ["sku", "d"], "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
    return r.withColumn("qty_capped", F.when(F.col("weight") < 1, F.least(F.col("qty"), F.col("roll14") * most)).otherwise(F.col("qty")))


def promo_weights(demand: DataFrame) -> DataFrame:
    """weight = clamp(mean / qty, 0.5, 0.95) on rows over twice the 14-row mean and over 3 sigma; else 1."""
    r = rolling_stats(demand, P.PROMO_BASELINE_ROWS)
    spike = (F.col("qty") > 2 * F.col("roll_mean")) & (F.col("qty") > F.col("roll_mean") + 3 * F.col("roll_std"))
    return r.withColumn("weight", F.when(spike, F.least(F.greatest(F.col("roll_mean") / F.col("qty"), F.lit(0.5)), F.lit(0.95))).otherwise(1.0))


def level_scale(q: Column) -> Column:
    """The level of the last 14 rows against their non-zero mean, in [0.5, 2]; 1 where there is none."""
    r = M.last(q, P.LEVEL_SCALE_ROWS)
    start = M.mean(F.filter(r, lambda x: x > 0))
    a = P.LEVEL_SCALE_ALPHA
    level = F.aggregate(r, start, lambda s, y: a * y + (1 - a) * s)
    low, high = P.LEVEL_SCALE_RANGE
    return F.when((F.size(r) < 2) | start.isNull() | (start == 0), 1.0).otherwise(F.least(F.greatest(level / start, F.lit(low)), F.lit(high)))


def errors(actual: Column, forecast: Column) -> Column:
    """struct<mape, wape, bias> of an array of actuals against a constant forecast; null where undefined."""
    nz = F.filter(actual, lambda y: y != 0)
    total = F.aggregate(actual, F.lit(0.0), lambda a, y: a + y)
    miss = F.aggregate(actual, F.lit(0.0), lambda a, y: a + F.abs(y - forecast))
    size = F.aggregate(actual, F.lit(0.0), lambda a, y: a + F.abs(y))
    mape = F.aggregate(nz, F.lit(0.0), lambda a, y: a + F.abs((y - forecast) / y)) / F.nullif(F.size(nz), F.lit(0))
    return F.struct(mape.alias("mape"), (miss / F.nullif(size, F.lit(0.0))).alias("wape"), ((forecast * F.size(actual) - total) / F.nullif(total, F.lit(0.0))).alias("bias"))


def path_errors(actual: Column, forecast: Column) -> Column:
    """As `errors`, against an array of forecasts, one for each actual."""
    both = F.zip_with(actual, forecast, lambda y, f: F.struct(y.alias("y"), f.alias("f")))
    add = lambda of: F.aggregate(both, F.lit(0.0), lambda a, e: a + of(e))
    nz = F.filter(both, lambda e: e["y"] != 0)
    mape = F.aggregate(nz, F.lit(0.0), lambda a, e: a + F.abs((e["y"] - e["f"]) / e["y"])) / F.nullif(F.size(nz), F.lit(0))
    miss, size, total = add(lambda e: F.abs(e["y"] - e["f"])), add(lambda e: F.abs(e["y"])), add(lambda e: e["y"])
    return F.struct(mape.alias("mape"), (miss / F.nullif(size, F.lit(0.0))).alias("wape"), (add(lambda e: e["f"] - e["y"]) / F.nullif(total, F.lit(0.0))).alias("bias"))


def split(s: DataFrame, window: Column | int = P.HOLDOUT_ROWS) -> DataFrame:
    """`s` with the arrays train and test: all but the last `window` rows, and those."""
    w = window if isinstance(window, Column) else F.lit(window)
    return s.withColumns({"train": F.slice("q", F.lit(1), F.greatest(F.size("q") - w, F.lit(0))), "test": M.last(F.col("q"), w)})


def folds(s: DataFrame, first: int, every: int, least: int = 7) -> DataFrame:
    """One row per walk-forward fold: cut (rows to train on), train, and the rows ahead of it."""
    stop = F.size("q") - least
    cuts = F.when(stop >= first, F.sequence(F.lit(first), stop, F.lit(every)))
    f = s.select("*", F.explode(cuts).alias("cut"))
    return f.withColumns({"train": F.slice("q", F.lit(1), F.col("cut")), "ahead": F.slice("q", F.col("cut") + 1, F.size("q") - F.col("cut"))})


def structural_state(rows_after: Column, broke: Column) -> Column:
    """What a structural break leaves: "none", "truncated" training data, or "insufficient" rows after it."""
    return F.when(~broke, "none").when(rows_after >= P.MIN_POST_BREAK_ROWS, "truncated").otherwise("insufficient")


def balanced_chunks(items: DataFrame, chunks: int, order: str) -> DataFrame:
    """`items` with chunk 0..chunks-1: near-equal contiguous parts in order. For bounded work lists."""
    return items.withColumn("chunk", F.ntile(chunks).over(Window.orderBy(order)) - 1)


def channel_splits(rows: DataFrame, modes: DataFrame) -> DataFrame:
    """(tenant, sku, splits): what each item sold by day and channel, in that order, for the tenants whose pipeline_mode is multi_channel.

    `rows`: tenant, sku, d, channel, qty; `modes`: tenant, pipeline_mode.
    """
    gated = rows.join(F.broadcast(modes.where("pipeline_mode = 'multi_channel'").select("tenant")), "tenant", "left_semi")
    return gated.groupBy("tenant", "sku").agg(F.sort_array(F.collect_list(F.struct("d", "channel", "qty"))).alias("splits"))


def parent_styles(items: DataFrame, keys: list[str]) -> DataFrame:
    """(sku, style, n) of every item that is not the style itself: the first item of the same `keys`, and how many share them."""
    style = items.groupBy(*keys).agg(F.min("sku").alias("style"), F.count("*").alias("n"))
    return items.join(style, keys).where("sku <> style").select("sku", "style", "n")
