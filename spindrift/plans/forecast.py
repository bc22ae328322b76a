"""The end-to-end run: series -> decisions -> tuned model -> backtest -> horizons -> confidence, one row per item.

One shuffle by item builds its array; all later steps are columns of that row. Only seasonal items and items
with alerts go through Arrow, and only they.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import models as M
from ..functions import scoring as S
from ..operators import arrow as A
from ..operators import series as R


def classify(s: DataFrame) -> DataFrame:
    """`s` (sku, q, n) with a pattern from the series alone: short, sparse, trending, seasonal by weekday, or stable."""
    q = F.col("q")
    half = F.floor(F.size(q) / 2).cast("int")
    ratio = M.mean(F.slice(q, half + 1, F.greatest(F.size(q), F.lit(1)))) / F.nullif(M.mean(F.slice(q, F.lit(1), F.greatest(half, F.lit(1)))), F.lit(0.0))
    zeros = F.size(F.filter(q, lambda x: x == 0)) / F.size(q)
    return s.withColumn("pattern", F.when(F.col("n") < 60, "cold_start").when(zeros > 0.4, "intermittent").when((ratio > 1.5) | (ratio < 0.67), "trending").otherwise("stable"))


def _level(q: Column, model: Column, g: Column) -> Column:
    """Units per day of the flat models under the settings g."""
    return F.when(model == "naive_forecast", M.naive_level(q, g["lag"], g["how"])).when(model == "croston", M.croston_rate(q, g["alpha"], g["variant"])).otherwise(M.ses_level(q, g["alpha"]))


def _path(q: Column, model: Column, g: Column, days: Column) -> Column:
    """array<double>: the forecasts of the `days` days after q; Holt's from its own level and trend."""
    phi = g["phi"]
    reach = lambda k: F.when(phi == 1, k.cast("double")).otherwise(phi * (1 - F.pow(phi, k)) / (1 - phi))
    along = lambda h: F.transform(F.sequence(F.lit(1), days), lambda k: F.greatest(F.lit(0.0), h["l"] + h["t"] * reach(k)))
    # an array of one state, so that the fold runs once and not for every day
    holt = F.get(F.transform(F.array(M.holt_state(q, g["alpha"], g["beta"], phi)), along), F.lit(0))
    flat = F.array_repeat(_level(q, model, g), days)
    return F.when(days < 1, F.array().cast("array<double>")).when(model == "holts_linear_trend", holt).otherwise(flat)


def _array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _setting(alpha: float = 0.3, beta: float = 0.1, phi: float = M.PHI, lag: int = 7, how: str = "mean_7d", variant: str = "SBA") -> Column:
    return F.struct(F.lit(alpha).alias("alpha"), F.lit(beta).alias("beta"), F.lit(phi).alias("phi"), F.lit(lag).alias("lag"), F.lit(how).alias("how"), F.lit(variant).alias("variant"))


def _grid(model: Column) -> Column:
    """The settings of each model's own grid, its default first; seasonal items have those of smoothing."""
    naive = F.array(*[_setting(lag=lag, how=how) for lag, how in M.NAIVE_GRID])
    croston = F.array(*[_setting(alpha=a, variant=v) for a, v in M.CROSTON_GRID])
    holt = F.array(*[_setting(alpha=a, beta=b, phi=M.PHI if damped else 1.0) for a, b, damped in M.HOLT_GRID])
    ses = F.array(*[_setting(alpha=a) for a in M.SES_GRID])
    return F.when(model == "naive_forecast", naive).when(model == "croston", croston).when(model == "holts_linear_trend", holt).otherwise(ses)


def tuned(s: DataFrame) -> DataFrame:
    """`s` (sku, q, model) with hp, alpha and val_mape: the setting of the model's grid with the least error on the last 14 rows, first of equals.

    The errors are an array and the choice an argmin in the row; a failed or undefined error counts 1, capped at 99.
    """
    s = R.split(s, P.HOLDOUT_ROWS).withColumn("_g", _grid(F.col("model")))
    path = lambda g: _path(F.col("train"), F.col("model"), g, F.size("test"))
    mape = lambda g: R.path_errors(F.col("test"), path(g))["mape"]
    s = s.withColumn("_e", F.transform("_g", lambda g: F.least(F.coalesce(mape(g), F.lit(1.0)), F.lit(99.0))))
    s = s.withColumn("_b", F.array_min(F.transform("_e", lambda e, k: F.struct(e.alias("mape"), k.alias("k")))))
    s = s.withColumn("hp", F.get("_g", F.col("_b.k"))).withColumns({"alpha": F.col("hp.alpha"), "val_mape": F.col("_b.mape")})
    return s.drop("_g", "_e", "_b", "train", "test")


def prepared(s: DataFrame, most: float = P.DEFAULTS["max_promo_multiplier"]) -> DataFrame:
    """`s` (sku, ds, q, n, model, weights, b2b, promo) with ds, q and weights as the model trains on them, and dow.

    Items sold to businesses (b2b) keep their weekday rows, if they have any. dow: 7 multipliers, Monday first, of the
    rows kept. On promotion days (promo: an array of weights of the rows of q, or null; below 1 on such days) q is
    at most `most` times its 14-row mean; seasonal items take the weights into their fit instead. n stays.
    """
    q, own = F.col("q"), F.col("model") == "prophet"
    row = lambda x, i: F.struct(F.get("ds", i).alias("d"), F.weekday(F.get("ds", i)).alias("k"), x.alias("q"), F.coalesce(F.get("promo", i), F.lit(1.0)).alias("w"), F.get("weights", i).alias("v"))
    s = s.withColumn("_z", F.transform(q, row)).withColumn("_w", F.filter("_z", lambda e: e["k"] < 5))
    shut = F.coalesce("b2b", F.lit(False)) & (F.size("_w") > 0)
    s = s.withColumn("_z", F.when(shut, F.col("_w")).otherwise(F.col("_z"))).withColumns({"b2b": shut, "ds": F.col("_z.d"), "q": F.col("_z.q")})
    s = s.withColumn("_m", M.mean(q))
    flat = own | (F.size("q") < 28) | ~F.coalesce(F.col("_m") > 0, F.lit(False))
    at = lambda k: F.transform(F.array(F.filter("_z", lambda e: e["k"] == k)["q"]), lambda a: F.when(F.size(a) < 4, F.lit(1.0)).otherwise(M.mean(a) / F.col("_m")))[0]
    dow = F.array(*[F.when(F.col("b2b") & F.lit(k >= 5), F.lit(0.0)).otherwise(at(k)) for k in range(7)])
    s = s.withColumn("dow", F.when(flat, F.array(*[F.lit(1.0)] * 7)).otherwise(dow))
    given = F.when(F.col("promo").isNotNull(), F.col("_z.w")).when(F.col("weights").isNotNull(), F.col("_z.v"))
    capped = F.transform(F.arrays_zip("_z", R.rolling_array(q, P.PROMO_BASELINE_ROWS).alias("r")), lambda e: F.when(e["_z"]["w"] < 1, F.least(e["_z"]["q"], e["r"] * most)).otherwise(e["_z"]["q"]))
    some = F.exists("_z", lambda e: e["w"] < 1)
    return s.withColumns({"weights": given, "q": F.when(some & ~own, capped).otherwise(q)}).drop("_z", "_w", "_m")


def run(s: DataFrame, p: P.Params, seasonal: bool = True, prepare: bool = False) -> DataFrame:
    """Forecasts of `s` (sku, ds, q, n; optional pattern, criticality, oos_pct, detection, upstream, watchlist, bias, gap, alerts, weights).

    Items with `alerts` have their rows but for the last 14 searched for a structural break, which lowers their
    confidence; `weights` (of the rows of q) go into the seasonal fit. Without `seasonal` the seasonal
    items are smoothed. With `prepare` the rows go through `prepared` first (optional columns b2b, promo), and the
    totals of the other models follow the weekdays of their days.
    """
    have = set(s.columns)
    broken = A.structural_break(R.split(s.where("alerts")).select("sku", F.col("train").alias("q"))).select("sku", F.col("rows_after").alias("_after")) if "alerts" in have else None
    s = s if "pattern" in have else classify(s)
    given = {"criticality": F.lit("B"), "oos_pct": F.lit(None).cast("double"), "detection": F.lit(None).cast("double"), "upstream": F.lit(None).cast("double"), "watchlist": F.lit(False), "bias": F.lit(1.0), "gap": F.lit(None).cast("double"), "max_horizon": F.lit(365), "weights": F.lit(None).cast("array<double>")}
    s = s.withColumns({k: v for k, v in given.items() if k not in have})
    s = s.withColumn("q", M.clean(F.col("q"))).withColumn("model", S.assigned_model(p, F.col("pattern"), F.col("n")))
    if prepare:
        given = {"b2b": F.lit(False), "promo": F.lit(None).cast("array<double>")}
        s = prepared(s.withColumns({k: v for k, v in given.items() if k not in have}), float(p["max_promo_multiplier"]))
    s = tuned(s)
    window = S.backtest_window(p, F.col("n"), F.col("n") < 14, F.lit("explore"), F.lit(None).cast("int"))
    s = R.split(s.withColumn("window", window), F.col("window"))
    s = s.withColumn("_p", _path(F.col("train"), F.col("model"), F.col("hp"), F.size("test")))
    if seasonal:
        own = F.col("model") == "prophet"
        z = A.seasonal_items(s.where(own).select("sku", "q", F.size("test").alias("window"), "weights"))
        s = s.join(z.toDF("sku", "_zv", "_zp", "_zt"), "sku", "left")
        s = s.withColumns({"_p": F.when(own, F.col("_zp")).otherwise(F.col("_p")), "val_mape": F.when(own, F.col("_zv")).otherwise(F.col("val_mape")), "alpha": F.when(~own, F.col("alpha"))})
    s = s.withColumn("_e", R.path_errors(F.col("test"), F.col("_p")))
    s = R.with_flags(s.withColumn("mape", F.col("_e.mape")), F.col("mape"))
    s = s.withColumns({"level": _level(F.col("q"), F.col("model"), F.col("hp")), "_h": M.holt_state(F.col("q"), F.col("hp.alpha"), F.col("hp.beta"), F.col("hp.phi")), "factor": S.oos_factor(F.col("pattern"), F.col("oos_pct"), F.col("detection"))})
    days, holt = _array(P.HORIZONS), F.col("model") == "holts_linear_trend"
    totals = F.when(holt, F.transform(days, lambda h: M.holt_total(F.col("_h"), h, F.col("hp.phi")))).otherwise(F.transform(days, lambda h: F.greatest(F.lit(0.0), F.col("level")) * h))
    moves = holt | (F.lit(seasonal) & (F.col("model") == "prophet"))
    if seasonal:
        totals = F.when(F.col("model") == "prophet", F.col("_zt")).otherwise(totals)
    # totals per horizon, held flat beyond the effective horizon
    s = s.withColumns({"_x": F.transform(totals, lambda x: x * F.col("factor")), "_k": F.size(F.filter(days, lambda h: h <= F.col("max_horizon")))})
    s = s.withColumn("_t", F.transform("_x", lambda x, i: F.when((i < F.col("_k")) | (F.col("_k") == 0), x).otherwise(F.get("_x", F.col("_k") - 1))))
    if prepare:
        day = F.element_at("ds", -1)
        shaped = F.array(*[R.dow_total(F.get("_t", F.lit(i)), h, F.col("dow"), day) for i, h in enumerate(P.HORIZONS)])
        s = s.withColumn("_t", F.when((F.size("ds") == 0) | F.forall("dow", lambda x: x == 1), F.col("_t")).otherwise(shaped))
    flat = F.when(F.col("model").isin("naive_forecast", "croston"), F.col("level")).otherwise(F.get("_p", F.lit(0)))
    missed = M.last(F.zip_with("test", "_p", lambda y, f: y - f), 30)
    s = s.withColumn("_r", F.when(moves, missed).otherwise(M.residuals(F.col("q"), flat)))
    s = s.withColumn("_o", M.order_statistics(F.col("_r")))
    s = s.withColumn("_q", F.transform("_t", lambda x: M.quantiles_from(x, F.col("_o"), F.col("pattern"))))
    s = s.withColumns({f"forecast_{h}d": F.get("_q", F.lit(i)) for i, h in enumerate(P.HORIZONS)})
    base = M.mean(M.last(F.col("q"), P.REASONABLE_BASELINE_ROWS))
    odd, mult = S.reasonableness(p, F.get("_t", F.lit(P.HORIZONS.index(P.REASONABLE_HORIZON))), base, F.col("n"))
    s = s.withColumn("flags", F.concat("flags", odd)).withColumn("_m", mult)
    s = s.withColumn("_after", F.lit(None).cast("bigint")) if broken is None else s.join(broken, "sku", "left")
    cut = lambda state: R.structural_state(F.col("_after"), F.col("_after").isNotNull()) == state
    c = S.confidence(p, F.col("pattern"), F.col("mape"), F.col("flags"), F.col("gap"), F.col("upstream"), F.col("bias"), cut("truncated"), cut("insufficient"), F.col("_m"))
    s = s.withColumn("confidence", c)
    return s.select(
        "sku", "n", "pattern", "model", "alpha", "val_mape", "window", "mape", F.col("_e.wape").alias("wape"), F.col("_e.bias").alias("error_bias"), "flags",
        S.selected_quantile(p, F.col("pattern"), F.col("criticality")).alias("quantile"), *[f"forecast_{h}d" for h in P.HORIZONS],
        "confidence", S.tier(p, F.col("confidence")).alias("tier"), S.status(p, F.col("confidence"), F.col("flags"), F.col("watchlist")).alias("status"), S.risk(p, F.col("confidence")).alias("risk"),
    )


def flagship(s: DataFrame, p: P.Params, alpha: float = 0.3) -> DataFrame:
    """The smallest whole run: smoothing, backtest on the last 14 rows, eight horizon means, confidence, labels."""
    s = R.split(s.withColumn("pattern", F.lit("stable")))
    s = s.withColumn("mape", R.errors(F.col("test"), M.ses_level(F.col("train"), alpha))["mape"])
    s = R.with_flags(s, F.col("mape")).withColumn("level", M.ses_level(F.col("q"), alpha))
    no, none = F.lit(False), F.lit(None).cast("double")
    s = s.withColumn("c", S.confidence(p, F.col("pattern"), F.col("mape"), F.col("flags"), none, none, F.lit(1.0), no, no, F.lit(1.0)))
    return s.select("sku", F.col("n").alias("n_days"), *[F.round(F.col("level") * h, 4).alias(f"h{h}") for h in P.HORIZONS], F.round("mape", 6).alias("mape"), F.array_join("flags", "|").alias("flags"), F.round("c", 6).alias("confidence"), S.tier(p, F.col("c")).alias("tier"), S.status(p, F.col("c"), F.col("flags"), no).alias("status"), S.risk(p, F.col("c")).alias("risk"))


def walk_forward(s: DataFrame, first: int, every: int, horizons: tuple[int, ...] = (7, 14, 30), alpha: float = 0.3) -> DataFrame:
    """(sku, cut, horizon, forecast, actual, mape, mae, sq) of every fold and horizon whose rows are all there."""
    f = R.folds(s, first, every).withColumn("level", M.ses_level(F.col("train"), alpha))
    f = f.select("sku", "cut", "level", "ahead", F.explode(F.array(*[F.lit(h) for h in horizons])).alias("horizon")).where(F.size("ahead") >= F.col("horizon"))
    f = f.withColumn("forecast", F.col("level") * F.col("horizon")).withColumn("actual", F.aggregate(F.slice("ahead", F.lit(1), F.col("horizon")), F.lit(0.0), lambda a, x: a + x))
    miss = F.abs(F.col("actual") - F.col("forecast"))
    return f.select("sku", "cut", "horizon", "forecast", "actual", (miss / F.nullif(F.col("actual"), F.lit(0.0))).alias("mape"), miss.alias("mae"), (miss * miss).alias("sq"))


def cache_track(prior: DataFrame, s: DataFrame) -> DataFrame:
    """Prior forecasts (sku, h: map of horizon to map of quantile) scaled by each item's new level."""
    scale = s.select("sku", R.level_scale(F.col("q")).alias("scale"))
    return prior.join(scale, "sku").withColumn("h", F.transform_values("h", lambda _, qs: F.transform_values(qs, lambda _k, v: F.bround(v * F.col("scale"), 4)))).drop("scale")


def routed(items: DataFrame, cache: DataFrame, partial, full) -> DataFrame:
    """Each tier (column tier) through its own branch, together again; the expensive branch sees only its rows."""
    return cache.unionByName(partial(items.where("tier = 'partial'"))).unionByName(full(items.where("tier = 'full'")))
