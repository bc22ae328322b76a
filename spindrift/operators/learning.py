"""The learning loop: outcomes, coverage, model performance, health, parameter evidence, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions import scoring as S


def latest(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key, the first in `order` (which must break ties)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def newest(rows: DataFrame, keys: list[str], n: int, *order: Column) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def pending(forecasts: DataFrame, recorded: DataFrame, today: Column) -> DataFrame:
    """Forecasts whose horizon is over by `today` and that have no recorded outcome."""
    closed = forecasts.where(F.expr("date_add(created, horizon)") <= today)
    return closed.join(recorded.select("sku", "created", "horizon"), ["sku", "created", "horizon"], "left_anti")


def range_sums(spans: DataFrame, daily: DataFrame) -> DataFrame:
    """`spans` (sku, created, horizon, ...) with actual and n_days: the sum and count of `daily` rows in [created, created + horizon).

    No range join: the ends of all spans and the daily rows of an item are put in order once, and a running
    sum read at both ends gives each span its total.
    """
    marks = spans.select("sku", F.col("created").alias("a"), F.expr("date_add(created, horizon)").alias("b")).distinct()
    ends = marks.select("sku", F.explode(F.array("a", "b")).alias("d")).distinct().select("sku", "d", F.lit(0).alias("k"), F.lit(0.0).alias("qty"), F.lit(0).alias("n"))
    rows = ends.unionByName(daily.select("sku", "d", F.lit(1).alias("k"), F.coalesce("qty", F.lit(0.0)).alias("qty"), F.lit(1).alias("n")))
    w = Window.partitionBy("sku").orderBy("d", "k").rowsBetween(Window.unboundedPreceding, 0)
    upto = rows.withColumns({"s": F.sum("qty").over(w), "c": F.sum("n").over(w)}).where("k = 0").select("sku", "d", "s", "c")
    a, b = upto.select("sku", F.col("d").alias("_a"), F.col("s").alias("_sa"), F.col("c").alias("_ca")), upto.select("sku", F.col("d").alias("_b"), F.col("s").alias("_sb"), F.col("c").alias("_cb"))
    j = spans.withColumns({"_a": F.col("created"), "_b": F.expr("date_add(created, horizon)")}).join(a, ["sku", "_a"]).join(b, ["sku", "_b"])
    return j.withColumns({"actual": F.col("_sb") - F.col("_sa"), "n_days": F.col("_cb") - F.col("_ca")}).drop("_a", "_b", "_sa", "_sb", "_ca", "_cb")


def outcomes(spans: DataFrame, daily: DataFrame) -> DataFrame:
    """`spans` with actual, forecast (by the span's quantile), error and bias; spans without any actual row are not there yet."""
    r = range_sums(spans, daily).where("n_days > 0")
    key = S.quantile_key(F.col("quantile"))
    r = r.withColumn("forecast", F.when(key == "p50", F.col("p50")).when(key == "p80", F.col("p80")).otherwise(F.col("p90")))
    error, bias = S.outcome_errors(F.col("forecast"), F.col("actual"))
    return r.withColumns({"error": error, "bias": bias})


def coverage(out: DataFrame, keys: list[str]) -> DataFrame:
    """How often the actual was within the forecast, against the quantile promised."""
    inside = F.avg((F.col("actual") <= F.col("forecast")).cast("int"))
    g = out.groupBy(*keys).agg(F.count("*").alias("n"), inside.alias("_c"), F.avg("quantile").alias("_q"))
    return g.select(*keys, "n", F.bround("_c", 3).alias("coverage"), F.bround("_q", 3).alias("target"), F.bround(F.col("_c") - F.col("_q"), 4).alias("gap"))


def performance(out: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Mean, median and 90th percentile error, mean bias and count per model and horizon; rows without an error are left out."""
    keys = keys or ["model", "horizon"]
    g = out.where("error is not null").groupBy(*keys)
    return g.agg(F.avg("error").alias("avg_mape"), F.percentile("error", 0.5).alias("median_mape"), F.percentile("error", 0.9).alias("p90_mape"), F.avg("bias").alias("avg_bias"), F.count("*").alias("n"))


def trend_of(now: Column, before: Column, band: float = P.DEFAULTS["model_performance_stable_band"]) -> Column:
    change = F.round(now - before, 9)
    return F.when(change < -band, "improving").when(change > band, "degrading").otherwise("stable")


def performance_trend(out: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """Performance of the last `days` days against the days before those, in one pass: (model, horizon, mape, prior_mape, improvement, trend)."""
    age = F.datediff(now, F.col("closed"))
    recent, prior = age < days, (age >= days) & (age < 2 * days)
    # errors have 3 places: sums of decimals do not depend on the order of the rows
    mean = lambda c: F.sum(F.when(c, F.col("error").cast("decimal(18,3)"))).cast("double") / F.nullif(F.count_if(c), F.lit(0))
    g = out.where("error is not null").groupBy("model", "horizon").agg(mean(recent).alias("mape"), mean(prior).alias("prior_mape"))
    g = g.where("mape is not null")
    return g.select("*", (F.col("mape") - F.col("prior_mape")).alias("improvement"), trend_of(F.col("mape"), F.col("prior_mape")).alias("trend"))


def new_and_gone(now: DataFrame, before: DataFrame, keys: list[str]) -> DataFrame:
    """The keys only now ("new") and only before ("discontinued")."""
    a, b = now.select(*keys).distinct(), before.select(*keys).distinct()
    return a.join(b, keys, "left_anti").withColumn("change", F.lit("new")).unionByName(b.join(a, keys, "left_anti").withColumn("change", F.lit("discontinued")))


def model_health(perf: DataFrame, prior: DataFrame) -> DataFrame:
    """(model, mape, prior_mape, delta, trend) for all five models; "unknown" where there is no current value."""
    models = perf.sparkSession.createDataFrame([(m,) for m in P.MODELS], "model string")
    j = F.broadcast(models).join(perf.select("model", F.col("avg_mape").alias("mape")), "model", "left").join(prior.select("model", F.col("avg_mape").alias("prior_mape")), "model", "left")
    t = F.when(F.col("mape").isNull(), "unknown").otherwise(trend_of(F.col("mape"), F.col("prior_mape")))
    return j.select("model", "mape", "prior_mape", (F.col("mape") - F.col("prior_mape")).alias("delta"), t.alias("trend"))


def assessment_means(health: DataFrame) -> DataFrame:
    """One row (mape, prior_mape, delta_pct): the means of the models' mean errors, now and before, each over the models that have one."""
    g = health.agg(F.avg("mape").alias("mape"), F.avg("prior_mape").alias("prior_mape"))
    return g.withColumn("delta_pct", F.when(F.col("prior_mape") > 0, (F.col("mape") - F.col("prior_mape")) / F.col("prior_mape") * 100))


def run_statistics(results: DataFrame) -> DataFrame:
    """One row of counts, shares and alerts over (tier, status, confidence, fallback)."""
    n = F.count("*")
    count = lambda c: F.count_if(c)
    cache, fall = count(F.col("tier") == "cache"), count(F.col("fallback"))
    share = lambda c: F.coalesce(c / F.nullif(n, F.lit(0)), F.lit(0.0))
    review = count(F.col("status").isin("needs_acknowledgment", "watchlist_review"))
    return results.agg(
        n.alias("total"), cache.alias("cache_hits"), count(F.col("tier") == "partial").alias("partials"), count(F.col("tier") == "full").alias("fulls"),
        share(count(F.col("status") == "forecasted")).alias("pct_auto"), share(review).alias("pct_review"), F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("avg_confidence"), fall.alias("fallbacks"),
        ((n > 0) & (share(fall) > P.FALLBACK_WARN)).alias("high_fallback"), ((n > 0) & (share(cache) < P.CACHE_HIT_WARN)).alias("low_cache_hit"), ((n > 0) & (share(n - fall) < P.SUCCESS_CRITICAL)).alias("low_success"),
    )


def recommendations(health: DataFrame, stats: DataFrame) -> DataFrame:
    """(topic, advice) in words: degrading models, many fallbacks, few cache hits."""
    worse = health.where("trend = 'degrading'").select(F.col("model").alias("topic"), F.format_string("error rose by %.1f%% over the prior 30 days (now %.3f, before %.3f): check the inputs of this pattern, widen the search budget", F.col("delta") * 100, "mape", "prior_mape").alias("advice"))
    fall = stats.where("high_fallback").select(F.lit("fallback").alias("topic"), F.format_string("%d of %d items used the fallback model: check input quality and schema", "fallbacks", "total").alias("advice"))
    cold = stats.where("low_cache_hit").select(F.lit("cache").alias("topic"), F.format_string("only %d of %d items came from the cache: demand is volatile or fingerprints are unstable", "cache_hits", "total").alias("advice"))
    return worse.unionByName(fall).unionByName(cold)


def reorder_aggregate(signals: DataFrame, n: int = 5) -> DataFrame:
    """(sku, stockouts, overstock, n) over the newest n signals of each item (stockout boolean, overstock_pct)."""
    last = newest(signals, ["sku"], n, F.desc("ts"), F.desc("signal_id"))
    return last.groupBy("sku").agg(F.count_if(F.col("stockout")).alias("stockouts"), F.avg(F.coalesce("overstock_pct", F.lit(0.0))).alias("overstock"), F.count("*").alias("n"))


def thompson_means(state: DataFrame) -> DataFrame:
    return state.withColumn("mean", F.col("alpha") / (F.col("alpha") + F.col("beta")))


def thompson_map(state: DataFrame) -> DataFrame:
    """(sku, model, state, hashes, first_config): the settings' alpha and beta as a map by hash, the hashes in order and the first."""
    g = state.groupBy("sku", "model").agg(F.map_from_entries(F.collect_list(F.struct("config_hash", F.struct("alpha", "beta")))).alias("state"))
    return g.withColumn("hashes", F.sort_array(F.map_keys("state"))).withColumn("first_config", F.get("hashes", F.lit(0)))


def thompson_best(state: DataFrame) -> DataFrame:
    """The setting with the highest Beta mean per (sku, model); equal means: the first by hash."""
    return latest(thompson_means(state), ["sku", "model"], F.desc("mean"), F.asc("config_hash"))


def thompson_sample(state: DataFrame, run: str, budget: int = 3) -> DataFrame:
    """The `budget` settings with the largest draws per (sku, model), the incumbent (highest mean) always among them.

    Draws are a function of (sku, model, setting, run): the alpha-th smallest of alpha + beta - 1 uniforms
    has the Beta distribution for whole alpha and beta, and the uniforms are the first 52 bits of MD5 hashes.
    """
    size = (F.round("alpha") + F.round("beta") - 1).cast("int")
    name = lambda k: F.concat_ws("|", F.col("sku").cast("string"), "model", "config_hash", F.lit(run), k.cast("string"))
    u = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), size)), lambda k: F.conv(F.substring(F.md5(name(k)), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52)))
    drawn = thompson_means(state).withColumn("theta", F.get(F.sort_array(u), F.greatest(F.lit(0), F.round("alpha").cast("int") - 1)))
    w = Window.partitionBy("sku", "model")
    r = drawn.withColumns({"_top": F.row_number().over(w.orderBy(F.desc("mean"), "config_hash")), "_rn": F.row_number().over(w.orderBy(F.desc("theta"), "config_hash"))})
    r = r.withColumn("_in", F.max(F.when((F.col("_top") == 1) & (F.col("_rn") <= budget), 1).otherwise(0)).over(w))
    keep = (F.col("_top") == 1) | (F.col("_rn") <= F.when(F.col("_in") == 1, budget).otherwise(budget - 1))
    return r.where(keep).withColumn("incumbent", F.col("_top") == 1).drop("_top", "_rn", "_in")


def thompson_update(state: DataFrame, tested: DataFrame) -> DataFrame:
    """`state` after tests (sku, model, config_hash, mape, baseline): alpha + 1 where the error is at most 98 % of the baseline, else beta + 1; only tested settings count a trial."""
    good = F.col("mape") <= 0.98 * F.col("baseline")
    t = tested.groupBy("sku", "model", "config_hash").agg(F.count_if(good).alias("_g"), F.count_if(~F.coalesce(good, F.lit(False))).alias("_b"))
    j = state.join(t, ["sku", "model", "config_hash"], "full")
    at = lambda c, d: F.coalesce(F.col(c), F.lit(d))
    return j.withColumns({"alpha": at("alpha", 1.0) + at("_g", 0), "beta": at("beta", 1.0) + at("_b", 0), "trials": at("trials", 0) + at("_g", 0) + at("_b", 0)}).drop("_g", "_b")


def top_volume(totals: DataFrame, share: float = 0.2) -> DataFrame:
    """(sku, total, criticality): "A" for the largest max(1, round(n * share)) items, "B" for the others; ties by sku.

    A histogram of log totals (bounded, summed map-side) finds the one bin in which the cut falls; only that
    bin's items are put in order, the others are labelled by their bin.
    """
    b = totals.withColumn("_b", F.floor(256 * F.log2(F.greatest(F.coalesce(F.col("total"), F.lit(0)), F.lit(0)) + 1)))
    counts = sorted(((r["_b"], r["count"]) for r in b.groupBy("_b").count().collect()), reverse=True)
    left = max(1, round(sum(n for _, n in counts) * share))
    edge = 0
    for edge, n in counts:
        if n >= left:
            break
        left -= n
    clear = b.where(F.col("_b") != edge).select("sku", "total", F.when(F.col("_b") > edge, "A").otherwise("B").alias("criticality"))
    rank = F.row_number().over(Window.partitionBy("_b").orderBy(F.desc("total"), F.asc("sku")))
    tight = b.where(F.col("_b") == edge).select("sku", "total", F.when(rank <= left, "A").otherwise("B").alias("criticality"))
    return clear.unionByName(tight)


def accuracy_rollups(errors: DataFrame) -> DataFrame:
    """Mean, median and count of mape at three grains in one pass: sku x horizon, pattern x horizon, horizon."""
    r = errors.groupingSets([["sku", "pattern", "horizon"], ["pattern", "horizon"], ["horizon"]], "sku", "pattern", "horizon").agg(F.grouping_id().alias("gid"), F.avg("mape").alias("avg_mape"), F.percentile("mape", 0.5).alias("median_mape"), F.avg("mae").alias("avg_mae"), F.sqrt(F.avg("sq")).alias("rmse"), F.count("mape").alias("n"))
    level = F.when(F.col("gid") == 0, "sku").when(F.col("gid") == 4, "pattern").otherwise("overall")
    return r.withColumn("grain", level).drop("gid")
