"""Scores, labels and decisions as column expressions; `p` is a params.Params (or any mapping of columns)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params as P


def _v(p, name: str) -> Column:
    x = p[name]
    return x if isinstance(x, Column) else F.lit(float(x))


def _by_pattern(p, prefix: str, pattern: Column, default: str) -> Column:
    out = F.when(F.lit(False), F.lit(0.0))
    for name in P.PATTERNS:
        out = out.when(pattern == name, _v(p, f"{prefix}_{name}"))
    return out.otherwise(_v(p, f"{prefix}_{default}"))


def clamp(x: Column, low: Column | float, high: Column | float) -> Column:
    wrap = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.least(F.greatest(x, wrap(low)), wrap(high))


def finite(x: Column) -> Column:
    """Null for NaN and infinities."""
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def clamp_metric(x: Column) -> Column:
    """x within 99 of 0; null for null, NaN and infinities."""
    return F.when(finite(x).isNotNull(), clamp(x, -99.0, 99.0))


def confidence(p, pattern: Column, mape: Column, flags: Column, gap: Column, upstream: Column, bias: Column, truncated: Column, insufficient: Column, reasonable: Column) -> Column:
    """The final confidence, from backtest error, flags, calibration gap, upstream confidence and breaks."""
    cap = _v(p, "mape_cap_in_confidence")
    c = _by_pattern(p, "confidence_base", pattern, "stable") * (1 - F.coalesce(F.least(finite(mape), cap), cap))
    c = c * F.when(F.arrays_overlap(flags, F.array(*[F.lit(x) for x in P.EXCEPTION_FLAGS])), _v(p, "exception_penalty")).otherwise(1.0)
    over = _v(p, "overconfidence_threshold")
    c = c * F.when(gap > over, _v(p, "overconfidence_mult")).when(gap < -over, _v(p, "underconfidence_mult")).otherwise(1.0)
    c = c * F.when(upstream < _v(p, "stage8_penalty_threshold"), _v(p, "stage8_penalty_mult")).otherwise(1.0)
    c = c * bias
    c = c * F.when(truncated, F.greatest(F.lit(0.0), 1 - _v(p, "structural_break_confidence_penalty"))).when(insufficient, _v(p, "insufficient_post_break_mult")).otherwise(1.0)
    return clamp(c * reasonable, _v(p, "confidence_floor"), _v(p, "confidence_ceiling"))


def tier(p, c: Column) -> Column:
    return F.when(c >= _v(p, "decision_gate_threshold"), "auto_proceed").when(c >= _v(p, "review_suggested_threshold"), "review_suggested").when(c >= _v(p, "review_required_threshold"), "review_required").otherwise("manual_override")


def status(p, c: Column, flags: Column, watchlist: Column) -> Column:
    bad = F.array_contains(flags, "high_mape") | (c < _v(p, "decision_gate_threshold"))
    return F.when(watchlist, "watchlist_review").when(bad, "needs_acknowledgment").otherwise("forecasted")


def risk(p, c: Column) -> Column:
    return F.when(c >= _v(p, "risk_low_min"), "low").when(c >= _v(p, "risk_medium_min"), "medium").otherwise("high")


def reasonableness(p, total_30d: Column, baseline: Column, n: Column) -> tuple[Column, Column]:
    """(flags, multiplier) of a 30-day forecast against the mean of the last 90 rows."""
    daily = total_30d / P.REASONABLE_HORIZON
    usable = (n >= P.REASONABLE_ROWS) & (baseline > 0)
    high = usable & (daily > baseline * _v(p, "max_forecast_vs_baseline"))
    low = usable & (daily < baseline * _v(p, "min_forecast_vs_baseline"))
    flags = F.array_compact(F.array(F.when(high, F.lit("forecast_unusually_high")), F.when(low, F.lit("forecast_unusually_low"))))
    return flags, F.when(high, _v(p, "forecast_unusually_high_mult")).otherwise(1.0) * F.when(low, _v(p, "forecast_unusually_low_mult")).otherwise(1.0)


def backtest_window(p, obs: Column, ultra_sparse: Column, mode: Column, calibrated: Column) -> Column:
    low, high = _v(p, "min_backtest_window").cast("int"), _v(p, "max_backtest_window").cast("int")
    third = F.floor(obs / 3).cast("int")
    w = F.coalesce(calibrated, _v(p, "default_backtest_window").cast("int"))
    w = F.when(ultra_sparse, low).when(obs < _v(p, "backtest_short_obs_threshold"), F.greatest(low, third)).when((obs >= _v(p, "backtest_exploit_obs_threshold")) & (mode == "exploit"), high).otherwise(w)
    w = F.greatest(low, F.least(w, high))
    return F.when(w >= obs, F.greatest(F.lit(1), third)).otherwise(w)


def assigned_model(p, pattern: Column, obs: Column) -> Column:
    names = F.create_map(*[F.lit(x) for kv in P.PATTERN_MODEL.items() for x in kv])
    return F.when((pattern == "seasonal") & (obs < _v(p, "min_seasonal_obs_days")), "holts_linear_trend").otherwise(F.element_at(names, pattern))


def selected_quantile(p, pattern: Column, criticality: Column) -> Column:
    return F.when(criticality == "A", F.lit(P.CRITICALITY_A_QUANTILE)).otherwise(_by_pattern(p, "quantile", pattern, "stable"))


def effective_max_horizon(days_to_end: Column, shelf_life: Column) -> Column:
    end = F.when(days_to_end.isNotNull(), F.greatest(F.lit(0), days_to_end))
    return F.greatest(F.lit(7), F.least(F.lit(365), end, shelf_life))


def learning_mode(p, alpha: Column, beta: Column, runs: Column, maturity: Column, watchlist: Column, drift: Column) -> Column:
    need = F.when(maturity == "established", _v(p, "exploit_threshold_established")).when(maturity == "developing", _v(p, "exploit_threshold_developing")).otherwise(_v(p, "exploit_threshold_new"))
    good = (alpha / (alpha + beta) > _v(p, "thompson_exploit_confidence_threshold")) & (runs >= need) & ~watchlist & ~drift
    return F.when(good, "exploit").otherwise("explore")


def oos_factor(pattern: Column, pct: Column, detection: Column) -> Column:
    return F.when((pattern == "intermittent") | pct.isNull(), F.lit(1.0)).otherwise(clamp(1 + pct * F.coalesce(detection, F.lit(0.0)), 1.0, P.OOS_MAX_FACTOR))


def is_b2b(weekend_zero_ratio: Column) -> Column:
    return F.coalesce(weekend_zero_ratio, F.lit(0.0)) > P.B2B_WEEKEND_ZERO_RATIO


def reorder_factor(stockouts: Column, overstock: Column) -> Column:
    f = P.REORDER_FACTOR
    return F.when(stockouts >= P.REORDER_STOCKOUT_MIN_EVENTS, f["stockout"]).when(overstock > P.REORDER_OVERSTOCK, f["overstock"]).otherwise(f["default"])


def quality(mape: Column, fallback: Column) -> Column:
    return F.when(fallback | finite(mape).isNull(), "proxy").when(mape < P.QUALITY_GOOD, "good").when(mape < P.QUALITY_ACCEPTABLE, "acceptable").otherwise("poor")


def hint_matched(hint: Column, used: Column) -> Column:
    return F.coalesce((hint != "") & (F.lower(hint) == F.lower(used)), F.lit(False))


def quantile_key(q: Column) -> Column:
    d = q.cast("decimal(4,3)")
    return F.when(d == F.lit("0.500").cast("decimal(4,3)"), "p50").when(d == F.lit("0.800").cast("decimal(4,3)"), "p80").otherwise("p90")


def outcome_errors(forecast: Column, actual: Column) -> tuple[Column, Column]:
    """(error, bias): relative to the actual, 3 places, halves away from 0; null where the actual is 0."""
    a, f = actual.cast("decimal(18,4)"), forecast.cast("decimal(18,4)")
    nonzero = F.nullif(a, F.lit(0).cast("decimal(18,4)"))
    return F.round(F.abs(a - f) / nonzero, 3).cast("double"), F.round((f - a) / nonzero, 3).cast("double")


def quantile_evidence(coverage: Column, target: Column, current: Column, step: Column | float) -> Column:
    gap = target - coverage
    return F.when(F.abs(gap) < 0.01, current).otherwise(clamp(current + F.when(gap > 0, 1.0).otherwise(-1.0) * step, 0.50, 0.99))


def safe_evidence(x: Column) -> Column:
    return clamp(F.coalesce(finite(x), F.lit(0.0)), 0.0, 1.0)


def safety_stock_evidence(current: Column, stockouts: Column, overstock: Column) -> Column:
    """Null where neither stockouts nor overstock call for a change."""
    f = P.REORDER_FACTOR
    return F.when(stockouts >= P.REORDER_STOCKOUT_MIN_EVENTS, F.least(F.lit(0.50), current * f["stockout"])).when(overstock > P.REORDER_OVERSTOCK, F.greatest(F.lit(0.05), current * f["overstock"]))


def fingerprint(sku: Column, sales: Column, pattern: Column, oos: Column, lifecycle: Column) -> Column:
    """SHA-256 of a canonical string of what a forecast depends on; stable across engines."""
    shown = F.array_join(F.transform(sales, lambda x: F.format_string("%.2f", x)), ",")
    return F.sha2(F.concat_ws("|", sku.cast("string"), shown, F.coalesce(pattern, F.lit("")), F.format_string("%.3f", F.coalesce(oos, F.lit(0.0))), F.coalesce(lifecycle, F.lit(""))), 256)


def config_hash(config: Column) -> Column:
    """SHA-256 of a map of settings, independent of the order of its keys."""
    entries = F.transform(F.array_sort(F.map_entries(config)), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return F.sha2(F.array_join(entries, ","), 256)


def processing_tier(now: Column, cached: Column, pattern: Column, cached_pattern: Column, total: Column, cached_total: Column, drift: Column, watchlist: Column) -> Column:
    """cache, partial or full: what must be computed again since the cached fingerprint."""
    t = F.when(cached.isNull(), "full").when(now == cached, "cache").when(cached_pattern.isNotNull() & (cached_pattern != pattern), "full")
    t = t.when((cached_total > 0) & (F.abs(total - cached_total) / cached_total < P.PARTIAL_CHANGE), "partial").otherwise("full")
    return F.when(drift, "full").when(watchlist & (t == "cache"), "partial").otherwise(t)


def clearance(baseline: Column, discount: Column, elasticity: Column | float) -> Column:
    return baseline * F.pow(1 - discount, elasticity if isinstance(elasticity, Column) else F.lit(elasticity))


def ceiling_horizon(days: Column) -> Column:
    """The least horizon that covers `days`; the longest if none does."""
    h = F.array(*[F.lit(x) for x in P.HORIZONS])
    return F.coalesce(F.get(F.filter(h, lambda x: x >= days), F.lit(0)), F.lit(P.HORIZONS[-1]))


def execution_mode(hours_since_complete: Column, limit: Column | float) -> Column:
    return F.when(hours_since_complete.isNull() | (hours_since_complete >= limit), "full").otherwise("micro")


def reliable_features(features: Column, reliability: Column, floor: Column | float) -> Column:
    """The features whose reliability (a map; none counts 0) reaches the floor, in their order."""
    low = floor if isinstance(floor, Column) else F.lit(floor)
    return F.filter(features, lambda f: F.coalesce(F.try_element_at(reliability, f), F.lit(0.0)) >= low)


def window_key(*parts: Column) -> Column:
    """A stable id of an evaluation window, in the form of a UUID."""
    h = F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))


def safe_decimal(text: Column, precision: int = 12, scale: int = 6) -> Column:
    """A decimal from text; null for anything that is not a number of that size."""
    return text.try_cast(f"decimal({precision},{scale})")
