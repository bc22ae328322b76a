"""Fixed values of the forecasting domain, the tenant parameters, and their lookup and update."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Forecast horizons in days, patterns, models, quantiles.
HORIZONS = (7, 14, 30, 60, 90, 150, 180, 365)
PATTERNS = ("cold_start", "intermittent", "seasonal", "trending", "stable")
PATTERN_MODEL = {
    "cold_start": "naive_forecast",
    "intermittent": "croston",
    "seasonal": "prophet",
    "trending": "holts_linear_trend",
    "stable": "simple_exponential_smoothing",
}
MODELS = tuple(PATTERN_MODEL.values())
CRITICALITY_A_QUANTILE = 0.99

# Thresholds of flags, windows and calibration.
ROLLING_BASELINE_ROWS = 7
PROMO_BASELINE_ROWS = 14
STOCKOUT_STREAK = 3
PROMO_SPIKE_RATIO = 2.0
PROMO_SPIKE_Z = 3.0
UNUSUAL_DROP_KEEP = 0.40
UNUSUAL_DROP_STREAK = 3
HIGH_VOLATILITY_CV = 1.0
HIGH_MAPE = 0.50
B2B_WEEKEND_ZERO_RATIO = 0.60
OOS_MAX_FACTOR = 1.50
REORDER_STOCKOUT_MIN_EVENTS = 2
REORDER_OVERSTOCK = 0.30
REORDER_FACTOR = {"stockout": 1.10, "overstock": 0.92, "default": 1.00}
LEVEL_SCALE_ROWS = 14
LEVEL_SCALE_ALPHA = 0.30
LEVEL_SCALE_RANGE = (0.5, 2.0)
FINGERPRINT_ROWS = 30
PARTIAL_CHANGE = 0.10
HOLDOUT_ROWS = 14
REASONABLE_ROWS = 14
REASONABLE_BASELINE_ROWS = 90
REASONABLE_HORIZON = 30
QUALITY_GOOD = 0.15
QUALITY_ACCEPTABLE = 0.40
PROXY_MAPE = 0.50
MIN_POST_BREAK_ROWS = 30
MAX_HISTORY_DAYS = 730
SIGNAL_TTL_DAYS = {"forecast_accuracy": 90, "forecast_risk": 90, "reorder_outcome": 90, "cross_sku_learning": 60, "model_health": 30}
FALLBACK_WARN = 0.10
CACHE_HIT_WARN = 0.50
SUCCESS_CRITICAL = 0.90
EXCEPTION_FLAGS = ("stockout", "promo_spike", "unusual_drop", "high_volatility", "forecast_unusually_high", "forecast_unusually_low")

# The 58 tenant parameters and their starting values.
DEFAULTS = {
    "confidence_base_cold_start": 0.50,
    "confidence_base_intermittent": 0.60,
    "confidence_base_seasonal": 0.80,
    "confidence_base_trending": 0.70,
    "confidence_base_stable": 0.90,
    "quantile_cold_start": 0.90,
    "quantile_intermittent": 0.90,
    "quantile_seasonal": 0.90,
    "quantile_trending": 0.80,
    "quantile_stable": 0.80,
    "service_level_target": 0.90,
    "decision_gate_threshold": 0.70,
    "review_suggested_threshold": 0.60,
    "review_required_threshold": 0.45,
    "exception_penalty": 0.80,
    "confidence_floor": 0.30,
    "confidence_ceiling": 0.95,
    "overconfidence_threshold": 0.10,
    "stage8_penalty_threshold": 0.60,
    "stage8_confidence_threshold": 0.65,
    "max_forecast_vs_baseline": 5.00,
    "min_forecast_vs_baseline": 0.10,
    "safety_stock_factor": 0.20,
    "calibration_update_rate": 0.10,
    "thompson_exploration_budget": 3.00,
    "feature_reliability_floor": 0.30,
    "max_promo_multiplier": 3.00,
    "price_elasticity_clearance": -1.50,
    "clearance_markdown_threshold": 0.15,
    "default_backtest_window": 60.00,
    "min_backtest_window": 14.00,
    "max_backtest_window": 90.00,
    "backtest_short_obs_threshold": 60.00,
    "backtest_exploit_obs_threshold": 180.00,
    "size_curve_smoothing_alpha": 0.30,
    "warm_start_max_mape": 0.25,
    "warm_start_min_comps": 3.00,
    "micro_update_threshold_hours": 18.00,
    "structural_break_sensitivity": 0.30,
    "structural_break_confidence_penalty": 0.15,
    "exploit_threshold_new": 8.00,
    "exploit_threshold_developing": 5.00,
    "exploit_threshold_established": 3.00,
    "thompson_exploit_confidence_threshold": 0.60,
    "mape_cap_in_confidence": 0.50,
    "overconfidence_mult": 0.90,
    "underconfidence_mult": 1.10,
    "stage8_penalty_mult": 0.92,
    "insufficient_post_break_mult": 0.75,
    "forecast_unusually_high_mult": 0.85,
    "forecast_unusually_low_mult": 0.90,
    "risk_low_min": 0.85,
    "risk_medium_min": 0.70,
    "model_performance_stable_band": 0.02,
    "min_seasonal_obs_days": 120.00,
    "channel_split_confidence_threshold": 0.50,
    "min_learning_evidence_count": 10.00,
    "quantile_calibration_step": 0.02,
}


class UnknownParam(KeyError):
    """A parameter that no tenant has, or that a tenant lacks."""


class Params(dict):
    """Name -> value; names are looked up, never defaulted."""

    def __missing__(self, name: str) -> float:
        raise UnknownParam(name)


def defaults(**overrides: float) -> Params:
    """The starting values with overrides; an override of an unknown name fails."""
    for name in overrides:
        if name not in DEFAULTS:
            raise UnknownParam(name)
    return Params(DEFAULTS | overrides)


def defaults_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DEFAULTS.items()), "param_name string, value double")


def wide(params: DataFrame) -> DataFrame:
    """One row per tenant with a column per parameter; fails at run time where a tenant lacks one."""
    w = params.groupBy("tenant_id").pivot("param_name", list(DEFAULTS)).agg(F.first("value"))
    held = [F.coalesce(F.col(n), F.raise_error(F.concat(F.lit(f"unknown parameter {n} for tenant "), F.col("tenant_id").cast("string"))).cast("double")).alias(n) for n in DEFAULTS]
    return w.select("tenant_id", *held)


def missing(params: DataFrame) -> DataFrame:
    """(tenant_id, param_name) of the parameters that a tenant lacks."""
    names = defaults_table(params.sparkSession).select("param_name")
    tenants = params.select("tenant_id").distinct()
    want = tenants.withColumn("param_name", F.explode(F.array(*[F.lit(n) for n in DEFAULTS])))
    return want.join(F.broadcast(names), "param_name", "left_semi").join(params.select("tenant_id", "param_name"), ["tenant_id", "param_name"], "left_anti").select("tenant_id", "param_name")


def seeded(params: DataFrame, **overrides: float) -> DataFrame:
    """`params` (tenant_id, param_name, value) with the starting values, or overrides, of what a tenant lacks; what is there stays."""
    start = params.sparkSession.createDataFrame(list(defaults(**overrides).items()), "param_name string, value double")
    return params.unionByName(missing(params).join(F.broadcast(start), "param_name").select("tenant_id", "param_name", "value"))


def ema(current: Column, evidence: Column, rate: Column | float) -> Column:
    """One step of the learning loop: the current value moved towards the evidence."""
    return current + (rate if isinstance(rate, Column) else F.lit(rate)) * (evidence - current)


def ema_update(params: DataFrame, evidence: DataFrame, rate: float = DEFAULTS["calibration_update_rate"]) -> DataFrame:
    """`params` (tenant_id, param_name, value) moved towards `evidence` (tenant_id, param_name, evidence) where there is one."""
    j = params.join(evidence, ["tenant_id", "param_name"], "left")
    return j.withColumn("value", F.coalesce(ema(F.col("value"), F.col("evidence"), rate), F.col("value"))).drop("evidence")
