"""File sources: CSV with column aliases, schema checks, synthetic series."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..params import PATTERNS

# The names under which CSV files give a column.
ALIASES = {
    "sku_id": ("sku_id", "sku", "item_id", "product_id"),
    "date": ("date", "order_date", "sale_date", "ds"),
    "qty": ("qty", "quantity", "units", "demand", "y"),
    "pattern_label": ("pattern_label", "pattern"),
}
OPTIONAL = {"price": 0.0, "discount_pct": 0.0, "oos_pct": 0.0, "detection_confidence": 0.0, "promo_weight": 1.0, "weekend_zero_ratio": 0.0, "criticality_tier": "B", "on_watchlist": False}


def any_date(c: Column) -> Column:
    """ISO or day-first dates; null for anything else."""
    return F.coalesce(F.try_to_date(c, "yyyy-MM-dd"), F.try_to_date(c, "dd-MM-yyyy"))


def load_csv(spark: SparkSession, path: str, history_days: int | None = None, default_pattern: str = "stable") -> DataFrame:
    """(sku_id, date, qty, pattern_label, optional columns): aliases resolved, bad or negative quantities 0, unknown patterns dropped.

    history_days keeps each item's rows after its last day less that many days.
    """
    raw = spark.read.option("header", True).csv(path)
    have = {c.strip().lower(): c for c in raw.columns}
    found = {to: next((have[a] for a in names if a in have), None) for to, names in ALIASES.items()}
    lacking = [to for to in ("sku_id", "date", "qty") if not found[to]]
    if lacking:
        raise ValueError(f"no column for {', '.join(lacking)} in {path}")
    col = lambda to: F.col(f"`{found[to]}`")
    qty = F.greatest(F.coalesce(F.expr(f"try_cast(`{found['qty']}` as double)"), F.lit(0.0)), F.lit(0.0))
    label = F.lower(F.trim(col("pattern_label"))) if found["pattern_label"] else F.lit(default_pattern)
    more = [(F.expr(f"try_cast(`{have[n]}` as {'double' if isinstance(v, float) else 'boolean' if isinstance(v, bool) else 'string'})") if n in have else F.lit(None)) for n, v in OPTIONAL.items()]
    out = raw.select(col("sku_id").alias("sku_id"), any_date(col("date")).alias("date"), qty.alias("qty"), label.alias("pattern_label"), *[F.coalesce(c, F.lit(v)).alias(n) for c, (n, v) in zip(more, OPTIONAL.items())])
    out = out.where(F.col("date").isNotNull() & F.col("pattern_label").isin(*PATTERNS))
    if history_days:
        last = out.groupBy("sku_id").agg(F.max("date").alias("_last"))
        out = out.join(last, "sku_id").where(F.col("date") > F.date_sub("_last", history_days)).drop("_last")
    return out


def schema_faults(df: DataFrame, expected: StructType) -> list[str]:
    """What `df` lacks against `expected`: missing columns and other types."""
    have = {f.name: f.dataType for f in df.schema}
    lost = [f"missing column {f.name}" for f in expected if f.name not in have]
    return lost + [f"{f.name}: {have[f.name].simpleString()} instead of {f.dataType.simpleString()}" for f in expected if f.name in have and have[f.name] != f.dataType]


def synthetic(spark: SparkSession, sku: str, days: int, level: float, slope: float = 0.0, cv: float = 0.1, weekly: float = 0.0, annual: float = 0.0, zero_share: float = 0.0, b2b: bool = False, seed: int = 42, start: str = "2024-01-01") -> DataFrame:
    """(sku, d, qty): level, slope, weekly and annual waves with noise, weekends and random days set to 0.

    Low means (under 5) get Poisson-like noise by the inverse of its distribution function, others normal
    noise; every number is a function of the seed.
    """
    t = F.col("id").cast("double")
    mean = F.greatest(F.lit(0.0), level + slope * t + level * weekly * F.cos(2 * math.pi * t / 7) + level * annual * F.cos(2 * math.pi * t / 365))
    base = spark.range(0, days, 1, 1).withColumns({"mean": mean, "z": F.randn(seed), "u": F.rand(seed + 1), "v": F.rand(seed + 2)})
    steps = F.aggregate(
        F.sequence(F.lit(1), F.lit(30)),
        F.struct(F.exp(-F.col("mean")).alias("p"), F.exp(-F.col("mean")).alias("c"), F.when(F.col("u") > F.exp(-F.col("mean")), 1).otherwise(0).alias("n")),
        lambda a, k: F.struct((a["p"] * F.col("mean") / k).alias("p"), (a["c"] + a["p"] * F.col("mean") / k).alias("c"), (a["n"] + F.when(F.col("u") > a["c"] + a["p"] * F.col("mean") / k, 1).otherwise(0)).alias("n")),
        lambda a: a["n"].cast("double"),
    )
    qty = F.when(F.col("mean") < 5, steps).otherwise(F.greatest(F.lit(0.0), F.round(F.col("mean") * (1 + cv * F.col("z")))))
    d = F.date_add(F.to_date(F.lit(start)), F.col("id").cast("int"))
    idle = (F.col("v") < zero_share) | (F.lit(b2b) & (F.weekday(d) >= 5))
    return base.select(F.lit(sku).alias("sku"), d.alias("d"), F.when(idle, F.lit(0.0)).otherwise(qty).alias("qty"))


#: The scenarios of the synthetic matrix: days, pattern and generator arguments.
SCENARIOS = {
    "cold_start_25d": ("cold_start", dict(days=25, level=20.0)),
    "cold_start_45d_lowvol": ("cold_start", dict(days=45, level=3.0)),
    "stable_60d": ("stable", dict(days=60, level=50.0)),
    "stable_90d": ("stable", dict(days=90, level=50.0)),
    "stable_365d": ("stable", dict(days=365, level=50.0)),
    "trending_60d_up": ("trending", dict(days=60, level=20.0, slope=0.5)),
    "trending_120d_up": ("trending", dict(days=120, level=20.0, slope=0.5)),
    "trending_180d_down": ("trending", dict(days=180, level=120.0, slope=-0.4)),
    "seasonal_180d_weekly": ("seasonal", dict(days=180, level=40.0, weekly=0.4)),
    "seasonal_365d_annual": ("seasonal", dict(days=365, level=40.0, weekly=0.2, annual=0.4)),
    "intermittent_90d": ("intermittent", dict(days=90, level=8.0, zero_share=0.6)),
    "intermittent_180d_b2b": ("intermittent", dict(days=180, level=8.0, zero_share=0.4, b2b=True)),
    "intermittent_365d_extreme": ("intermittent", dict(days=365, level=6.0, zero_share=0.9)),
}


def scenario(spark: SparkSession, name: str, seed: int = 42) -> DataFrame:
    return synthetic(spark, name, seed=seed, **SCENARIOS[name][1])
