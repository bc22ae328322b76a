"""The engine's inputs as views over the given star schema: demand, actuals, promotions, channels, signals, forecasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import MAX_HISTORY_DAYS, PATTERN_MODEL, PATTERNS

GRAINS = {"part": "l_partkey", "brand": "p_brand", "type": "p_type"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def daily_demand(spark: SparkSession, sf_dir: str, grain: str = "part") -> DataFrame:
    """(sku, d, qty): one row per item and day with sales. Quantities are summed map-side before the shuffle."""
    raw = table(spark, sf_dir, "lineitem")
    li = raw.select("l_partkey", F.to_date("l_shipdate").alias("d"), "l_quantity")
    if grain != "part":
        li = li.join(table(spark, sf_dir, "part").select("p_partkey", GRAINS[grain]), F.col("l_partkey") == F.col("p_partkey"))
    out = li.groupBy(F.col(GRAINS[grain]).alias("sku"), "d").agg(F.sum("l_quantity").alias("qty"))
    out._last_day = raw.agg(F.to_date(F.max("l_shipdate")).alias("d"))  # of one scanned column, not of the sums
    return out


def as_of(demand: DataFrame) -> Column:
    """The last day of the data as a scalar subquery; nothing reads the clock."""
    last = getattr(demand, "_last_day", None)
    return (demand.agg(F.max("d").alias("d")) if last is None else last).scalar()


def trailing(demand: DataFrame, days: int) -> DataFrame:
    """The rows of the last `days` days up to the last day of the data."""
    return demand.where(F.col("d") > F.date_sub(as_of(demand), days))


def series(demand: DataFrame, days: int | None = MAX_HISTORY_DAYS) -> DataFrame:
    """(sku, ds, q, n): one ordered array of days and quantities per item; null quantities are 0."""
    rows = trailing(demand, days) if days else demand
    s = rows.groupBy("sku").agg(F.sort_array(F.collect_list(F.struct("d", F.coalesce("qty", F.lit(0.0)).alias("qty")))).alias("s"))
    return s.select("sku", F.col("s.d").alias("ds"), F.col("s.qty").alias("q"), F.size("s").alias("n"))


def densify(demand: DataFrame, days: int) -> DataFrame:
    """`demand` of the last `days` days with a row of 0 for every item and day without sales."""
    recent = trailing(demand, days)
    end = as_of(demand)
    grid = recent.select("sku").distinct().withColumn("end", end)
    grid = grid.select("sku", F.explode(F.sequence(F.date_sub("end", days - 1), F.col("end"))).alias("d"))
    return grid.join(recent, ["sku", "d"], "left").select("sku", "d", F.coalesce("qty", F.lit(0.0)).alias("qty"))


def promo_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sku, d, weight): brand days with a line discounted by 8 % or more; weight 1 less the largest discount."""
    li = table(spark, sf_dir, "lineitem").where("l_discount >= 0.08").select("l_partkey", F.to_date("l_shipdate").alias("d"), "l_discount")
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("sku"))
    return li.join(p, F.col("l_partkey") == F.col("p_partkey")).groupBy("sku", "d").agg(F.round(1 - F.max("l_discount"), 4).alias("weight"))


def actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sku, d, qty): what was ordered per part and order day."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("l_partkey").alias("sku"), "d").agg(F.sum("l_quantity").alias("qty"))


def last_order_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row (m): the last day on which anything was ordered; one column of one table, none of the sums."""
    return table(spark, sf_dir, "orders").agg(F.to_date(F.max("o_orderdate")).alias("m"))


def pattern_of(key: Column) -> Column:
    """The stand-in pattern of a part, dealt out by its key."""
    return F.element_at(F.array(*[F.lit(p) for p in PATTERNS]), (key % 5).cast("int") + 1)


def model_of(pattern: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in PATTERN_MODEL.items() for x in kv]), pattern)


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sku, created, pattern, model, quantile, horizon, p50, p80, p90): past forecasts, simulated from the data.

    Made 100, 45 and 10 days before the last order day, from each part's mean daily orders of the year before.
    """
    a = actuals(spark, sf_dir)
    made = last_order_day(spark, sf_dir).select(F.explode(F.array(*[F.date_sub("m", k) for k in (100, 45, 10)])).alias("created"))
    rate = a.join(F.broadcast(made), (F.col("d") < F.col("created")) & (F.col("d") >= F.date_sub("created", 365))).groupBy("sku", "created").agg((F.sum("qty") / 365).alias("rate"))
    f = rate.withColumn("pattern", pattern_of(F.col("sku"))).withColumn("model", model_of(F.col("pattern")))
    f = f.withColumn("quantile", F.when(F.col("pattern").isin("trending", "stable"), F.lit(0.8)).otherwise(F.lit(0.9)))
    f = f.withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in (7, 14, 30, 60, 90)])))
    p = lambda m: F.round(F.col("rate") * F.col("horizon") * m, 4)
    return f.select("sku", "created", "pattern", "model", "quantile", "horizon", p(1.0).alias("p50"), p(1.2).alias("p80"), p(1.4).alias("p90"))


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(signal_id, ts, sku, signal_type, value, payload, expires_at): the event table as a signal bus; errors live 5 days, views for ever, the rest 10 days."""
    e = table(spark, sf_dir, "events")
    ttl = F.when(F.col("event_type") == "error", F.expr("INTERVAL 5 DAYS")).otherwise(F.expr("INTERVAL 10 DAYS"))
    return e.select(
        F.col("event_id").alias("signal_id"), "ts", F.col("user_id").alias("sku"), F.col("event_type").alias("signal_type"), "value", F.col("props").alias("payload"),
        F.when(F.col("event_type") != "view", F.col("ts") + ttl).alias("expires_at"),
    )
