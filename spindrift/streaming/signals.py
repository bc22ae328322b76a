"""The signal bus: emission with time to live, peeking, exactly-once consumption, windows, run states.

Batch forms read a table of signals; streaming forms are Structured Streaming plans whose checkpoint gives
exactly-once, in place of row locks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..params import SIGNAL_TTL_DAYS

# The states of a run and its legal transitions.
TRANSITIONS = (
    ("IDLE", "PRELOADING"), ("COMPLETE", "IDLE"), ("FAILED", "IDLE"),
    ("PRELOADING", "PERCEIVING"), ("PERCEIVING", "PLANNING"), ("PLANNING", "ACTING"), ("ACTING", "LEARNING"), ("LEARNING", "REPORTING"), ("REPORTING", "COMPLETE"),
    ("PRELOADING", "FAILED"), ("PERCEIVING", "FAILED"), ("PLANNING", "FAILED"), ("ACTING", "FAILED"),
)
TENANT_ID = "^[A-Za-z0-9-]{1,64}$"
RUN_ID = "^[A-Za-z0-9_-]{1,128}$"


class InvalidTransition(ValueError):
    pass


def emit(rows: DataFrame, signal_type: str, at: Column, payload: list[str]) -> DataFrame:
    """Signals of one type: the payload columns as JSON, confidence clamped to [0, 1], and the expiry of the type."""
    if signal_type not in SIGNAL_TTL_DAYS:
        raise ValueError(f"unknown signal type {signal_type}")
    conf = F.least(F.greatest(F.coalesce(F.col("confidence"), F.lit(1.0)), F.lit(0.0)), F.lit(1.0)) if "confidence" in rows.columns else F.lit(1.0)
    return rows.select("tenant_id", "sku", F.lit(signal_type).alias("signal_type"), F.to_json(F.struct(*payload)).alias("payload"), conf.alias("confidence"), at.alias("ts"), (at + F.expr(f"INTERVAL {SIGNAL_TTL_DAYS[signal_type]} DAYS")).alias("expires_at"))


def accuracy_signals(backtests: DataFrame, at: Column) -> DataFrame:
    return emit(backtests, "forecast_accuracy", at, ["model", "mape"])


def risk_signals(forecasts: DataFrame, at: Column) -> DataFrame:
    """Only items at medium or high risk."""
    return emit(forecasts.where("risk in ('medium', 'high')"), "forecast_risk", at, ["risk", "status"])


def cross_sku_signals(backtests: DataFrame, at: Column, threshold: float = 0.15) -> DataFrame:
    """Only settings good enough for others to learn from."""
    return emit(backtests.where(F.col("mape") < threshold), "cross_sku_learning", at, ["model", "mape"])


def health_signals(health: DataFrame, at: Column) -> DataFrame:
    return emit(health, "model_health", at, ["model", "trend"])


def replaced_health(signals: DataFrame, fresh: DataFrame) -> DataFrame:
    """`signals` with the health signals of the tenants in `fresh` taken out and `fresh` put in; twice is once."""
    tenants = fresh.select("tenant_id").distinct()
    stale = signals.where("signal_type = 'model_health'").join(F.broadcast(tenants), "tenant_id", "left_semi")
    return signals.exceptAll(stale).unionByName(fresh)


def live(signals: DataFrame, now: Column) -> DataFrame:
    """Signals without an expiry or not yet expired."""
    return signals.where(F.col("expires_at").isNull() | (F.col("expires_at") > now))


def peek(signals: DataFrame, now: Column, signal_type: str | None = None, sku: object = None, claimed: DataFrame | None = None, limit: int = 5) -> DataFrame:
    """The newest live signals that nobody has claimed; sku None: any (null-safe equality otherwise)."""
    s = live(signals, now)
    if signal_type is not None:
        s = s.where(F.col("signal_type") == signal_type)
    if sku is not None:
        s = s.where(F.col("sku").eqNullSafe(F.lit(sku)))
    if claimed is not None:
        s = s.join(claimed.select("signal_id"), "signal_id", "left_anti")
    return s.orderBy(F.desc("ts"), F.desc("signal_id")).limit(limit)


def consume(signals: DataFrame, claimed: DataFrame, now: Column, signal_type: str) -> DataFrame:
    """Live signals of the type that are not claimed; append their ids to the claims in the same commit."""
    return live(signals, now).where(F.col("signal_type") == signal_type).join(claimed.select("signal_id"), "signal_id", "left_anti")


def payload_number(payload: Column, field: str) -> Column:
    return F.try_variant_get(F.try_parse_json(payload), f"$.{field}", "double")


def stream(spark: SparkSession, path: str, files: int = 1000) -> DataFrame:
    """The signal directory as a stream with event time `ts` (UTC)."""
    schema = spark.read.parquet(path).schema
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, size: str = "1 hour", late: str | None = None) -> DataFrame:
    """Count and total per type and window; `late` sets a watermark (streams)."""
    e = events.withWatermark("ts", late) if late else events
    g = e.groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return g.select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, size: str = "6 hours", step: str = "3 hours", late: str | None = None) -> DataFrame:
    e = events.withWatermark("ts", late) if late else events
    g = e.groupBy(F.window("ts", size, step), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return g.select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "2 hours", late: str | None = None) -> DataFrame:
    """Runs of a user's events with less than `gap` between neighbours."""
    e = events.withWatermark("ts", late) if late else events
    g = e.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return g.select("user_id", F.col("w.start").alias("start"), "n")


def run_once(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Drain what is there into `sink` (called once per batch id) and stop; a restart goes on from the checkpoint."""
    return df.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def check_ids(tenant: str, run: str) -> None:
    import re

    if not re.match(TENANT_ID, tenant or "") or not re.match(RUN_ID, run or ""):
        raise ValueError("bad tenant or run id")


def valid_transition(a: str, b: str) -> bool:
    return (a, b) in TRANSITIONS


def invalid_transitions(log: DataFrame) -> DataFrame:
    """Rows of a state log (run_id, seq, state) that do not follow from the one before; the first must be IDLE or PRELOADING."""
    from pyspark.sql import Window

    legal = log.sparkSession.createDataFrame([*TRANSITIONS, ("", "IDLE"), ("", "PRELOADING")], "prior string, state string")
    prior = F.coalesce(F.lag("state").over(Window.partitionBy("run_id").orderBy("seq")), F.lit(""))
    return log.withColumn("prior", prior).join(F.broadcast(legal), ["prior", "state"], "left_anti")


def pending_runs(runs: DataFrame, limit: int = 50) -> DataFrame:
    return runs.where(F.col("status").isin("PENDING", "RETRY", "TRIGGERED")).orderBy(F.asc("updated_at"), F.asc("run_id")).limit(limit)
