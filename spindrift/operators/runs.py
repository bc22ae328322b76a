"""Runs of the engine: probes, statuses, the log of states, and the order in which the stages of a run go."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..streaming.signals import InvalidTransition, check_ids, valid_transition
from .sinks import BatchWriter, Table

#: The status at which a run may begin, and those at which it ends.
READY, DONE, BROKEN = "patterns_discovered", "complete", "failed"
#: The stages of a run, in order; a failure of the first four is a state of the log, one of the others is not.
STAGES = ("PRELOADING", "PERCEIVING", "PLANNING", "ACTING", "LEARNING", "REPORTING")
LOG = "tenant_id string, run_id string, from_state string, to_state string, at timestamp, reason string"
KEYS = ["tenant_id", "run_id"]


def exists(rows: DataFrame) -> bool:
    """Whether there is a row; reads no more than it takes to find one."""
    return not rows.limit(1).isEmpty()


def probes(requests: DataFrame, runs: DataFrame, forecasts: DataFrame) -> DataFrame:
    """`requests` (tenant_id, run_id) with triggered (the run is `READY`) and completed (it has forecasts)."""
    ready = runs.where(F.col("status") == READY).select(*KEYS).distinct().withColumn("_t", F.lit(True))
    done = forecasts.select(*KEYS).distinct().withColumn("_c", F.lit(True))
    j = requests.join(ready, KEYS, "left").join(done, KEYS, "left")
    return j.select(*KEYS, F.coalesce("_t", F.lit(False)).alias("triggered"), F.coalesce("_c", F.lit(False)).alias("completed"))


def with_status(runs: DataFrame, changes: DataFrame, at: Column) -> DataFrame:
    """`runs` (tenant_id, run_id, status, updated_at, ...) with the status of `changes` (tenant_id, run_id, status) where there is one; no row is added."""
    new = changes.select(*KEYS, F.col("status").alias("_new"))
    hit = F.col("_new").isNotNull()
    return runs.join(new, KEYS, "left").withColumns({"status": F.coalesce("_new", "status"), "updated_at": F.when(hit, at).otherwise(F.col("updated_at"))}).select(*runs.columns)


class StateLog:
    """An append-only log of states at `root`/state_log."""

    def __init__(self, spark, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def append(self, tenant: str, run: str, a: str, b: str, at: datetime, reason: str | None = None) -> str:
        """Log the step from a to b and return b; an illegal step raises and leaves no row."""
        if not valid_transition(a, b):
            raise InvalidTransition(f"{a} -> {b}")
        out = BatchWriter(self.root, frozenset(("state_log",)))
        out.add("state_log", self.spark.createDataFrame([(tenant, run, a, b, at, reason)], LOG))
        out.flush()
        return b

    def read(self) -> DataFrame:
        return self.spark.read.schema(LOG).parquet(f"{self.root}/state_log")


def orchestrate(log: StateLog, runs: Table, tenant: str, run: str, handlers: dict[str, Callable[[], None]], clock: Callable[[], datetime]) -> str:
    """Run the six stages in order, each logged before it begins; the last state.

    A failure in the first four stages is logged as FAILED with its reason, sets the run's status and is
    raised again; one in learning or reporting is raised with no FAILED row, as the forecasts are there
    already and somebody should look.
    """
    check_ids(tenant, run)
    spark = log.spark

    def finish(status: str) -> None:
        now = runs.read()
        if now is not None:
            runs.write(with_status(now, spark.createDataFrame([(tenant, run, status)], "tenant_id string, run_id string, status string"), F.lit(clock())))

    state = "IDLE"
    try:
        for stage in STAGES:
            state = log.append(tenant, run, state, stage, clock())
            handlers[stage]()
        state = log.append(tenant, run, state, "COMPLETE", clock())
    except Exception as e:
        if valid_transition(state, "FAILED"):
            log.append(tenant, run, state, "FAILED", clock(), str(e)[:2000])
            finish(BROKEN)
        raise
    finish(DONE)
    return state
