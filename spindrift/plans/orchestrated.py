"""One run of a tenant from its tables to its tables: preload, perceive, plan, act, learn, report.

Items are routed by what changed since the cached fingerprint: unchanged ones take the prior forecast
scaled by their new level, partly changed ones keep their tuned setting's place in the state, all others
(and those without a prior forecast) go through the whole run. Every write is idempotent, so a run that
was broken off may be started again.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from ..functions import models as M
from ..functions import scoring as S
from ..operators import learning as L
from ..operators import runs as U
from ..operators import series as R
from ..operators import sinks as K
from ..sources import registry as G
from . import forecast as W

QUANTILES = ("p50", "p80", "p90")


class Run:
    """`demand`: (sku string, ds, q, n, pattern) of the tenant; `root`: the folder of the tables."""

    def __init__(self, spark: SparkSession, root: str, tenant: str, run: str, demand: DataFrame, clock: Callable[[], datetime] = datetime.now):
        self.spark, self.root, self.tenant, self.run_id, self.demand, self.clock = spark, root.rstrip("/"), tenant, run, demand, clock
        G.up(spark, self.root)

    def table(self, name: str) -> K.Table:
        return K.Table(self.spark, f"{self.root}/{name}")

    def own(self, name: str) -> DataFrame:
        return self.table(name).read().where(F.col("tenant_id") == self.tenant)

    def put(self, name: str, rows: DataFrame, keys: list[str], ignore: bool = False) -> None:
        """Upsert `rows` (or insert those whose key is new) into a table."""
        columns = self.table(name).read().columns
        now, rows = self.table(name).read(), rows.withColumn("tenant_id", F.lit(self.tenant)).select(*columns)
        self.table(name).write(K.insert_ignored(now, rows, keys) if ignore else K.upserted(now, rows, keys))

    def preload(self) -> None:
        q = M.last(F.col("q"), P.FINGERPRINT_ROWS)
        print_ = S.fingerprint(F.col("sku"), q, F.col("pattern"), F.lit(0.0), F.lit(None).cast("string"))
        total = F.aggregate(q, F.lit(0.0), lambda a, x: a + x)
        self.items = self.demand.withColumns({"fingerprint": print_, "total": total})
        self.prior = L.latest(self.own("forecasts").where(F.col("run_id") != self.run_id), ["sku"], F.desc("run_id"))

    def perceive(self) -> None:
        have = {r["param_name"]: r["value"] for r in self.own("params").collect()}  # 58 rows
        lost = sorted(set(P.DEFAULTS) - set(have))
        if lost:
            raise P.UnknownParam(", ".join(lost))
        self.params = P.Params(have)

    def plan(self) -> None:
        cached = self.own("fingerprints").select("sku", F.col("fingerprint").alias("_f"), F.col("pattern").alias("_p"), F.col("total").alias("_t"))
        no = F.lit(False)
        tier = S.processing_tier(F.col("fingerprint"), F.col("_f"), F.col("pattern"), F.col("_p"), F.col("total"), F.col("_t"), no, no)
        known = self.prior.select("sku", F.lit(True).alias("_known"))
        j = self.items.join(cached, "sku", "left").join(known, "sku", "left")
        self.items = j.withColumn("tier", F.when(F.col("_known"), tier).otherwise("full")).drop("_f", "_p", "_t", "_known")

    def _whole(self, items: DataFrame) -> DataFrame:
        f = W.run(items.select("sku", "ds", "q", "n", "pattern"), self.params)
        quant = [F.col(f"forecast_{h}d.{q}").alias(f"{q}_{h}d") for h in P.HORIZONS for q in QUANTILES]
        return f.select("sku", "model", "pattern", "status", "risk", "confidence", "mape", *quant)

    def _scaled(self, items: DataFrame) -> DataFrame:
        scale = items.select("sku", R.level_scale(F.col("q")).alias("scale"))
        quant = [F.bround(F.col(f"{q}_{h}d") * F.col("scale"), 4).alias(f"{q}_{h}d") for h in P.HORIZONS for q in QUANTILES]
        return self.prior.join(scale, "sku").select("sku", "model", "pattern", "status", "risk", "confidence", "mape", *quant)

    def act(self) -> None:
        tiered = lambda branch, name: lambda items: branch(items).withColumn("tier", F.lit(name))
        cache = tiered(self._scaled, "cache")(self.items.where("tier = 'cache'"))
        out = W.routed(self.items, cache, tiered(self._whole, "partial"), tiered(self._whole, "full"))
        self.put("forecasts", out.withColumn("run_id", F.lit(self.run_id)), ["tenant_id", "run_id", "sku"])
        self.results = self.own("forecasts").where(F.col("run_id") == self.run_id)

    def learn(self) -> None:
        self.put("fingerprints", self.items.select("sku", "fingerprint", "pattern", "total"), ["tenant_id", "sku"])
        old = self.own("thompson_state").drop("tenant_id")
        tested = self.results.where("tier <> 'cache'").select("sku", "model", S.config_hash(F.create_map(F.lit("model"), "model")).alias("config_hash"), "mape", F.lit(P.PROXY_MAPE).alias("baseline"))
        self.put("thompson_state", L.thompson_update(old, tested), ["tenant_id", "sku", "model", "config_hash"])

    def report(self) -> None:
        rows = self.results.select("tier", "status", "confidence", F.col("model").isNull().alias("fallback"))
        self.put("assessments", L.run_statistics(rows).withColumn("run_id", F.lit(self.run_id)), ["tenant_id", "run_id"], ignore=True)

    def go(self) -> str:
        stages = dict(zip(U.STAGES, (self.preload, self.perceive, self.plan, self.act, self.learn, self.report)))
        return U.orchestrate(U.StateLog(self.spark, self.root), self.table("runs"), self.tenant, self.run_id, stages, self.clock)
