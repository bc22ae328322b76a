"""Registered queries over the engine's records: states, caches, logs, parameters, signals and whole runs.

Those that write do so in a folder of their own under `spark.checkpoint.dir` and return what a reader gets.
"""

from __future__ import annotations

import tempfile
import uuid
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
from ..sources import files as I
from ..sources import registry as G
from ..sources import views as V
from ..streaming import signals as B
from . import forecast as W
from . import orchestrated as O
from . import tuning as T
from .queries import _EVENTS, _FP, _HOLT, _SPLIT, _TS, D_BRAND, FC, OUT, S_BRAND, SIG, _brand, _outcomes, _part, _prints, _r, _thompson, query


def _folder(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp(prefix="spindrift-")
    return f"{root.rstrip('/')}/records-{uuid.uuid4().hex}"


# ---- sources


@query(f"WITH {SIG}, now AS (SELECT max(ts) AS t FROM sig), r AS (SELECT sku, signal_id, value, row_number() OVER (PARTITION BY sku ORDER BY ts DESC, signal_id DESC) AS rn FROM sig, now WHERE signal_type = 'error' AND (expires_at IS NULL OR expires_at > t)) SELECT sku, signal_id, value FROM r WHERE rn = 1")
def oos_latest_unexpired(spark, d):
    s = V.signals(spark, d)
    live = B.live(s, s.agg(F.max("ts").alias("t")).scalar()).where("signal_type = 'error'")
    return L.latest(live, ["sku"], F.desc("ts"), F.desc("signal_id")).select("sku", "signal_id", "value")


@query("WITH c AS (SELECT n_regionkey AS tenant, l_partkey AS sku, CAST(l_shipdate AS DATE) AS d, l_shipmode AS channel, CAST(sum(l_quantity) AS BIGINT) AS qty FROM (SELECT *, l_returnflag || l_linestatus AS l_shipmode FROM lineitem) l JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey % 2 = 0 GROUP BY ALL) SELECT tenant, sku, string_agg(CAST(d AS VARCHAR) || '/' || channel || '/' || qty, ',' ORDER BY d, channel, qty) AS splits FROM c GROUP BY 1, 2")
def channel_splits_gated(spark, d):
    li = V.table(spark, d, "lineitem").select("l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("d"), F.concat("l_returnflag", "l_linestatus").alias("channel"), "l_quantity")
    s = V.table(spark, d, "supplier").join(F.broadcast(V.table(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_regionkey").alias("tenant"))
    rows = li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("tenant", F.col("l_partkey").alias("sku"), "d", "channel").agg(F.sum("l_quantity").cast("long").alias("qty"))
    modes = V.table(spark, d, "region").select(F.col("r_regionkey").alias("tenant"), F.when(F.col("r_regionkey") % 2 == 0, "multi_channel").otherwise("single").alias("pipeline_mode"))
    out = R.channel_splits(rows, modes)
    return out.select("tenant", "sku", F.array_join(F.transform("splits", lambda x: F.concat_ws("/", x["d"].cast("string"), x["channel"], x["qty"].cast("string"))), ",").alias("splits"))


def _params(spark: SparkSession, d: str) -> DataFrame:
    """(tenant_id, param_name, value): the 58 parameters of each region, a thousandth per region's key above their starting value."""
    r = V.table(spark, d, "region").select(F.col("r_regionkey").alias("tenant_id"))
    return r.join(F.broadcast(P.defaults_table(spark)), F.lit(True)).withColumn("value", F.round(F.col("value") + F.col("tenant_id") * 0.001, 6))


_DEFAULTS = "(VALUES " + ", ".join(f"('{n}', {v}::DOUBLE)" for n, v in P.DEFAULTS.items()) + ") t(param_name, v)"
_PARAMS = f"pa AS (SELECT r_regionkey AS tenant_id, param_name, round(v + r_regionkey * 0.001::DOUBLE, 6) AS value FROM region, {_DEFAULTS})"


@query(f"WITH {_PARAMS} SELECT tenant_id, max(value) FILTER (param_name = 'confidence_floor') AS floor, max(value) FILTER (param_name = 'confidence_ceiling') AS ceiling FROM pa WHERE tenant_id = 3 GROUP BY 1")
def tenant_thresholds_row(spark, d):
    w = P.wide(_params(spark, d).where("tenant_id = 3"))
    return w.select("tenant_id", F.col("confidence_floor").alias("floor"), F.col("confidence_ceiling").alias("ceiling")).limit(1)


@query(f"WITH {_PARAMS} SELECT tenant_id, " + ", ".join(f"max(value) FILTER (param_name = '{n}') AS {n}" for n in P.DEFAULTS) + " FROM pa GROUP BY 1")
def tenant_params_wide(spark, d):
    return P.wide(_params(spark, d))


_HELD = f"{_PARAMS}, held AS (SELECT * FROM pa WHERE (length(param_name) + tenant_id) % 7 <> 0)"


def _held(spark: SparkSession, d: str) -> DataFrame:
    return _params(spark, d).where((F.length("param_name") + F.col("tenant_id")) % 7 != 0)


@query(f"WITH {_HELD} SELECT tenant_id, param_name FROM pa EXCEPT SELECT tenant_id, param_name FROM held")
def missing_parameters(spark, d):
    return P.missing(_held(spark, d)).select("tenant_id", "param_name")


@query(f"WITH {_HELD} SELECT tenant_id, param_name, value FROM held UNION ALL SELECT pa.tenant_id, param_name, CASE WHEN param_name = 'confidence_floor' THEN 0.25 ELSE v END FROM pa JOIN {_DEFAULTS} USING (param_name) WHERE (length(param_name) + tenant_id) % 7 = 0")
def params_seeded(spark, d):
    return P.seeded(_held(spark, d), confidence_floor=0.25)


@query(f"WITH {_TS} SELECT sku, model, count(*) AS n, min(config_hash) AS first_config, string_agg(config_hash || ':' || CAST(alpha AS BIGINT) || ':' || CAST(beta AS BIGINT), ',' ORDER BY config_hash) AS state FROM ts GROUP BY 1, 2")
def thompson_state_map(spark, d):
    m = L.thompson_map(_thompson(spark, d))
    shown = F.transform("hashes", lambda h: F.concat_ws(":", h, F.element_at("state", h)["alpha"].cast("string"), F.element_at("state", h)["beta"].cast("string")))
    return m.select("sku", "model", F.size("state").cast("long").alias("n"), F.col("first_config"), F.array_join(shown, ",").alias("state"))


@query("SELECT sku, features FROM (SELECT user_id AS sku, props AS features, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def latest_feature_set(spark, d):
    e = V.table(spark, d, "events").select(F.col("user_id").alias("sku"), F.col("props").alias("features"), "ts", "event_id")
    return L.latest(e, ["sku"], F.desc("ts"), F.desc("event_id")).select("sku", "features")


_WIDE = [f"h{h}_{q}" for h in (7, 14, 30, 60, 90) for q in ("p50", "p80", "p90")]


@query(f"WITH {FC}, w AS (SELECT sku, created, pattern, model, quantile, " + ", ".join(f"max({c[-3:]}) FILTER (horizon = {c[1:-4]}) AS {c}" for c in _WIDE) + f" FROM fc GROUP BY 1, 2, 3, 4, 5), r AS (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY created DESC) AS rn, count(*) OVER (PARTITION BY sku) AS n_prior FROM w) SELECT sku, created, pattern, model, quantile, n_prior, h90_p90 >= h7_p50 AS rising, {', '.join(_WIDE)} FROM r WHERE rn = 1")
def latest_prior_forecast(spark, d):
    f = V.forecasts(spark, d)
    w = f.groupBy("sku", "created", "pattern", "model", "quantile").agg(*[F.max(F.when(F.col("horizon") == int(c[1:-4]), F.col(c[-3:]))).alias(c) for c in _WIDE])
    n = w.groupBy("sku").agg(F.count("*").alias("n_prior"))
    return L.latest(w, ["sku"], F.desc("created")).join(n, "sku").select("sku", "created", "pattern", "model", "quantile", "n_prior", (F.col("h90_p90") >= F.col("h7_p50")).alias("rising"), *_WIDE)


@query(f"WITH {D_BRAND} SELECT sku AS sku_id, d AS date, CASE WHEN qty > 200 THEN 0.0 ELSE qty END AS qty, 'stable' AS pattern_label, 0.0::DOUBLE AS price, 1.0::DOUBLE AS promo_weight FROM db")
def csv_with_aliases(spark, d):
    path = _folder(spark)
    rows = _brand(spark, d).select(F.col("sku").alias("Product_ID"), F.date_format("d", "dd-MM-yyyy").alias("order_date"), F.when(F.col("qty") > 200, F.lit("many")).otherwise(F.col("qty").cast("string")).alias("Units"))
    rows.write.option("header", True).csv(path)
    return I.load_csv(spark, path).select("sku_id", "date", "qty", "pattern_label", "price", "promo_weight")


@query("SELECT 'a' AS sku, CAST(DATE '2024-01-01' + CAST(t AS INTEGER) AS DATE) AS d, greatest(0.0, round(greatest(0.0, 20.0 + 0.5 * t + 20.0 * 0.4 * cos(2 * pi() * t / 7)) * 1.0)) AS qty FROM range(0, 120) r(t)")
def synthetic_weekly_trend(spark, d):
    return I.synthetic(spark, "a", 120, 20.0, slope=0.5, cv=0.0, weekly=0.4)


@query("SELECT * FROM (VALUES ('region', 'missing column r_zone'), ('nation', 'n_nationkey: int instead of string'), ('stores', 'missing table')) t(table_name, fault)")
def schema_verification(spark, d):
    want = {"region": "r_regionkey int, r_name string, r_zone string", "nation": "n_nationkey string, n_name string", "stores": "id bigint", "customer": "c_name string"}
    return G.faults(spark, {n: None if n == "stores" else V.table(spark, d, n) for n in want}, want)


@query("SELECT * FROM (VALUES " + ", ".join(f"('{n}', {len(s.split(','))}, 0)" for n, s in G.TABLES.items()) + ") t(table_name, n_columns, n_rows)")
def schema_registry_up(spark, d):
    root = _folder(spark)
    G.up(spark, root)
    assert not U.exists(G.verify(spark, root)) and not G.up(spark, root)
    counts = [(n, len(t.columns), t.count()) for n in G.TABLES for t in (K.Table(spark, f"{root}/{n}").read(),)]
    G.down(spark, root)
    assert G.verify(spark, root).count() == len(G.TABLES)
    return spark.createDataFrame(counts, "table_name string, n_columns int, n_rows int")


_RUNS = "rn AS (SELECT 'T' || (o_custkey % 5) AS tenant_id, 'R' || o_orderkey AS run_id, CASE o_orderstatus WHEN 'O' THEN 'patterns_discovered' WHEN 'F' THEN 'complete' ELSE 'running' END AS status, CAST(o_orderdate AS TIMESTAMP) AS updated_at FROM orders)"


def _runs(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "O", "patterns_discovered").when(F.col("o_orderstatus") == "F", "complete").otherwise("running")
    return V.table(spark, d, "orders").select(F.concat(F.lit("T"), F.col("o_custkey") % 5).alias("tenant_id"), F.concat(F.lit("R"), "o_orderkey").alias("run_id"), status.alias("status"), F.col("o_orderdate").cast("timestamp_ntz").alias("updated_at"), "o_orderkey")


@query(f"WITH {_RUNS} SELECT tenant_id, run_id, EXISTS (SELECT 1 FROM rn r WHERE r.tenant_id = q.tenant_id AND r.run_id = q.run_id AND r.status = 'patterns_discovered') AS triggered, EXISTS (SELECT 1 FROM lineitem WHERE 'R' || l_orderkey = q.run_id AND l_returnflag = 'R') AS completed FROM rn q")
def existence_probes(spark, d):
    runs = _runs(spark, d)
    done = V.table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return U.probes(runs.select("tenant_id", "run_id"), runs, runs.join(done, "o_orderkey", "left_semi"))


@query("SELECT p.p_partkey AS sku, q.style, q.n FROM part p JOIN (SELECT p_brand, p_type, min(p_partkey) AS style, count(*) AS n FROM part GROUP BY 1, 2) q ON p.p_brand = q.p_brand AND p.p_type = q.p_type WHERE p.p_partkey <> q.style")
def parent_styles(spark, d):
    return R.parent_styles(V.table(spark, d, "part").withColumnRenamed("p_partkey", "sku"), ["p_brand", "p_type"])


@query("WITH e AS (SELECT event_id, CASE WHEN user_id % 5 <> 0 THEN user_id END AS sku FROM events), k AS (SELECT DISTINCT sku FROM e) SELECT coalesce(k.sku, -1) AS sku, count(*) AS n, min(event_id) AS first_id FROM k JOIN e ON e.sku IS NOT DISTINCT FROM k.sku GROUP BY 1")
def null_safe_lookup(spark, d):
    e = V.table(spark, d, "events").select("event_id", F.when(F.col("user_id") % 5 != 0, F.col("user_id")).alias("sku"))
    k = e.select("sku").distinct()
    return k.alias("k").join(e.alias("e"), F.col("k.sku").eqNullSafe(F.col("e.sku"))).groupBy("k.sku").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id")).withColumn("sku", F.coalesce("sku", F.lit(-1)))


# ---- cleaning, hashing, texts


@query("SELECT user_id AS sku, count(*) AS n, round(sum(CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0 THEN 0.0 ELSE value END), 4) AS total FROM events GROUP BY 1")
def non_finite_to_zero(spark, d):
    v = F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).when(F.col("event_id") % 11 == 0, F.lit(float("-inf"))).when(F.col("event_id") % 13 == 0, F.lit(None)).otherwise(F.col("value"))
    q = V.table(spark, d, "events").groupBy(F.col("user_id").alias("sku")).agg(F.sort_array(F.collect_list(F.struct("event_id", v.alias("v")))).alias("s"))
    c = M.clean(F.col("s.v"))
    return q.select("sku", F.size(c).cast("long").alias("n"), _r(F.aggregate(c, F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


@query("SELECT p_partkey AS sku, sha256('alpha=' || (p_size % 5) || ',lag=7,variant=' || p_brand) AS config_hash FROM part")
def config_hash_sorted(spark, d):
    m = F.create_map(F.lit("variant"), F.col("p_brand"), F.lit("lag"), F.lit("7"), F.lit("alpha"), (F.col("p_size") % 5).cast("string"))
    return V.table(spark, d, "part").select(F.col("p_partkey").alias("sku"), S.config_hash(m).alias("config_hash"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 OR c_custkey % 10 = 0 THEN NULL ELSE greatest(-99.0, least(99.0, c_acctbal / 50)) END AS metric FROM customer")
def metric_clamp(spark, d):
    x = F.when(F.col("c_custkey") % 9 == 0, F.lit(float("nan"))).when(F.col("c_custkey") % 10 == 0, F.lit(float("inf"))).otherwise(F.col("c_acctbal") / 50)
    return V.table(spark, d, "customer").select("c_custkey", S.clamp_metric(x).alias("metric"))


_HEALTH = "he AS (SELECT model, avg(error) FILTER (horizon = 30) AS mape, avg(error) FILTER (horizon = 14) AS prior_mape FROM outs WHERE error IS NOT NULL GROUP BY 1)"


def _health(spark: SparkSession, d: str) -> DataFrame:
    p = L.performance(_outcomes(spark, d))
    return L.model_health(p.where("horizon = 30"), p.where("horizon = 14"))


@query(f"WITH {OUT}, {_HEALTH}, m AS (SELECT avg(mape) AS mape, avg(prior_mape) AS prior_mape FROM he) SELECT round(mape, 6) AS mape, round(prior_mape, 6) AS prior_mape, CASE WHEN prior_mape > 0 THEN round((mape - prior_mape) / prior_mape * 100, 5) END AS delta_pct FROM m")
def assessment_means(spark, d):
    a = L.assessment_means(_health(spark, d))
    return a.select(_r("mape").alias("mape"), _r("prior_mape").alias("prior_mape"), _r("delta_pct", 5).alias("delta_pct"))


@query("SELECT CASE WHEN r_regionkey % 2 = 0 THEN 'model ' || r_regionkey END AS topic, printf('error rose by %.1f%% over the prior 30 days (now %.3f, before %.3f): check the inputs of this pattern, widen the search budget', 25.0, 0.5, 0.25) AS advice FROM region WHERE r_regionkey % 2 = 0 UNION ALL SELECT 'fallback', '7 of 25 items used the fallback model: check input quality and schema' UNION ALL SELECT 'cache', 'only 3 of 25 items came from the cache: demand is volatile or fingerprints are unstable'")
def recommendation_texts(spark, d):
    k = F.col("r_regionkey")
    health = V.table(spark, d, "region").select(F.concat(F.lit("model "), k).alias("model"), F.lit(0.5).alias("mape"), F.lit(0.25).alias("prior_mape"), F.lit(0.25).alias("delta"), F.when(k % 2 == 0, "degrading").otherwise("stable").alias("trend"))
    n = V.table(spark, d, "nation").select((F.col("n_nationkey") < 3).alias("hit"), (F.col("n_nationkey") < 7).alias("fallback"))
    results = n.select(F.when(F.col("hit"), "cache").otherwise("full").alias("tier"), F.lit("forecasted").alias("status"), F.lit(0.8).alias("confidence"), "fallback")
    return L.recommendations(health, L.run_statistics(results))


# ---- models


@query(f"WITH {_EVENTS.replace('ev AS', 'few AS (SELECT sku, list(CAST(qty AS DOUBLE) ORDER BY d) AS q FROM dn GROUP BY 1 HAVING count(*) FILTER (qty > 0) < 2), ev AS')} SELECT sku, round(list_reduce(q, lambda s, x: 0.3::DOUBLE * x + 0.7::DOUBLE * s), 6) AS rate FROM few")
def croston_fallback(spark, d):
    s = V.series(V.densify(_part(spark, d), 90), None).where(F.size(F.filter("q", lambda x: x > 0)) < 2)
    return s.select("sku", _r(M.croston_rate(F.col("q"), 0.1, "SBA")).alias("rate"))


_TAIL = "tail AS (SELECT ev.sku, ev.e[1].z AS z0, ev.e[1].i AS i0, list({'x': CAST(qty AS DOUBLE), 'z': 0.0::DOUBLE, 'p': 0.0::DOUBLE} ORDER BY i) FILTER (i > ev.e[1].i) AS q FROM ev JOIN r USING (sku) WHERE len(e) >= 2 GROUP BY ALL)"
_TSB = " UNION ALL ".join(f"SELECT sku, {a}::DOUBLE AS alpha, list_reduce(q, lambda s, x: {{'x': 0.0::DOUBLE, 'z': CASE WHEN x.x > 0 THEN {a}::DOUBLE * x.x + (1 - {a}::DOUBLE) * s.z ELSE s.z END, 'p': CASE WHEN x.x > 0 THEN {a}::DOUBLE ELSE 0.0::DOUBLE END + (1 - {a}::DOUBLE) * s.p}}, {{'x': 0.0::DOUBLE, 'z': CAST(z0 AS DOUBLE), 'p': 1.0::DOUBLE / i0}}) AS s FROM tail" for a in (0.05, 0.1, 0.2))


@query(f"WITH {_EVENTS}, {_TAIL}, s AS ({_TSB}) SELECT sku, alpha, round(s.z * s.p, 6) AS rate FROM s")
def croston_tsb_grid(spark, d):
    s = V.series(V.densify(_part(spark, d), 90), None).where(F.size(F.filter("q", lambda x: x > 0)) >= 2)
    s = s.select("sku", "q", F.explode(F.array(*[F.lit(a) for a, v in M.CROSTON_GRID if v == "TSB"])).alias("alpha"))
    return s.select("sku", "alpha", _r(M.croston_rate(F.col("q"), F.col("alpha"), "TSB")).alias("rate"))


_HOLTS = " UNION ALL ".join(f"SELECT sku, {a}::DOUBLE AS alpha, {b}::DOUBLE AS beta, {str(damped).upper()} AS damped, {_HOLT.format(q='q', a=f'{a}::DOUBLE', b=f'{b}::DOUBLE', p=f'{M.PHI if damped else 1.0}::DOUBLE')} AS s FROM sb WHERE n > 2" for a, b, damped in M.HOLT_GRID)


@query(f"WITH {S_BRAND}, g AS ({_HOLTS}) SELECT sku, alpha, beta, damped, round(s.l, 5) AS level, round(s.t, 5) AS trend FROM g")
def holt_grid(spark, d):
    grid = F.array(*[F.struct(F.lit(a).alias("alpha"), F.lit(b).alias("beta"), F.lit(damped).alias("damped")) for a, b, damped in M.HOLT_GRID])
    s = V.series(_brand(spark, d)).where("n > 2").select("sku", "q", F.explode(grid).alias("g")).select("sku", "q", "g.*")
    phi = F.when(F.col("damped"), M.PHI).otherwise(1.0)
    s = s.withColumn("s", M.holt_state(F.col("q"), F.col("alpha"), F.col("beta"), phi))
    return s.select("sku", "alpha", "beta", "damped", _r("s.l", 5).alias("level"), _r("s.t", 5).alias("trend"))


@query(_SPLIT + ", m AS (SELECT sku, list_reduce(list_transform(tr, lambda x: CAST(x AS DOUBLE)), lambda a, x: 0.3::DOUBLE * x + 0.7::DOUBLE * a) AS level, te[len(te)] AS naive, sku LIKE '%3' AS failed FROM t) SELECT sku, round(CASE WHEN failed THEN naive ELSE level END, 6) AS level, failed AS used_fallback FROM m")
def fallback_results(spark, d):
    s = R.split(V.series(_brand(spark, d)))
    level = s.where(~F.col("sku").endswith("3")).select("sku", M.ses_level(F.col("train"), 0.3).alias("level"))
    naive = s.select("sku", M.naive_level(F.col("q"), 1, "last_value").alias("level"))
    return T.with_fallback(level, naive).select("sku", _r("level").alias("level"), "used_fallback")


def _grid_sql() -> str:
    """The mean errors of every setting on the last 14 rows, by model (Brand..1: naive, ..2: Holt, others: smoothing)."""
    flat = "list_avg(list_transform(list_filter(te, lambda y: y <> 0), lambda y: abs((y - level) / y)))"
    naive = {"last_value": 1, "mean_3d": 3, "mean_7d": 7}
    parts = [f"SELECT sku, {k} AS k, 'naive_forecast' AS model, {flat} AS mape FROM (SELECT *, greatest(0.0, list_avg(tr[len(tr) - least({lag}, {naive[how]}) + 1:])) AS level FROM t WHERE sku LIKE '%1')" for k, (lag, how) in enumerate(M.NAIVE_GRID)]
    parts += [f"SELECT sku, {k}, 'simple_exponential_smoothing', {flat} FROM (SELECT *, list_reduce(list_transform(tr, lambda x: CAST(x AS DOUBLE)), lambda s, x: {a}::DOUBLE * x + (1 - {a}::DOUBLE) * s) AS level FROM t WHERE sku NOT LIKE '%1' AND sku NOT LIKE '%2')" for k, a in enumerate(M.SES_GRID)]
    for k, (a, b, damped) in enumerate(M.HOLT_GRID):
        state = _HOLT.format(q="tr", a=f"{a}::DOUBLE", b=f"{b}::DOUBLE", p=f"{M.PHI if damped else 1.0}::DOUBLE")
        reach = f"({M.PHI}::DOUBLE * (1 - power({M.PHI}::DOUBLE, i)) / (1 - {M.PHI}::DOUBLE))" if damped else "i"
        parts.append(f"SELECT sku, {k}, 'holts_linear_trend', list_avg(list_transform(list_filter(range(1, 15), lambda i: te[i] <> 0), lambda i: abs((te[i] - greatest(0.0, s.l + s.t * {reach})) / te[i]))) FROM (SELECT sku, te, {state} AS s FROM t WHERE sku LIKE '%2')")
    return " UNION ALL ".join(parts)


@query(_SPLIT + f", g AS ({_grid_sql()}), b AS (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY round(least(coalesce(mape, 1.0), 99.0), 9), k) AS rn FROM g) SELECT sku, model, round(least(coalesce(mape, 1.0), 99.0), 6) AS val_mape FROM b WHERE rn = 1")
def hp_tuned_by_model(spark, d):
    k = F.col("sku")
    model = F.when(k.endswith("1"), "naive_forecast").when(k.endswith("2"), "holts_linear_trend").otherwise("simple_exponential_smoothing")
    return W.tuned(V.series(_brand(spark, d)).withColumn("model", model)).select("sku", "model", _r("val_mape").alias("val_mape"))


@query("SELECT r_regionkey AS tenant_id, CASE r_regionkey % 3 WHEN 0 THEN 'lag,promo,weekend' WHEN 1 THEN 'lag,promo' ELSE 'lag' END AS features, CAST(CASE r_regionkey % 3 WHEN 0 THEN 0.3 WHEN 1 THEN 0.4 ELSE 0.05 END AS DOUBLE) AS error FROM region")
def feature_search_choice(spark, d):
    # the error of a list of features, by tenant: promo helps all, weekend some, season nobody, and a good start ends the search
    gain = {0: {"promo": 0.1, "weekend": 0.1}, 1: {"promo": 0.1}, 2: {"promo": 0.01}}
    rows = []
    for (key,) in V.table(spark, d, "region").select("r_regionkey").collect():
        start = 0.05 if key % 3 == 2 else 0.5
        features, error = T.feature_search(["lag"], ["promo", "season", "weekend"], lambda names, key=key, start=start: start - sum(gain[key % 3].get(n, 0) for n in names))
        rows.append((key, ",".join(features), round(error, 6)))
    return spark.createDataFrame(rows, "tenant_id int, features string, error double")


# ---- sinks


@query("SELECT p_partkey AS sku, p_brand AS model, '{\"size\":' || p_size || '}' AS hp, p_size AS n FROM part UNION ALL SELECT s_suppkey, 'supplier', '{\"size\":' || s_nationkey || '}', s_nationkey FROM supplier")
def execution_log_appended(spark, d):
    root = _folder(spark)
    w = K.BatchWriter(root, frozenset(("execution_log",)))
    p, s = V.table(spark, d, "part"), V.table(spark, d, "supplier")
    w.add("execution_log", p.select(F.col("p_partkey").cast("long").alias("sku"), F.col("p_brand").alias("model"), F.struct(F.col("p_size").alias("size")).alias("hp"), F.col("p_size").cast("long").alias("n")))
    w.add("execution_log", s.select(F.col("s_suppkey").cast("long").alias("sku"), F.lit("supplier").alias("model"), F.struct(F.col("s_nationkey").cast(p.schema["p_size"].dataType).alias("size")).alias("hp"), F.col("s_nationkey").cast("long").alias("n")))
    w.flush()
    return spark.read.parquet(f"{root}/execution_log")


@query("SELECT c_nationkey AS tenant_id, c_custkey AS sku, CASE WHEN c_nationkey % 3 = 0 AND c_custkey % 2 = 0 THEN -c_acctbal ELSE c_acctbal END AS value FROM customer c WHERE c_nationkey % 3 <> 0 OR c_custkey % 2 = 0 OR NOT EXISTS (SELECT 1 FROM customer o WHERE o.c_nationkey = c.c_nationkey AND o.c_custkey % 2 = 0)")
def tenant_partition_replaced(spark, d):
    path = _folder(spark)
    c = V.table(spark, d, "customer").select(F.col("c_nationkey").alias("tenant_id"), F.col("c_custkey").alias("sku"), F.col("c_acctbal").alias("value"))
    K.replace_partition(c, path)
    for _ in range(2):
        K.replace_partition(c.where("tenant_id % 3 = 0 and sku % 2 = 0").withColumn("value", -F.col("value")), path)
    return spark.read.schema("sku bigint, value double, tenant_id bigint").parquet(path).select("tenant_id", "sku", "value")


@query("SELECT p_partkey AS sku, p_brand AS brand, CAST(p_size AS BIGINT) AS size FROM part")
def csv_report_roundtrip(spark, d):
    root = _folder(spark)
    K.reports({"parts": V.table(spark, d, "part").select(F.col("p_partkey").alias("sku"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))}, root)
    return spark.read.option("header", True).schema("sku bigint, brand string, size bigint").csv(f"{root}/parts")


@query(f"WITH {_FP} SELECT sku, CASE WHEN sku % 3 = 0 THEN f ELSE old END AS fingerprint FROM fp WHERE sku % 10 <> 0 OR sku % 3 = 0")
def fingerprint_cache_upsert(spark, d):
    t, f = K.Table(spark, _folder(spark)), _prints(spark, d)
    t.write(f.where("sku % 10 <> 0").select("sku", F.col("old").alias("fingerprint")))
    for _ in range(2):
        t.write(K.upserted(t.read(), f.where("sku % 3 = 0").select("sku", F.col("f").alias("fingerprint")), ["sku"]))
    return t.read()


@query(f"WITH {OUT}, c AS (SELECT pattern, avg(CASE WHEN actual <= forecast THEN 1.0 ELSE 0.0 END) AS c, max(quantile) AS q FROM outs WHERE pattern <> 'stable' GROUP BY 1), s AS (SELECT * FROM (VALUES ('cold_start', 0.9::DOUBLE), ('stable', 0.8), ('seasonal', 0.9)) t(pattern, quantile)) SELECT pattern, round(CASE WHEN abs(q - c) < 0.01 THEN q ELSE least(0.99, greatest(0.5, q + CASE WHEN q - c > 0 THEN 0.02 ELSE -0.02 END)) END, 6) AS quantile FROM c UNION ALL SELECT s.* FROM s ANTI JOIN c USING (pattern)")
def quantile_state_upsert(spark, d):
    c = _outcomes(spark, d).where("pattern <> 'stable'").groupBy("pattern").agg(F.avg((F.col("actual") <= F.col("forecast")).cast("double")).alias("c"), F.max("quantile").alias("q"))
    fresh = c.select("pattern", _r(S.quantile_evidence(F.col("c"), F.col("q"), F.col("q"), P.DEFAULTS["quantile_calibration_step"])).alias("quantile"))
    state = spark.createDataFrame([("cold_start", 0.9), ("stable", 0.8), ("seasonal", 0.9)], "pattern string, quantile double")
    return K.upserted(state, fresh, ["pattern"])


@query("SELECT r_regionkey AS tenant_id, 'R1' AS run_id, CASE WHEN r_regionkey < 3 THEN 10 ELSE 20 END AS total FROM region")
def assessment_insert_ignored(spark, d):
    r = V.table(spark, d, "region").select(F.col("r_regionkey").alias("tenant_id"), F.lit("R1").alias("run_id"))
    first = K.insert_ignored(None, r.where("tenant_id < 3").withColumn("total", F.lit(10)), ["tenant_id", "run_id"])
    return K.insert_ignored(first, r.withColumn("total", F.lit(20)), ["tenant_id", "run_id"])


@query(f"WITH {_RUNS} SELECT tenant_id, run_id, CASE WHEN o % 7 = 0 THEN 'failed' ELSE status END AS status, CASE WHEN o % 7 = 0 THEN TIMESTAMP '2030-01-01' ELSE updated_at END AS updated_at FROM (SELECT *, CAST(substr(run_id, 2) AS BIGINT) AS o FROM rn)")
def run_status_updated(spark, d):
    runs = _runs(spark, d)
    changes = runs.where("o_orderkey % 7 = 0").select("tenant_id", "run_id", F.lit("failed").alias("status"))
    unknown = spark.createDataFrame([("T9", "none", "failed")], "tenant_id string, run_id string, status string")
    return U.with_status(runs.drop("o_orderkey"), changes.unionByName(unknown), F.lit("2030-01-01").cast("timestamp_ntz"))


# ---- states, signals, streams

_STATES = "['IDLE', 'PRELOADING', 'PERCEIVING', 'PLANNING', 'ACTING', 'LEARNING', 'REPORTING', 'COMPLETE', 'FAILED']"
_LEGAL = "(VALUES ('', 'IDLE'), ('', 'PRELOADING'), " + ", ".join(f"('{a}', '{b}')" for a, b in B.TRANSITIONS) + ") t(prior, state)"


@query(f"WITH l AS (SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq, {_STATES}[CAST(event_id % 9 AS INTEGER) + 1] AS state FROM events), p AS (SELECT *, coalesce(lag(state) OVER (PARTITION BY run_id ORDER BY seq), '') AS prior FROM l) SELECT run_id, seq, prior, state FROM p ANTI JOIN (SELECT * FROM {_LEGAL}) USING (prior, state)")
def invalid_transitions(spark, d):
    from pyspark.sql import Window

    seq = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    states = F.array(*[F.lit(x) for x in _STATES.strip("[]").replace("'", "").split(", ")])
    log = V.table(spark, d, "events").select(F.col("user_id").alias("run_id"), seq.alias("seq"), F.get(states, (F.col("event_id") % 9).cast("int")).alias("state"))
    return B.invalid_transitions(log).select("run_id", F.col("seq").cast("long").alias("seq"), "prior", "state")


@query("SELECT * FROM (VALUES ('good', 1, 'IDLE', 'PRELOADING', NULL), ('good', 2, 'PRELOADING', 'PERCEIVING', NULL), ('good', 3, 'PERCEIVING', 'PLANNING', NULL), ('good', 4, 'PLANNING', 'ACTING', NULL), ('good', 5, 'ACTING', 'LEARNING', NULL), ('good', 6, 'LEARNING', 'REPORTING', NULL), ('good', 7, 'REPORTING', 'COMPLETE', NULL), ('bad', 1, 'IDLE', 'PRELOADING', NULL), ('bad', 2, 'PRELOADING', 'PERCEIVING', NULL), ('bad', 3, 'PERCEIVING', 'FAILED', 'no parameters')) t(run_id, seq, from_state, to_state, reason)")
def state_log_of_runs(spark, d):
    from pyspark.sql import Window

    root, ticks = _folder(spark), iter(range(100))
    clock = lambda: datetime(2030, 1, 1, 0, 0, next(ticks))
    log, runs = U.StateLog(spark, root), K.Table(spark, f"{root}/runs")
    quiet = {s: (lambda: None) for s in U.STAGES}

    def fails() -> None:
        raise ValueError("no parameters")

    U.orchestrate(log, runs, "T1", "good", quiet, clock)
    try:
        U.orchestrate(log, runs, "T1", "bad", quiet | {"PERCEIVING": fails}, clock)
    except ValueError:
        pass
    seq = F.row_number().over(Window.partitionBy("run_id").orderBy("at"))
    return log.read().select("run_id", seq.alias("seq"), "from_state", "to_state", "reason")


@query(f"WITH {OUT}, m AS (SELECT model, max(error) AS e FROM outs WHERE error IS NOT NULL AND horizon = 30 GROUP BY 1) SELECT 'T1' AS tenant_id, model AS sku, t AS signal_type, CASE WHEN t = 'model_health' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS confidence, TIMESTAMP '2030-01-01' + to_days(CASE t WHEN 'forecast_accuracy' THEN 90 WHEN 'forecast_risk' THEN 90 WHEN 'cross_sku_learning' THEN 60 ELSE 30 END) AS expires_at FROM m, (VALUES ('forecast_accuracy'), ('forecast_risk'), ('cross_sku_learning'), ('model_health')) t(t) WHERE CASE t WHEN 'forecast_risk' THEN model LIKE '%s%' WHEN 'cross_sku_learning' THEN e < 5 ELSE TRUE END")
def typed_signals_emitted(spark, d):
    m = _outcomes(spark, d).where("error is not null and horizon = 30").groupBy("model").agg(F.max("error").alias("mape"))
    rows = m.select(F.lit("T1").alias("tenant_id"), F.col("model").alias("sku"), "model", "mape", F.when(F.col("model").contains("s"), "high").otherwise("low").alias("risk"), F.lit("forecasted").alias("status"), F.lit("stable").alias("trend"), F.lit(7.5).alias("confidence"))
    at = F.lit("2030-01-01").cast("timestamp_ntz")
    health = B.health_signals(rows.withColumn("confidence", F.lit(-2.0)), at)
    all_ = B.accuracy_signals(rows, at).unionByName(B.risk_signals(rows, at)).unionByName(B.cross_sku_signals(rows, at, 5.0)).unionByName(B.health_signals(rows.withColumn("confidence", F.lit(0.5)), at))
    for _ in range(2):
        all_ = B.replaced_health(all_, health)
    return all_.select("tenant_id", "sku", "signal_type", "confidence", "expires_at")


@query("SELECT event_type, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY 1")
def signal_stream_drained(spark, d):
    root, e = _folder(spark), V.table(spark, d, "events")
    out = f"{root}/out"
    for half in (0, 1, None):  # two deliveries, each drained once, and a poll that finds nothing new
        if half is not None:
            e.where(F.col("event_id") % 2 == half).write.mode("append").parquet(f"{root}/in")
        B.run_once(B.stream(spark, f"{root}/in"), lambda b, _: b.write.mode("append").parquet(out), f"{root}/checkpoint", "append").awaitTermination()
    return spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


# ---- order, union, routing, runs


@query("SELECT brand, sku, coalesce(size, -1) AS size FROM (SELECT p_brand AS brand, p_partkey AS sku, CASE WHEN p_size % 3 <> 0 THEN p_size END AS size, row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p_size % 3 <> 0 THEN p_size END DESC NULLS LAST, p_partkey) AS rn FROM part) WHERE rn <= 3")
def newest_nulls_last(spark, d):
    p = V.table(spark, d, "part").select(F.col("p_brand").alias("brand"), F.col("p_partkey").alias("sku"), F.when(F.col("p_size") % 3 != 0, F.col("p_size")).alias("size"))
    return L.newest(p, ["brand"], 3, F.desc_nulls_last("size"), F.asc("sku")).withColumn("size", F.coalesce("size", F.lit(-1)))


@query(f"WITH {S_BRAND}, t AS (SELECT sku, q, CASE WHEN sku LIKE '%1' THEN 'cache' WHEN sku LIKE '%2' THEN 'partial' ELSE 'full' END AS tier FROM sb), s AS (SELECT *, list_reduce(list_transform(q, lambda x: CAST(x AS DOUBLE)), lambda a, x: 0.3::DOUBLE * x + 0.7::DOUBLE * a) AS level FROM t) SELECT sku, tier, round(CASE tier WHEN 'cache' THEN q[1] WHEN 'partial' THEN level ELSE list_avg(q) END, 6) AS level FROM s")
def tier_routed(spark, d):
    tier = F.when(F.col("sku").endswith("1"), "cache").when(F.col("sku").endswith("2"), "partial").otherwise("full")
    s = V.series(_brand(spark, d)).select("sku", "q", tier.alias("tier"))
    out = lambda level: lambda rows: rows.select("sku", "tier", _r(level).alias("level"))
    return W.routed(s, out(F.get("q", F.lit(0)))(s.where("tier = 'cache'")), out(M.ses_level(F.col("q"), 0.3)), out(M.mean(F.col("q"))))


_RUN_TIERS = f"WITH {S_BRAND} SELECT sku, run_id, CASE WHEN run_id = 'R1' THEN 'full' WHEN sku LIKE '%5' THEN 'full' ELSE 'cache' END AS tier, TRUE AS ordered FROM sb, (VALUES ('R1'), ('R2')) r(run_id)"


@query(_RUN_TIERS)
def orchestrated_runs(spark, d):
    """Two runs of one tenant: the second takes what did not change from the cache."""
    root, s = _folder(spark), V.series(_brand(spark, d)).withColumn("pattern", F.lit("stable"))
    G.up(spark, root)
    K.Table(spark, f"{root}/params").write(P.defaults_table(spark).select(F.lit("T1").alias("tenant_id"), "param_name", "value"))
    K.Table(spark, f"{root}/runs").write(spark.createDataFrame([("T1", r, U.READY, datetime(2030, 1, 1)) for r in ("R1", "R2")], G.TABLES["runs"]))
    changed = s.withColumn("q", F.when(F.col("sku").endswith("5"), F.transform("q", lambda x: x * 3)).otherwise(F.col("q")))
    for run, demand in (("R1", s), ("R2", changed)):
        O.Run(spark, root, "T1", run, demand).go()
    f = K.Table(spark, f"{root}/forecasts").read()
    return f.select("sku", "run_id", "tier", ((F.col("p50_7d") <= F.col("p80_7d")) & (F.col("p80_7d") <= F.col("p90_7d"))).alias("ordered"))
