"""The registered queries over the given tables, each with the SQL by which another engine can check it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions import models as M
from ..functions import scoring as S
from ..operators import arrow as A
from ..operators import learning as L
from ..operators import series as R
from ..operators import sinks as K
from ..sources import views as V
from ..streaming import signals as G
from . import forecast as W

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# shared pieces of the checking SQL
D_PART = "dp AS (SELECT l_partkey AS sku, CAST(l_shipdate AS DATE) AS d, sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2)"
D_BRAND = "db AS (SELECT p_brand AS sku, CAST(l_shipdate AS DATE) AS d, sum(l_quantity) AS qty FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"
S_BRAND = f"{D_BRAND}, sb AS (SELECT sku, list(qty ORDER BY d) AS q, max(d) AS last_d, count(*) AS n FROM db WHERE d > (SELECT max(d) FROM db) - 730 GROUP BY 1)"
S_PART = f"{D_PART}, sp AS (SELECT sku, list(qty ORDER BY d) AS q, count(*) AS n FROM dp WHERE d > (SELECT max(d) FROM dp) - 730 GROUP BY 1)"
DENSE = f"{D_PART}, ends AS (SELECT max(d) AS e FROM dp), it AS (SELECT DISTINCT sku FROM dp, ends WHERE d > e - 90), g AS (SELECT sku, CAST(e - CAST(i AS INTEGER) AS DATE) AS d FROM it, ends, range(90) r(i)), dn AS (SELECT g.sku, g.d, coalesce(dp.qty, 0) AS qty FROM g LEFT JOIN dp ON g.sku = dp.sku AND g.d = dp.d)"
ACT = "act AS MATERIALIZED (SELECT l_partkey AS sku, CAST(o_orderdate AS DATE) AS d, sum(l_quantity) AS qty FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"
PATTERN = "CASE sku % 5 WHEN 0 THEN 'cold_start' WHEN 1 THEN 'intermittent' WHEN 2 THEN 'seasonal' WHEN 3 THEN 'trending' ELSE 'stable' END"
MODEL = "CASE sku % 5 WHEN 0 THEN 'naive_forecast' WHEN 1 THEN 'croston' WHEN 2 THEN 'prophet' WHEN 3 THEN 'holts_linear_trend' ELSE 'simple_exponential_smoothing' END"
FC = f"""{ACT}, made AS (SELECT (SELECT max(d) FROM act) - k AS created FROM (VALUES (100), (45), (10)) t(k)),
rate AS MATERIALIZED (SELECT sku, created, sum(qty) / 365 AS r FROM act, made WHERE d < created AND d >= created - 365 GROUP BY 1, 2),
fc AS MATERIALIZED (SELECT sku, created, {PATTERN} AS pattern, {MODEL} AS model, CASE WHEN sku % 5 IN (3, 4) THEN 0.8::DOUBLE ELSE 0.9::DOUBLE END AS quantile, h AS horizon,
round(r * h, 4) AS p50, round(r * h * 1.2, 4) AS p80, round(r * h * 1.4, 4) AS p90 FROM rate, (VALUES (7), (14), (30), (60), (90)) t(h))"""
OUT = f"""{FC}, spans AS (SELECT f.*, sum(a.qty) AS actual, count(a.qty) AS n_days FROM fc f JOIN act a ON a.sku = f.sku AND a.d >= f.created AND a.d < f.created + f.horizon GROUP BY ALL),
outc AS (SELECT *, CASE WHEN quantile = 0.5 THEN p50 WHEN quantile = 0.8 THEN p80 ELSE p90 END AS forecast FROM spans),
outs AS (SELECT *, CASE WHEN actual <> 0 THEN round(abs(actual - forecast) / actual + 1e-9, 3) END AS error, CASE WHEN actual <> 0 THEN round((forecast - actual) / actual + sign(forecast - actual) * 1e-9, 3) END AS bias, created + horizon AS closed FROM outc WHERE created + horizon <= (SELECT max(d) FROM act))"""
SIG = "sig AS (SELECT event_id AS signal_id, ts, user_id AS sku, event_type AS signal_type, value, props AS payload, CASE WHEN event_type = 'error' THEN ts + INTERVAL 5 DAY WHEN event_type <> 'view' THEN ts + INTERVAL 10 DAY END AS expires_at FROM events)"
PROMO = "pr AS (SELECT p_brand AS sku, CAST(l_shipdate AS DATE) AS d, round(1 - max(l_discount), 4) AS weight FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_discount >= 0.08 GROUP BY 1, 2)"
SES = "list_reduce(list_transform({q}, lambda x: CAST(x AS DOUBLE)), lambda a, x: {a} * x + (1 - {a}) * a)"
H = P.HORIZONS


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _r(c, n: int = 6):
    return F.round(c, n)


def _brand(spark, d):
    return V.daily_demand(spark, d, "brand")


def _part(spark, d):
    return V.daily_demand(spark, d, "part")


# ---- sources, filters, joins


@query(f"WITH {D_PART} SELECT sku, d, qty FROM dp")
def daily_demand_by_part(spark, d):
    return _part(spark, d)


@query(f"WITH {D_BRAND} SELECT sku, d, qty FROM db")
def daily_demand_by_brand(spark, d):
    return _brand(spark, d)


@query(f"WITH {D_PART} SELECT sku, string_agg(CAST(CAST(qty AS BIGINT) AS VARCHAR), ',' ORDER BY d) AS quantities, count(*) AS n FROM dp WHERE d > (SELECT max(d) FROM dp) - 30 GROUP BY sku")
def trailing_demand_30d(spark, d):
    s = V.series(_part(spark, d), 30)
    return s.select("sku", F.array_join(F.transform("q", lambda x: x.cast("bigint").cast("string")), ",").alias("quantities"), F.col("n").cast("long").alias("n"))


@query(f"WITH {S_PART} SELECT sku, n, round(list_sum(q), 4) AS total, q[1] AS first_qty, q[n] AS last_qty FROM sp")
def trailing_demand_730d(spark, d):
    s = V.series(_part(spark, d))
    return s.select("sku", F.col("n").cast("long").alias("n"), _r(F.aggregate("q", F.lit(0.0), lambda a, x: a + x), 4).alias("total"), F.element_at("q", 1).alias("first_qty"), F.element_at("q", -1).alias("last_qty"))


@query("SELECT p_partkey AS sku, p_brand AS brand, p_type AS product_type, coalesce(a.n, 0) AS n_lines, coalesce(a.qty, 0) AS total_qty, s_name AS main_supplier, coalesce(n_name, 'unknown') AS tenant FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n, sum(l_quantity) AS qty, min(l_suppkey) AS sk FROM lineitem GROUP BY 1) a ON p_partkey = l_partkey LEFT JOIN supplier ON sk = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey")
def sku_context_left_join(spark, d):
    a = V.table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"), F.min("l_suppkey").alias("sk"))
    j = V.table(spark, d, "part").join(a, F.col("p_partkey") == F.col("l_partkey"), "left").join(V.table(spark, d, "supplier"), F.col("sk") == F.col("s_suppkey"), "left").join(F.broadcast(V.table(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return j.select(F.col("p_partkey").alias("sku"), F.col("p_brand").alias("brand"), F.col("p_type").alias("product_type"), F.coalesce("n", F.lit(0)).alias("n_lines"), F.coalesce("qty", F.lit(0.0)).alias("total_qty"), F.col("s_name").alias("main_supplier"), F.coalesce("n_name", F.lit("unknown")).alias("tenant"))


@query("SELECT r_regionkey AS tenant, r_name AS pipeline_mode FROM region WHERE r_regionkey = 1 LIMIT 1")
def tenant_context_row(spark, d):
    return V.table(spark, d, "region").where("r_regionkey = 1").select(F.col("r_regionkey").alias("tenant"), F.col("r_name").alias("pipeline_mode")).limit(1)


@query("SELECT DISTINCT n_regionkey AS tenant FROM nation ORDER BY 1")
def all_tenants_distinct(spark, d):
    return V.table(spark, d, "nation").select(F.col("n_regionkey").alias("tenant")).distinct().orderBy("tenant")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")
def latest_order_per_customer(spark, d):
    return L.latest(V.table(spark, d, "orders"), ["o_custkey"], F.desc("o_orderdate"), F.desc("o_orderkey")).select("o_custkey", "o_orderkey", "o_totalprice")


@query(f"WITH {D_BRAND}, {PROMO} SELECT db.sku, db.d, qty, coalesce(weight, 1.0) AS multiplier FROM db LEFT JOIN pr ON db.sku = pr.sku AND db.d = pr.d")
def promo_lookup_join(spark, d):
    return _brand(spark, d).join(V.promo_days(spark, d), ["sku", "d"], "left").select("sku", "d", "qty", F.coalesce("weight", F.lit(1.0)).alias("multiplier"))


@query("SELECT l_partkey AS sku, o_orderpriority AS channel, sum(l_quantity) AS qty, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2")
def channel_split_demand(spark, d):
    j = V.table(spark, d, "lineitem").join(V.table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy(F.col("l_partkey").alias("sku"), F.col("o_orderpriority").alias("channel")).agg(F.sum("l_quantity").alias("qty"), F.count("*").alias("n"))


@query("SELECT event_id, ts, event_type, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events WHERE event_type IN ('error', 'purchase') AND ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY")
def alerts_recent_filtered(spark, d):
    e = V.table(spark, d, "events")
    now = e.agg(F.max("ts").alias("m")).scalar()
    return e.where(F.col("event_type").isin("error", "purchase") & (F.col("ts") >= now - F.expr("INTERVAL 7 DAYS"))).select("event_id", "ts", "event_type", G.payload_number(F.col("props"), "k").alias("k"))


@query("SELECT max(ts) AS last_complete FROM events WHERE event_type = 'purchase'")
def last_complete_timestamp(spark, d):
    return V.table(spark, d, "events").where("event_type = 'purchase'").agg(F.max("ts").alias("last_complete"))


@query("SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders WHERE o_orderstatus IN ('P', 'O') ORDER BY o_orderdate ASC, o_orderkey ASC LIMIT 50")
def pending_runs_poll(spark, d):
    return V.table(spark, d, "orders").where(F.col("o_orderstatus").isin("P", "O")).orderBy("o_orderdate", "o_orderkey").limit(50).select("o_orderkey", "o_orderstatus", "o_orderdate")


@query("SELECT l_returnflag AS pattern, l_linestatus AS model, max(l_quantity) AS widest, arg_max(l_discount, CAST(l_linenumber AS BIGINT) * 1000000000 + l_orderkey * 1000 + l_partkey) AS calibrated FROM lineitem GROUP BY 1, 2")
def calibrated_by_largest_horizon(spark, d):
    li = V.table(spark, d, "lineitem")
    order = F.col("l_linenumber").cast("long") * 1000000000 + F.col("l_orderkey") * 1000 + F.col("l_partkey")
    return li.groupBy(F.col("l_returnflag").alias("pattern"), F.col("l_linestatus").alias("model")).agg(F.max("l_quantity").alias("widest"), F.max_by("l_discount", order).alias("calibrated"))


@query(f"WITH {FC} SELECT pattern, model, arg_max(p50, CAST(CASE WHEN horizon = 30 THEN 10000 ELSE horizon END AS BIGINT) * 1000000000 + (created - DATE '1990-01-01') * 100000 + sku) AS gap FROM fc GROUP BY 1, 2")
def calibration_gap_priority(spark, d):
    order = F.when(F.col("horizon") == 30, 10000).otherwise(F.col("horizon")).cast("long") * 1000000000 + F.datediff("created", F.to_date(F.lit("1990-01-01"))).cast("long") * 100000 + F.col("sku")
    return V.forecasts(spark, d).groupBy("pattern", "model").agg(F.max_by("p50", order).alias("gap"))


# ---- ordered series


@query(f"WITH {D_BRAND} SELECT sku, coalesce(avg(CASE WHEN isodow(d) > 5 THEN CASE WHEN qty = 0 THEN 1.0 ELSE 0.0 END END), 0) AS weekend_zero_ratio FROM db GROUP BY 1")
def weekend_zero_ratio_brand(spark, d):
    return R.weekend_zero_ratio(_brand(spark, d))


@query(f"WITH {DENSE}, z AS (SELECT sku, avg(CASE WHEN qty = 0 THEN 1.0 ELSE 0.0 END) FILTER (isodow(d) > 5) AS r FROM dn GROUP BY 1) SELECT sku, round(coalesce(r, 0), 6) AS weekend_zero_ratio, coalesce(r, 0) > 0.6 AS is_b2b FROM z")
def b2b_flag(spark, d):
    r = R.weekend_zero_ratio(V.densify(_part(spark, d), 90))
    return r.select("sku", _r("weekend_zero_ratio").alias("weekend_zero_ratio"), S.is_b2b(F.col("weekend_zero_ratio")).alias("is_b2b"))


@query(f"WITH {D_PART}, w AS (SELECT *, max(CASE WHEN isodow(d) < 6 THEN 1 ELSE 0 END) OVER (PARTITION BY sku) AS s FROM dp) SELECT sku, count(*) AS n, sum(qty) AS qty FROM w WHERE isodow(d) < 6 OR s = 0 GROUP BY 1")
def weekday_filter(spark, d):
    return R.business_days(_part(spark, d)).groupBy("sku").agg(F.count("*").alias("n"), F.sum("qty").alias("qty"))


@query(f"WITH {D_BRAND}, a AS (SELECT sku, avg(qty) AS m, count(*) AS n FROM db GROUP BY 1), k AS (SELECT sku, isodow(d) - 1 AS dow, avg(qty) AS x, count(*) AS c FROM db GROUP BY 1, 2) SELECT a.sku, t.dow, round(CASE WHEN n < 28 OR m <= 0 THEN 1.0 WHEN coalesce(c, 0) < 4 THEN 1.0 ELSE x / m END, 6) AS multiplier FROM a CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5), (6)) t(dow) LEFT JOIN k ON k.sku = a.sku AND k.dow = t.dow")
def dow_multipliers(spark, d):
    return R.dow_multipliers(_brand(spark, d)).select("sku", F.posexplode("m").alias("dow", "x")).select("sku", "dow", _r("x").alias("multiplier"))


@query(f"WITH {D_BRAND} SELECT sku, d, round(avg(qty) OVER (PARTITION BY sku ORDER BY d ROWS 6 PRECEDING), 6) AS roll7 FROM db")
def rolling_baseline_7(spark, d):
    return R.rolling_mean(_brand(spark, d), 7, "x").select("sku", "d", _r("x").alias("roll7"))


@query(f"WITH {D_BRAND} SELECT sku, d, round(avg(qty) OVER (PARTITION BY sku ORDER BY d ROWS 13 PRECEDING), 6) AS roll14 FROM db")
def rolling_baseline_14(spark, d):
    return R.rolling_mean(_brand(spark, d), 14, "x").select("sku", "d", _r("x").alias("roll14"))


@query(f"WITH {D_BRAND}, w AS (SELECT sku, d, count(qty) OVER x AS c, avg(qty) OVER x AS m, stddev_samp(qty) OVER x AS s FROM db WINDOW x AS (PARTITION BY sku ORDER BY d ROWS 13 PRECEDING)) SELECT sku, d, round(CASE WHEN c >= 3 THEN m END, 4) AS roll_mean, round(CASE WHEN c >= 3 THEN s ELSE 0 END, 4) AS roll_std FROM w")
def rolling_stats_14(spark, d):
    return R.rolling_stats(_brand(spark, d), 14).select("sku", "d", _r("roll_mean", 4).alias("roll_mean"), _r("roll_std", 4).alias("roll_std"))


@query(f"WITH {D_BRAND}, {PROMO}, w AS (SELECT sku, d, qty, avg(qty) OVER (PARTITION BY sku ORDER BY d ROWS 13 PRECEDING) AS m FROM db) SELECT w.sku, w.d, round(CASE WHEN weight < 1 THEN least(qty, m * 3) ELSE qty END, 6) AS qty_capped FROM w LEFT JOIN pr ON w.sku = pr.sku AND w.d = pr.d")
def promo_capped_demand(spark, d):
    return R.promo_capped(_brand(spark, d), V.promo_days(spark, d)).select("sku", "d", _r("qty_capped").alias("qty_capped"))


@query(f"WITH {DENSE}, r AS (SELECT sku, d, row_number() OVER (PARTITION BY sku ORDER BY d) AS rn FROM dn), z AS (SELECT r.sku, r.rn - row_number() OVER (PARTITION BY r.sku ORDER BY r.d) AS g FROM r JOIN dn ON r.sku = dn.sku AND r.d = dn.d WHERE dn.qty = 0), l AS (SELECT sku, max(c) AS m FROM (SELECT sku, g, count(*) AS c FROM z GROUP BY 1, 2) GROUP BY 1) SELECT it.sku, coalesce(m, 0) AS longest_zero_streak, coalesce(m, 0) >= 3 AS stockout FROM it LEFT JOIN l USING (sku)")
def longest_zero_streak(spark, d):
    dense = V.densify(_part(spark, d), 90)
    runs = R.streaks(dense, F.col("qty") == 0).groupBy("sku").agg(F.max("length").alias("m"))
    m = F.coalesce("m", F.lit(0)).cast("long")
    return dense.select("sku").distinct().join(runs, "sku", "left").select("sku", m.alias("longest_zero_streak"), (m >= 3).alias("stockout"))


@query(f"WITH {DENSE}, r AS (SELECT sku, d, qty, row_number() OVER (PARTITION BY sku ORDER BY d) - row_number() OVER (PARTITION BY sku, qty = 0 ORDER BY d) AS g FROM dn), e AS (SELECT sku, g, count(*) AS c FROM r WHERE qty = 0 GROUP BY 1, 2), l AS (SELECT sku, sum(c) AS z, avg(c) AS a FROM e WHERE c >= 3 GROUP BY 1) SELECT it.sku, round(coalesce(z, 0) / 90.0, 6) AS oos_pct, round(coalesce(a, 0), 6) AS mean_streak, round(CASE WHEN a IS NULL THEN 0 ELSE least(0.95, 0.60 + a / 60) END, 6) AS detection_confidence FROM it LEFT JOIN l USING (sku)")
def oos_episodes(spark, d):
    o = R.oos_stats(V.densify(_part(spark, d), 90))
    return o.select("sku", *[_r(c).alias(c) for c in ("oos_pct", "mean_streak", "detection_confidence")])


@query(f"WITH {DENSE}, r AS (SELECT sku, d, qty, row_number() OVER (PARTITION BY sku ORDER BY d) - row_number() OVER (PARTITION BY sku, qty = 0 ORDER BY d) AS g FROM dn), e AS (SELECT *, count(*) OVER (PARTITION BY sku, qty = 0, g) AS c FROM r) SELECT sku, d, qty = 0 AND c >= 3 AS in_oos FROM e")
def oos_mask(spark, d):
    return R.oos_rows(V.densify(_part(spark, d), 90)).select("sku", "d", "in_oos")


_FLAG = f"""WITH {S_BRAND}, x AS (SELECT sku, unnest(q) AS qty, generate_subscripts(q, 1) AS i FROM sb),
w AS (SELECT *, avg(qty) OVER (PARTITION BY sku ORDER BY i ROWS 6 PRECEDING) AS r7, avg(qty) OVER (PARTITION BY sku) AS m, stddev_pop(qty) OVER (PARTITION BY sku) AS sd FROM x),
b AS (SELECT *, i - row_number() OVER (PARTITION BY sku, r7 > 0 AND qty < 0.4 * r7 ORDER BY i) AS g, r7 > 0 AND qty < 0.4 * r7 AS low FROM w),
dr AS (SELECT sku, max(c) AS c FROM (SELECT sku, g, count(*) AS c FROM b WHERE low GROUP BY 1, 2) GROUP BY 1),
zr AS (SELECT sku, max(c) AS c FROM (SELECT sku, g, count(*) AS c FROM (SELECT *, i - row_number() OVER (PARTITION BY sku, qty = 0 ORDER BY i) AS g FROM x) WHERE qty = 0 GROUP BY 1, 2) GROUP BY 1),
f AS (SELECT sku, bool_or(CASE WHEN r7 > 0 THEN qty / r7 > 2 ELSE false END OR (sd > 0 AND (qty - m) / sd > 3)) AS spike, max(sd) / max(m) >= 1 AS vol FROM w GROUP BY 1),
fl AS (SELECT f.sku, coalesce(zr.c, 0) >= 3 AS stockout, spike AS promo_spike, coalesce(dr.c, 0) >= 3 AS unusual_drop, vol AS high_volatility FROM f LEFT JOIN dr USING (sku) LEFT JOIN zr USING (sku)) """


@query(_FLAG + "SELECT * FROM fl")
def demand_flags(spark, d):
    return R.with_flags(V.series(_brand(spark, d))).select("sku", "stockout", "promo_spike", "unusual_drop", "high_volatility")


@query(_FLAG + "SELECT sku, concat_ws('|', CASE WHEN stockout THEN 'stockout' END, CASE WHEN promo_spike THEN 'promo_spike' END, CASE WHEN unusual_drop THEN 'unusual_drop' END, CASE WHEN high_volatility THEN 'high_volatility' END) AS flags FROM fl")
def exception_flag_array(spark, d):
    return R.with_flags(V.series(_brand(spark, d))).select("sku", F.array_join("flags", "|").alias("flags"))


@query(f"WITH {D_BRAND} SELECT sku, d, sum(qty) OVER (PARTITION BY sku ORDER BY d ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING) AS ahead7 FROM db")
def forward_demand_7(spark, d):
    return R.forward_sum(_brand(spark, d), 7, "ahead7").select("sku", "d", "ahead7")


@query(f"WITH {D_BRAND}, w AS (SELECT sku, d, qty, count(qty) OVER x AS c, avg(qty) OVER x AS m, stddev_samp(qty) OVER x AS s FROM db WINDOW x AS (PARTITION BY sku ORDER BY d ROWS 13 PRECEDING)) SELECT sku, d, round(CASE WHEN c >= 3 AND qty > 2 * m AND qty > m + 3 * coalesce(s, 0) THEN least(greatest(m / qty, 0.5), 0.95) ELSE 1.0 END, 4) AS weight FROM w")
def promo_weight_derivation(spark, d):
    return R.promo_weights(_brand(spark, d)).select("sku", "d", _r("weight", 4).alias("weight"))


@query(f"WITH {D_PART}, w AS (SELECT sku, qty, row_number() OVER (PARTITION BY sku ORDER BY d) AS rn, count(*) OVER (PARTITION BY sku) AS n FROM dp), h AS (SELECT sku, avg(qty) FILTER (rn <= n // 2) AS a, avg(qty) FILTER (rn > n // 2) AS b, stddev_pop(qty) / avg(qty) AS cv FROM w GROUP BY 1) SELECT sku, coalesce(b / a > 2 OR b / a < 0.5, false) OR cv > 1.5 AS on_watchlist, round(least(0.95, greatest(0.55, 1 - 0.4 * cv)), 6) AS calibrated FROM h")
def watchlist_and_calibrated_confidence(spark, d):
    w = Window.partitionBy("sku")
    x = _part(spark, d).withColumns({"rn": F.row_number().over(w.orderBy("d")), "n": F.count("*").over(w)})
    half = F.floor(F.col("n") / 2)
    h = x.groupBy("sku").agg(F.avg(F.when(F.col("rn") <= half, F.col("qty"))).alias("a"), F.avg(F.when(F.col("rn") > half, F.col("qty"))).alias("b"), (F.stddev_pop("qty") / F.avg("qty")).alias("cv"))
    ratio = F.col("b") / F.col("a")
    return h.select("sku", (F.coalesce((ratio > 2) | (ratio < 0.5), F.lit(False)) | (F.col("cv") > 1.5)).alias("on_watchlist"), _r(S.clamp(1 - 0.4 * F.col("cv"), 0.55, 0.95)).alias("calibrated"))


# ---- models, tuning, horizons, quantiles

_SPLIT = f"WITH {S_BRAND}, t AS (SELECT sku, q[1:n - 14] AS tr, q[n - 13:n] AS te, n FROM sb WHERE n > 14)"


def _metrics(level: str) -> str:
    return (
        f", f AS (SELECT sku, te, {level} AS level FROM t), x AS (SELECT sku, level, unnest(te) AS y FROM f) SELECT sku, round(max(level), 6) AS level, "
        "round(avg(abs((y - level) / y)) FILTER (y <> 0), 6) AS mape, round(sum(abs(y - level)) / nullif(sum(abs(y)), 0), 6) AS wape, round(sum(level - y) / nullif(sum(y), 0), 5) AS bias FROM x GROUP BY 1"
    )


def _backtest(s: DataFrame, level) -> DataFrame:
    s = R.split(s.where("n > 14")).withColumn("level", level(F.col("train")))
    e = R.errors(F.col("test"), F.col("level"))
    return s.select("sku", _r("level").alias("level"), _r(e["mape"]).alias("mape"), _r(e["wape"]).alias("wape"), _r(e["bias"], 5).alias("bias"))


@query(_SPLIT + _metrics("list_avg(tr[len(tr) - 6:])"))
def train_test_split_backtest_naive(spark, d):
    return _backtest(V.series(_brand(spark, d)), M.naive_level)


@query(_SPLIT + _metrics(SES.format(q="tr", a="0.3::DOUBLE").replace("(1 - 0.3::DOUBLE)", "0.7::DOUBLE")))
def backtest_ses(spark, d):
    return _backtest(V.series(_brand(spark, d)), M.ses_level)


_HOLT = "list_reduce(list_transform({q}[3:], lambda x: {{'v': CAST(x AS DOUBLE), 'l': 0.0::DOUBLE, 't': 0.0::DOUBLE}}), lambda s, e: {{'v': 0.0::DOUBLE, 'l': {a} * e.v + (1 - {a}) * (s.l + {p} * s.t), 't': {b} * (({a} * e.v + (1 - {a}) * (s.l + {p} * s.t)) - s.l) + (1 - {b}) * {p} * s.t}}, {{'v': 0.0::DOUBLE, 'l': CAST({q}[1] AS DOUBLE), 't': CAST({q}[2] - {q}[1] AS DOUBLE)}})"
_DAMPED = "list_sum(list_transform(range(1, {h} + 1), lambda k: greatest(0.0, s.l + s.t * 0.95::DOUBLE * (1 - power(0.95::DOUBLE, k)) / (1 - 0.95::DOUBLE))))"


@query(f"WITH {S_BRAND}, h AS (SELECT sku, {_HOLT.format(q='q', a='0.3::DOUBLE', b='0.1::DOUBLE', p='0.95::DOUBLE')} AS s FROM sb WHERE n > 2) SELECT sku, round(s.l, 6) AS level, round(s.t, 6) AS trend, " + ", ".join(f"round({_DAMPED.format(h=h)}, 4) AS h{h}" for h in H) + " FROM h")
def horizon_totals_holt(spark, d):
    s = V.series(_brand(spark, d)).where("n > 2").withColumn("s", M.holt_state(F.col("q")))
    return s.select("sku", _r("s.l").alias("level"), _r("s.t").alias("trend"), *[_r(M.holt_total(F.col("s"), h), 4).alias(f"h{h}") for h in H])


@query(_SPLIT + f", f AS (SELECT sku, te, {_HOLT.format(q='tr', a='0.3::DOUBLE', b='0.1::DOUBLE', p='1.0::DOUBLE')} AS s FROM t WHERE n > 20) SELECT sku, round(s.l, 6) AS level, round(s.t, 6) AS trend, round(abs(14 * s.l + 105 * s.t - list_sum(te)) / list_sum(te), 6) AS wape14 FROM f")
def backtest_holt(spark, d):
    s = R.split(V.series(_brand(spark, d)).where("n > 20")).withColumn("s", M.holt_state(F.col("train"), phi=1.0))
    total = F.aggregate("test", F.lit(0.0), lambda a, x: a + x)
    return s.select("sku", _r("s.l").alias("level"), _r("s.t").alias("trend"), _r(F.abs(14 * F.col("s.l") + 105 * F.col("s.t") - total) / total).alias("wape14"))


_CROSTON = "list_reduce(list_transform(e[2:], lambda x: {{'z': CAST(x.z AS DOUBLE), 'w': 0.0::DOUBLE, 'i': x.i}}), lambda s, x: {{'z': {a} * x.z + (1 - {a}) * s.z, 'w': {a} * (x.i - s.i) + (1 - {a}) * s.w, 'i': x.i}}, {{'z': CAST(e[1].z AS DOUBLE), 'w': 1.0::DOUBLE, 'i': e[1].i}})"
_EVENTS = f"{DENSE}, r AS (SELECT sku, qty, row_number() OVER (PARTITION BY sku ORDER BY d) AS i FROM dn), ev AS (SELECT sku, list({{'z': qty, 'i': i}} ORDER BY i) AS e FROM r WHERE qty > 0 GROUP BY 1)"


@query(f"WITH {_EVENTS} SELECT sku, a AS alpha, v AS variant, round(CASE WHEN v = 'SBA' THEN s.z / greatest(s.w, 1e-6) * (1 - a / 2) ELSE s.z / greatest(s.w, 1e-6) END, 6) AS rate FROM (" + " UNION ALL ".join(f"SELECT sku, {a}::DOUBLE AS a, {_CROSTON.format(a=f'{a}::DOUBLE')} AS s FROM ev WHERE len(e) >= 2" for a in (0.05, 0.1, 0.2)) + ") CROSS JOIN (VALUES ('classic'), ('SBA')) t(v)")
def croston_grid(spark, d):
    s = V.series(V.densify(_part(spark, d), 90), None).where(F.size(F.filter("q", lambda x: x > 0)) >= 2)
    grid = F.array(*[F.struct(F.lit(a).alias("alpha"), F.lit(v).alias("variant")) for a, v in M.CROSTON_GRID if v != "TSB"])
    s = s.select("sku", "q", F.explode(grid).alias("g")).select("sku", "q", "g.*")
    return s.select("sku", "alpha", "variant", _r(M.croston_rate(F.col("q"), F.col("alpha"), F.col("variant"))).alias("rate"))


@query(f"WITH {_EVENTS}, tail AS (SELECT ev.sku, ev.e[1].z AS z0, ev.e[1].i AS i0, list({{'x': CAST(qty AS DOUBLE), 'z': 0.0::DOUBLE, 'p': 0.0::DOUBLE}} ORDER BY i) FILTER (i > ev.e[1].i) AS q FROM ev JOIN r USING (sku) WHERE len(e) >= 2 GROUP BY ALL), s AS (SELECT sku, list_reduce(q, lambda s, x: {{'x': 0.0::DOUBLE, 'z': CASE WHEN x.x > 0 THEN 0.1::DOUBLE * x.x + 0.9::DOUBLE * s.z ELSE s.z END, 'p': CASE WHEN x.x > 0 THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END + 0.9::DOUBLE * s.p}}, {{'x': 0.0::DOUBLE, 'z': CAST(z0 AS DOUBLE), 'p': 1.0::DOUBLE / i0}}) AS s FROM tail) SELECT sku, round(s.z * s.p, 6) AS rate FROM s")
def backtest_croston_tsb(spark, d):
    s = V.series(V.densify(_part(spark, d), 90), None).where(F.size(F.filter("q", lambda x: x > 0)) >= 2)
    return s.select("sku", _r(M.croston_rate(F.col("q"), 0.1, "TSB")).alias("rate"))


@query(f"WITH {S_BRAND} SELECT sku, lag, how, round(CASE WHEN how = 'last_value' THEN q[n] WHEN how = 'mean_3d' THEN list_avg(q[n - least(lag, 3) + 1:]) ELSE list_avg(q[n - least(lag, 7) + 1:]) END, 6) AS level FROM sb CROSS JOIN (VALUES (1), (7), (14)) a(lag) CROSS JOIN (VALUES ('last_value'), ('mean_3d'), ('mean_7d')) b(how) WHERE n >= 14")
def naive_level_grid(spark, d):
    grid = F.array(*[F.struct(F.lit(lag).alias("lag"), F.lit(how).alias("how")) for lag, how in M.NAIVE_GRID])
    s = V.series(_brand(spark, d)).where("n >= 14").select("sku", "q", F.explode(grid).alias("g")).select("sku", "q", "g.*")
    return s.select("sku", "lag", "how", _r(M.naive_level(F.col("q"), F.col("lag"), F.col("how"))).alias("level"))


_SESGRID = " UNION ALL ".join("SELECT sku, te, {a}::DOUBLE AS alpha, {k} AS k, list_reduce(list_transform(tr, lambda x: CAST(x AS DOUBLE)), lambda s, x: {a}::DOUBLE * x + (1 - {a}::DOUBLE) * s) AS level FROM t".format(a=a, k=k) for k, a in enumerate(M.SES_GRID))


@query(_SPLIT + f", g AS ({_SESGRID}), e AS (SELECT sku, alpha, k, level, list_avg(list_transform(list_filter(te, lambda y: y <> 0), lambda y: abs((y - level) / y))) AS mape FROM g) SELECT sku, alpha, round(level, 6) AS level, round(mape, 6) AS mape FROM e")
def ses_grid(spark, d):
    return _ses_grid(spark, d).select("sku", "alpha", _r("level").alias("level"), _r("mape").alias("mape"))


def _ses_grid(spark: SparkSession, d: str) -> DataFrame:
    s = R.split(V.series(_brand(spark, d)).where("n > 14"))
    grid = F.array(*[F.struct(F.lit(a).alias("alpha"), F.lit(k).alias("k")) for k, a in enumerate(M.SES_GRID)])
    s = s.select("sku", "train", "test", F.explode(grid).alias("g")).select("sku", "train", "test", "g.*").withColumn("level", M.ses_level(F.col("train"), F.col("alpha")))
    return s.withColumn("mape", R.errors(F.col("test"), F.col("level"))["mape"])


@query(_SPLIT + f", g AS ({_SESGRID}), e AS (SELECT sku, alpha, k, round(list_avg(list_transform(list_filter(te, lambda y: y <> 0), lambda y: abs((y - level) / y))), 9) AS mape FROM g) SELECT sku, alpha, round(mape, 6) AS mape FROM (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY mape, k) AS rn FROM e) WHERE rn = 1")
def hp_best_by_validation(spark, d):
    g = _ses_grid(spark, d).groupBy("sku").agg(F.min(F.struct(_r("mape", 9).alias("mape"), "k", "alpha")).alias("b"))
    return g.select("sku", F.col("b.alpha").alias("alpha"), _r("b.mape").alias("mape"))


@query(f"WITH {S_BRAND}, f AS (SELECT sku, {SES.format(q='q', a='0.3::DOUBLE').replace('(1 - 0.3::DOUBLE)', '0.7::DOUBLE')} AS level FROM sb) SELECT sku, h AS horizon, round(level * h, 4) AS total FROM f CROSS JOIN (VALUES " + ", ".join(f"({h})" for h in H) + ") t(h)")
def horizon_totals_flat(spark, d):
    s = V.series(_brand(spark, d)).withColumn("level", M.ses_level(F.col("q")))
    parts = ", ".join(f"{h}, level * {h}" for h in H)
    return s.selectExpr("sku", f"stack({len(H)}, {parts}) AS (horizon, total)").select("sku", "horizon", _r("total", 4).alias("total"))


@query(f"WITH {S_BRAND}, a AS (SELECT sku, avg(qty) AS m FROM db GROUP BY 1), k AS (SELECT sku, isodow(d) - 1 AS dow, avg(qty) AS x FROM db GROUP BY 1, 2), l AS (SELECT sku, last_d, list_avg(q[n - 6:]) AS level FROM sb), days AS (SELECT sku, level, h, isodow(last_d + CAST(i AS INTEGER)) - 1 AS dow FROM l, (VALUES (7), (30), (90)) t(h), range(1, 91) r(i) WHERE i <= h) SELECT sku, h AS horizon, round(sum(level * x / m), 4) AS total FROM days JOIN k USING (sku, dow) JOIN a USING (sku) GROUP BY 1, 2")
def dow_shaped_horizons(spark, d):
    demand = _brand(spark, d)
    s = V.series(demand).join(R.dow_multipliers(demand), "sku").withColumns({"level": M.naive_level(F.col("q")), "last_d": F.element_at("ds", -1)})
    t = F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), _r(R.dow_total(F.col("level") * h, h, F.col("m"), F.col("last_d")), 4).alias("total")) for h in (7, 30, 90)]))
    return s.select("sku", t.alias("t")).select("sku", "t.*")


_EFF = "greatest(7, least(365, p_size * 8))"


@query(f"SELECT p_partkey AS sku, {_EFF} AS effective_max_horizon, " + ", ".join("round(p_retailprice * CASE " + " ".join(f"WHEN {_EFF} >= {k} THEN {k}" for k in reversed([x for x in H if x <= h])) + f" ELSE {H[0]} END, 4) AS h{h}" for h in H) + " FROM part")
def capped_horizons(spark, d):
    p = V.table(spark, d, "part").withColumn("m", S.effective_max_horizon(F.lit(None).cast("int"), F.col("p_size") * 8))
    capped = R.cap_horizons([F.col("p_retailprice") * h for h in H], F.col("m"))
    return p.select(F.col("p_partkey").alias("sku"), F.col("m").alias("effective_max_horizon"), *[_r(c, 4).alias(f"h{h}") for h, c in zip(H, capped)])


_LOGQ = M.spread_quantiles()


@query("WITH x AS (SELECT p_partkey AS sku, p_retailprice AS point, CASE p_partkey % 5 WHEN 0 THEN 'cold_start' WHEN 1 THEN 'intermittent' WHEN 2 THEN 'seasonal' WHEN 3 THEN 'trending' ELSE 'stable' END AS pattern FROM part) SELECT sku, pattern, " + ", ".join("round(point * CASE pattern " + " ".join(f"WHEN '{p}' THEN {_LOGQ[p][k]!r}::DOUBLE" for p in P.PATTERNS) + f" END, 4) AS {n}" for k, n in enumerate(("p50", "p80", "p90"))) + " FROM x")
def bootstrap_quantiles_lognormal(spark, d):
    p = V.table(spark, d, "part").withColumn("pattern", V.pattern_of(F.col("p_partkey")))
    p = p.withColumn("b", M.bootstrap_quantiles(F.col("p_retailprice"), F.array().cast("array<double>"), F.col("pattern")))
    return p.select(F.col("p_partkey").alias("sku"), "pattern", *[_r(f"b.{c}", 4).alias(c) for c in ("p50", "p80", "p90")])


_DRAWN = ", ".join(f"({k + 1}, {c})" for k, c in enumerate(M.resample_counts()[30]))


@query(f"WITH {S_BRAND}, l AS (SELECT sku, list_avg(q[n - 6:]) AS level, q[n - 29:] AS tail FROM sb WHERE n >= 30), r AS (SELECT sku, level, tail[k] - level AS r, c FROM l, (VALUES {_DRAWN}) t(k, c)), s AS (SELECT sku, level, greatest(0, level * 7 + r) AS v, unnest(range(c)) FROM r) SELECT sku, round(max(level) * 7, 4) AS mean, round(quantile_cont(v, 0.5), 4) AS p50, round(quantile_cont(v, 0.8), 4) AS p80, round(quantile_cont(v, 0.9), 4) AS p90 FROM s GROUP BY 1")
def bootstrap_quantiles_residual(spark, d):
    s = V.series(_brand(spark, d)).where("n >= 30").withColumn("level", M.naive_level(F.col("q")))
    s = s.withColumn("b", M.bootstrap_quantiles(F.col("level") * 7, M.residuals(F.col("q"), F.col("level")), F.lit("stable")))
    return s.select("sku", *[_r(f"b.{c}", 4).alias(c) for c in ("mean", "p50", "p80", "p90")])


@query(f"WITH {S_BRAND}, l AS (SELECT sku, q[n - 13:] AS w FROM sb), i AS (SELECT sku, w, list_avg(list_filter(w, lambda x: x > 0)) AS s0 FROM l), f AS (SELECT sku, s0, list_reduce(list_transform(w, lambda x: CAST(x AS DOUBLE)), lambda s, x: 0.3::DOUBLE * x + 0.7::DOUBLE * s, s0) AS s1 FROM i) SELECT sku, round(least(2.0, greatest(0.5, s1 / s0)), 6) AS scale, round_even(s0 * least(2.0, greatest(0.5, s1 / s0)), 4) AS p50 FROM f")
def level_scale_cache(spark, d):
    s = V.series(_brand(spark, d))
    start = M.mean(F.filter(M.last(F.col("q"), 14), lambda x: x > 0))
    prior = s.select("sku", F.create_map(F.lit("forecast"), F.create_map(F.lit("p50"), start)).alias("h"))
    scaled = W.cache_track(prior, s).join(s.select("sku", _r(R.level_scale(F.col("q"))).alias("scale")), "sku")
    return scaled.select("sku", "scale", F.col("h")["forecast"]["p50"].alias("p50"))


@query()
def seasonal_fit_forecast(spark, d):
    s = V.series(V.daily_demand(spark, d, "type"))
    f = A.seasonal_forecast(s)
    return f.select("sku", *[_r(f"h{h}", 3).alias(f"h{h}") for h in H])


@query()
def structural_break_pelt(spark, d):
    return A.structural_break(V.series(V.daily_demand(spark, d, "type")))


# ---- decisions, scores, routing


@query(f"WITH {D_PART}, {{s}} SELECT sku, pattern, CASE WHEN pattern = 'seasonal' AND n < 120 THEN 'holts_linear_trend' ELSE model END AS model, CASE WHEN sku % 7 = 0 THEN 0.99 WHEN pattern IN ('trending', 'stable') THEN 0.8 ELSE 0.9 END::DOUBLE AS quantile FROM s".replace("{s}", f"s AS (SELECT sku, count(*) AS n, {PATTERN} AS pattern, {MODEL} AS model FROM dp GROUP BY 1)"))
def model_assignment_and_quantile(spark, d):
    p = P.defaults()
    s = _part(spark, d).groupBy("sku").agg(F.count("*").alias("n")).withColumn("pattern", V.pattern_of(F.col("sku")))
    crit = F.when(F.col("sku") % 7 == 0, "A").otherwise("B")
    return s.select("sku", "pattern", S.assigned_model(p, F.col("pattern"), F.col("n")).alias("model"), S.selected_quantile(p, F.col("pattern"), crit).alias("quantile"))


@query("SELECT p_partkey AS sku, CASE WHEN p_size % 3 = 0 THEN greatest(7, least(365, p_size * 4)) WHEN p_size % 3 = 1 THEN greatest(7, least(365, greatest(0, p_size * 10 - 100), p_size * 4)) ELSE greatest(7, least(365, greatest(0, p_size * 10 - 100))) END AS effective_max_horizon FROM part")
def effective_max_horizon(spark, d):
    end = F.when(F.col("p_size") % 3 != 0, F.col("p_size") * 10 - 100)
    shelf = F.when(F.col("p_size") % 3 != 2, F.col("p_size") * 4)
    return V.table(spark, d, "part").select(F.col("p_partkey").alias("sku"), S.effective_max_horizon(end, shelf).alias("effective_max_horizon"))


_TS = "ts AS (SELECT l_partkey AS sku, l_returnflag AS model, l_linestatus AS config_hash, 1 + sum(CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END) AS alpha, 1 + sum(CASE WHEN l_quantity < 25 THEN 1 ELSE 0 END) AS beta, count(*) AS trials FROM lineitem GROUP BY 1, 2, 3)"


def _thompson(spark, d) -> DataFrame:
    big = F.count_if(F.col("l_quantity") >= 25)
    g = V.table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("sku"), F.col("l_returnflag").alias("model"), F.col("l_linestatus").alias("config_hash"))
    return g.agg((1 + big).alias("alpha"), (1 + F.count("*") - big).alias("beta"), F.count("*").alias("trials"))


@query(f"WITH {_TS} SELECT sku, model, config_hash, round(alpha / (alpha + beta), 6) AS mean FROM ts")
def thompson_posterior_mean(spark, d):
    return L.thompson_means(_thompson(spark, d)).select("sku", "model", "config_hash", _r("mean").alias("mean"))


@query(f"WITH {_TS} SELECT sku, model, config_hash FROM (SELECT *, row_number() OVER (PARTITION BY sku, model ORDER BY alpha / (alpha + beta) DESC, config_hash) AS rn FROM ts) WHERE rn = 1")
def thompson_best_config(spark, d):
    return L.thompson_best(_thompson(spark, d)).select("sku", "model", "config_hash")


_DRAW = "list_sort(list_transform(range(1, CAST(alpha + beta AS BIGINT)), lambda k: CAST('0x' || substr(md5(sku || '|' || model || '|' || config_hash || '|run-1|' || k), 1, 13) AS BIGINT) / 4503599627370496.0))[CAST(alpha AS BIGINT)]"


@query(f"WITH {_TS}, dr AS (SELECT *, {_DRAW} AS theta, alpha / (alpha + beta) AS m FROM ts), r AS (SELECT *, row_number() OVER (PARTITION BY sku, model ORDER BY m DESC, config_hash) AS top, row_number() OVER (PARTITION BY sku, model ORDER BY theta DESC, config_hash) AS rn FROM dr), k AS (SELECT *, max(CASE WHEN top = 1 AND rn <= 1 THEN 1 ELSE 0 END) OVER (PARTITION BY sku, model) AS has FROM r) SELECT sku, model, config_hash, round(theta, 6) AS theta, top = 1 AS incumbent FROM k WHERE top = 1 OR rn <= has")
def thompson_sample_topk(spark, d):
    return L.thompson_sample(_thompson(spark, d), "run-1", 1).select("sku", "model", "config_hash", _r("theta").alias("theta"), "incumbent")


@query(f"WITH {_TS} SELECT sku, model, config_hash, CASE WHEN alpha / (alpha + beta) > 0.6 AND trials >= CASE sku % 3 WHEN 0 THEN 3 WHEN 1 THEN 5 ELSE 8 END AND sku % 11 <> 0 AND sku % 13 <> 0 THEN 'exploit' ELSE 'explore' END AS mode FROM ts")
def learning_mode(spark, d):
    k = F.col("sku")
    maturity = F.when(k % 3 == 0, "established").when(k % 3 == 1, "developing").otherwise("new")
    mode = S.learning_mode(P.defaults(), F.col("alpha"), F.col("beta"), F.col("trials"), maturity, k % 11 == 0, k % 13 == 0)
    return _thompson(spark, d).select("sku", "model", "config_hash", mode.alias("mode"))


@query("SELECT p_partkey AS sku, round(CASE WHEN p_partkey % 5 = 1 OR p_partkey % 4 = 0 THEN 1.0 ELSE least(1.5, greatest(1.0, 1 + p_size / 50.0 * 0.8)) END, 6) AS factor FROM part")
def oos_factor(spark, d):
    pct = F.when(F.col("p_partkey") % 4 != 0, F.col("p_size") / 50.0)
    return V.table(spark, d, "part").select(F.col("p_partkey").alias("sku"), _r(S.oos_factor(V.pattern_of(F.col("p_partkey")), pct, F.lit(0.8))).alias("factor"))


_REO = "re AS (SELECT user_id AS sku, event_type = 'error' AS stockout, value / 100 AS overstock_pct, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)"


def _reorder(spark, d) -> DataFrame:
    e = V.table(spark, d, "events").select(F.col("event_id").alias("signal_id"), "ts", F.col("user_id").alias("sku"), (F.col("event_type") == "error").alias("stockout"), (F.col("value") / 100).alias("overstock_pct"))
    return L.reorder_aggregate(e, 5)


@query(f"WITH {_REO} SELECT sku, sum(CASE WHEN stockout THEN 1 ELSE 0 END) AS stockouts, round(avg(overstock_pct), 6) AS overstock, count(*) AS n FROM re WHERE rn <= 5 GROUP BY 1")
def reorder_signal_aggregate(spark, d):
    return _reorder(spark, d).select("sku", "stockouts", _r("overstock").alias("overstock"), "n")


@query(f"WITH {_REO}, g AS (SELECT sku, sum(CASE WHEN stockout THEN 1 ELSE 0 END) AS s, avg(overstock_pct) AS o FROM re WHERE rn <= 5 GROUP BY 1) SELECT sku, CASE WHEN s >= 2 THEN 1.10 WHEN o > 0.3 THEN 0.92 ELSE 1.0 END::DOUBLE AS factor, round(CASE WHEN s >= 2 THEN least(0.5, 0.2 * 1.1) WHEN o > 0.3 THEN greatest(0.05, 0.2 * 0.92) END, 6)::DOUBLE AS safety_stock FROM g")
def reorder_bias_and_safety_stock(spark, d):
    return _reorder(spark, d).select("sku", S.reorder_factor(F.col("stockouts"), F.col("overstock")).alias("factor"), _r(S.safety_stock_evidence(F.lit(0.2), F.col("stockouts"), F.col("overstock"))).alias("safety_stock"))


@query(f"WITH {D_PART}, c AS (SELECT sku, count(*) AS obs FROM dp GROUP BY 1), w AS (SELECT sku, obs, CASE WHEN obs < 14 THEN 14 WHEN obs < 60 THEN greatest(14, obs // 3) WHEN obs >= 180 AND sku % 2 = 0 THEN 90 ELSE CASE WHEN sku % 3 = 0 THEN 45 ELSE 60 END END AS w FROM c) SELECT sku, obs, CASE WHEN greatest(14, least(w, 90)) >= obs THEN greatest(1, obs // 3) ELSE greatest(14, least(w, 90)) END AS window_days FROM w")
def backtest_window_choice(spark, d):
    c = _part(spark, d).groupBy("sku").agg(F.count("*").alias("obs"))
    mode, known = F.when(F.col("sku") % 2 == 0, "exploit").otherwise("explore"), F.when(F.col("sku") % 3 == 0, 45)
    return c.select("sku", "obs", S.backtest_window(P.defaults(), F.col("obs"), F.col("obs") < 14, mode, known).cast("long").alias("window_days"))


_CONF = """c AS (SELECT p_partkey AS sku, CASE p_partkey % 5 WHEN 0 THEN 0.5 WHEN 1 THEN 0.6 WHEN 2 THEN 0.8 WHEN 3 THEN 0.7 ELSE 0.9 END::DOUBLE * (1 - least(0.5, coalesce(CASE WHEN p_size % 7 <> 0 THEN p_size / 100.0 END, 0.5)))
* CASE WHEN p_size % 4 = 0 THEN 0.8 ELSE 1 END * CASE WHEN p_size - 25 > 10 THEN 0.9 WHEN p_size - 25 < -10 THEN 1.1 ELSE 1 END * CASE WHEN p_size < 20 THEN 0.92 ELSE 1 END * CASE WHEN p_size % 2 = 0 THEN 1.1 ELSE 1 END * CASE WHEN p_size % 6 = 0 THEN 0.85 WHEN p_size % 6 = 1 THEN 0.75 ELSE 1 END AS raw, p_size, p_size % 9 = 0 AS watch, p_size % 8 = 0 AS hm FROM part),
k AS (SELECT sku, least(0.95, greatest(0.3, raw)) AS c, watch, hm FROM c)"""


def _confidence(spark, d) -> DataFrame:
    n = F.col("p_size")
    flags = F.array_compact(F.array(F.when(n % 4 == 0, F.lit("stockout")), F.when(n % 8 == 0, F.lit("high_mape"))))
    mape, gap = F.when(n % 7 != 0, n / 100.0), (n - 25) / 100.0
    c = S.confidence(P.defaults(), V.pattern_of(F.col("p_partkey")), mape, flags, gap, F.when(n < 20, 0.5).otherwise(0.9), F.when(n % 2 == 0, 1.1).otherwise(1.0), n % 6 == 0, n % 6 == 1, F.lit(1.0))
    return V.table(spark, d, "part").select(F.col("p_partkey").alias("sku"), c.alias("c"), flags.alias("flags"), (n % 9 == 0).alias("watch"))


@query(f"WITH {_CONF} SELECT sku, round(c, 6) AS confidence FROM k")
def confidence_score(spark, d):
    return _confidence(spark, d).select("sku", _r("c").alias("confidence"))


@query(f"WITH {_CONF}, r AS (SELECT *, round(c, 9) AS x FROM k) SELECT sku, CASE WHEN x >= 0.7 THEN 'auto_proceed' WHEN x >= 0.6 THEN 'review_suggested' WHEN x >= 0.45 THEN 'review_required' ELSE 'manual_override' END AS tier, CASE WHEN watch THEN 'watchlist_review' WHEN hm OR x < 0.7 THEN 'needs_acknowledgment' ELSE 'forecasted' END AS status, CASE WHEN x >= 0.85 THEN 'low' WHEN x >= 0.7 THEN 'medium' ELSE 'high' END AS risk FROM r")
def confidence_tier_status_risk(spark, d):
    p, x = P.defaults(), _r("c", 9)
    return _confidence(spark, d).select("sku", S.tier(p, x).alias("tier"), S.status(p, x, F.col("flags"), F.col("watch")).alias("status"), S.risk(p, x).alias("risk"))


@query(f"WITH {S_PART}, b AS (SELECT sku, n, list_avg(q[greatest(1, n - 89):]) AS base, q[n] AS daily FROM sp) SELECT sku, CASE WHEN n >= 14 AND base > 0 AND daily > base * 5 THEN 'forecast_unusually_high' WHEN n >= 14 AND base > 0 AND daily < base * 0.1 THEN 'forecast_unusually_low' ELSE '' END AS flags, CASE WHEN n >= 14 AND base > 0 AND daily > base * 5 THEN 0.85 WHEN n >= 14 AND base > 0 AND daily < base * 0.1 THEN 0.9 ELSE 1.0 END::DOUBLE AS multiplier FROM b")
def reasonableness_flags(spark, d):
    flags, mult = S.reasonableness(P.defaults(), F.element_at("q", -1) * 30, M.mean(M.last(F.col("q"), 90)), F.col("n"))
    return V.series(_part(spark, d)).select("sku", F.array_join(flags, "|").alias("flags"), mult.alias("multiplier"))


@query(_SPLIT + ", f AS (SELECT sku, te, list_avg(tr[len(tr) - 6:]) AS level FROM t), m AS (SELECT sku, list_avg(list_transform(list_filter(te, lambda y: y <> 0), lambda y: abs((y - level) / y))) AS mape FROM f) SELECT sku, round(coalesce(mape, 0.5), 6) AS mape, CASE WHEN mape IS NULL THEN 'proxy' WHEN mape < 0.15 THEN 'good' WHEN mape < 0.4 THEN 'acceptable' ELSE 'poor' END AS quality, sku LIKE '%1' AS hint_matched FROM m")
def pattern_feedback_quality(spark, d):
    s = R.split(V.series(_brand(spark, d)).where("n > 14"))
    s = s.withColumn("mape", R.errors(F.col("test"), M.naive_level(F.col("train")))["mape"])
    hint = F.when(F.col("sku").endswith("1"), F.lit("NAIVE_forecast")).otherwise(F.lit(""))
    return s.select("sku", _r(F.coalesce("mape", F.lit(P.PROXY_MAPE))).alias("mape"), S.quality(F.col("mape"), F.lit(False)).alias("quality"), S.hint_matched(hint, F.lit("naive_forecast")).alias("hint_matched"))


_FP = f"{S_PART}, fp AS (SELECT sku, q, n, sha256(concat_ws('|', CAST(sku AS VARCHAR), array_to_string(list_transform(q[greatest(1, n - 29):n], lambda x: printf('%.2f', x)), ','), {PATTERN}, '0.000', '')) AS f, sha256(concat_ws('|', CAST(sku AS VARCHAR), array_to_string(list_transform(q[greatest(1, n - 30):n - 1], lambda x: printf('%.2f', x)), ','), {PATTERN}, '0.000', '')) AS old, list_sum(q[greatest(1, n - 29):n]) AS total, coalesce(list_sum(q[greatest(1, n - 30):n - 1]), 0) AS old_total FROM sp)"


def _prints(spark, d) -> DataFrame:
    s = V.series(_part(spark, d)).withColumn("pattern", V.pattern_of(F.col("sku")))
    q = F.col("q")
    now, then = M.last(q, 30), M.last(F.slice(q, F.lit(1), F.greatest(F.size(q) - 1, F.lit(0))), 30)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    fp = lambda a: S.fingerprint(F.col("sku"), a, F.col("pattern"), F.lit(0.0), F.lit(None).cast("string"))
    return s.select("sku", "pattern", fp(now).alias("f"), fp(then).alias("old"), total(now).alias("total"), total(then).alias("old_total"))


@query(f"WITH {_FP} SELECT sku, f AS fingerprint FROM fp")
def fingerprint_sha256(spark, d):
    return _prints(spark, d).select("sku", F.col("f").alias("fingerprint"))


@query(f"WITH {_FP}, c AS (SELECT *, CASE WHEN sku % 10 = 0 THEN NULL WHEN sku % 10 < 5 THEN f ELSE old END AS cached FROM fp), t AS (SELECT sku, CASE WHEN cached IS NULL THEN 'full' WHEN f = cached THEN 'cache' WHEN sku % 10 = 9 THEN 'full' WHEN old_total > 0 AND abs(total - old_total) / old_total < 0.1 THEN 'partial' ELSE 'full' END AS t FROM c) SELECT sku, CASE WHEN sku % 17 = 0 THEN 'full' WHEN sku % 19 = 0 AND t = 'cache' THEN 'partial' ELSE t END AS tier FROM t")
def tier_classification(spark, d):
    k = F.col("sku")
    cached = F.when(k % 10 == 0, None).when(k % 10 < 5, F.col("f")).otherwise(F.col("old"))
    other = F.when(k % 10 == 9, F.lit("none")).otherwise(F.col("pattern"))
    return _prints(spark, d).select("sku", S.processing_tier(F.col("f"), cached, F.col("pattern"), other, F.col("total"), F.col("old_total"), k % 17 == 0, k % 19 == 0).alias("tier"))


# ---- the learning loop


def _today(spark, d):
    return V.last_order_day(spark, d).scalar()


def _outcomes(spark, d) -> DataFrame:
    f = V.forecasts(spark, d)
    o = L.outcomes(f, V.actuals(spark, d)).withColumn("closed", F.expr("date_add(created, horizon)"))
    return o.where(F.col("closed") <= _today(spark, d))


@query(f"WITH {FC} SELECT f.sku, f.created, f.horizon FROM fc f LEFT JOIN (SELECT sku, created, horizon FROM fc WHERE sku % 3 = 0) r ON r.sku = f.sku AND r.created = f.created AND r.horizon = f.horizon WHERE r.sku IS NULL AND f.created + f.horizon <= (SELECT max(d) FROM act)")
def pending_outcomes_anti_join(spark, d):
    f = V.forecasts(spark, d)
    return L.pending(f, f.where("sku % 3 = 0"), _today(spark, d)).select("sku", "created", "horizon")


@query(f"WITH {OUT} SELECT sku, created, horizon, round(actual, 4) AS actual, n_days FROM spans")
def outcome_actuals_range_join(spark, d):
    r = L.range_sums(V.forecasts(spark, d), V.actuals(spark, d)).where("n_days > 0")
    return r.select("sku", "created", "horizon", _r("actual", 4).alias("actual"), F.col("n_days").cast("long").alias("n_days"))


# the errors in whole numbers: ten-thousandths of a unit, halves away from 0
_UNITS = "CAST(CAST(round({c} * 10000) AS BIGINT) AS HUGEINT)"
_THIRD = "((2000 * abs(a - f) + a) // (2 * a))::DOUBLE / 1000"


@query(f"WITH {OUT}, e AS (SELECT *, {_UNITS.format(c='forecast')} AS f, {_UNITS.format(c='actual')} AS a FROM outc WHERE created + horizon <= (SELECT max(d) FROM act)) SELECT sku, created, horizon, forecast, CASE WHEN a <> 0 THEN {_THIRD} END AS error, CASE WHEN a <> 0 THEN sign(f - a) * {_THIRD} + 0.0 END AS bias FROM e")
def outcome_errors(spark, d):
    return _outcomes(spark, d).select("sku", "created", "horizon", "forecast", "error", "bias")


@query(f"WITH {OUT}, g AS (SELECT pattern, model, quantile, horizon, count(*) AS n, avg(CASE WHEN actual <= forecast THEN 1.0 ELSE 0.0 END) AS c FROM outs GROUP BY 1, 2, 3, 4) SELECT pattern, model, horizon, n, round_even(c, 3) AS coverage, round_even(quantile, 3) AS target, round_even(c - quantile, 4) AS gap FROM g")
def quantile_coverage(spark, d):
    c = L.coverage(_outcomes(spark, d), ["pattern", "model", "quantile", "horizon"])
    return c.select("pattern", "model", "horizon", "n", "coverage", "target", "gap")


@query(f"WITH {OUT} SELECT model, horizon, round(avg(error), 4) AS avg_mape, round(quantile_cont(error, 0.5), 4) AS median_mape, round(quantile_cont(error, 0.9), 4) AS p90_mape, round(avg(bias), 4) AS avg_bias, count(*) AS n FROM outs WHERE error IS NOT NULL GROUP BY 1, 2")
def model_performance_30d(spark, d):
    p = L.performance(_outcomes(spark, d))
    return p.select("model", "horizon", *[_r(c, 4).alias(c) for c in ("avg_mape", "median_mape", "p90_mape", "avg_bias")], "n")


_MEAN = "CAST(sum(CAST(error AS DECIMAL(18, 3))) FILTER ({c}) AS DOUBLE) / nullif(count(*) FILTER ({c}), 0)"
_TREND = f"g AS (SELECT model, horizon, {_MEAN.format(c='t - closed < 30')} AS m, {_MEAN.format(c='t - closed >= 30 AND t - closed < 60')} AS p FROM outs, (SELECT max(d) AS t FROM act) WHERE error IS NOT NULL GROUP BY 1, 2)"


@query(f"WITH {OUT}, {_TREND} SELECT model, horizon, round(m + 1e-9, 4) AS mape, round(p + 1e-9, 4) AS prior_mape, CASE WHEN round(m - p, 9) < -0.02 THEN 'improving' WHEN round(m - p, 9) > 0.02 THEN 'degrading' ELSE 'stable' END AS trend FROM g WHERE m IS NOT NULL")
def model_performance_trend(spark, d):
    t = L.performance_trend(_outcomes(spark, d), _today(spark, d))
    return t.select("model", "horizon", _r(F.col("mape") + 1e-9, 4).alias("mape"), _r(F.col("prior_mape") + 1e-9, 4).alias("prior_mape"), "trend")


@query("WITH a AS (SELECT DISTINCT l_partkey AS sku FROM lineitem WHERE l_shipdate >= (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 90 DAY), b AS (SELECT DISTINCT l_partkey AS sku FROM lineitem WHERE l_shipdate < (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 90 DAY AND l_shipdate >= (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 180 DAY) SELECT sku, 'new' AS change FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT sku, 'discontinued' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)")
def new_discontinued_items(spark, d):
    li = V.table(spark, d, "lineitem").select(F.col("l_partkey").alias("sku"), "l_shipdate")
    now = li.agg(F.max("l_shipdate").alias("m")).scalar()
    a = li.where(F.col("l_shipdate") >= now - F.expr("INTERVAL 90 DAYS"))
    b = li.where((F.col("l_shipdate") < now - F.expr("INTERVAL 90 DAYS")) & (F.col("l_shipdate") >= now - F.expr("INTERVAL 180 DAYS")))
    return L.new_and_gone(a, b, ["sku"])


@query(f"WITH {OUT}, e AS (SELECT pattern, 1 - least(1, avg(error)) AS ev, count(*) AS n FROM outs WHERE horizon = 30 AND error IS NOT NULL GROUP BY 1), p AS (SELECT * FROM (VALUES ('cold_start', 0.5::DOUBLE), ('intermittent', 0.6), ('seasonal', 0.8), ('trending', 0.7), ('stable', 0.9)) t(pattern, v)) SELECT 'confidence_base_' || pattern AS param_name, round(CASE WHEN n >= 10 THEN v + 0.1 * (greatest(0, ev) - v) ELSE v END, 5) AS value FROM p LEFT JOIN e USING (pattern)")
def params_ema_update(spark, d):
    o = _outcomes(spark, d).where("horizon = 30 and error is not null").groupBy("pattern").agg((1 - F.least(F.lit(1.0), F.avg("error"))).alias("ev"), F.count("*").alias("n"))
    e = o.where(F.col("n") >= P.DEFAULTS["min_learning_evidence_count"]).select(F.lit(0).alias("tenant_id"), F.concat(F.lit("confidence_base_"), "pattern").alias("param_name"), S.safe_evidence(F.col("ev")).alias("evidence"))
    p = P.defaults_table(spark).where(F.col("param_name").startswith("confidence_base_")).withColumn("tenant_id", F.lit(0))
    return P.ema_update(p, e).select("param_name", _r("value", 5).alias("value"))


@query(f"WITH {OUT}, c AS (SELECT pattern, avg(CASE WHEN actual <= forecast THEN 1.0 ELSE 0.0 END) AS c, max(quantile) AS q FROM outs GROUP BY 1) SELECT pattern, round(CASE WHEN abs(q - c) < 0.01 THEN q ELSE least(0.99, greatest(0.5, q + CASE WHEN q - c > 0 THEN 0.02 ELSE -0.02 END)) END, 6) AS evidence FROM c")
def quantile_evidence_step(spark, d):
    c = _outcomes(spark, d).groupBy("pattern").agg(F.avg((F.col("actual") <= F.col("forecast")).cast("double")).alias("c"), F.max("quantile").alias("q"))
    return c.select("pattern", _r(S.quantile_evidence(F.col("c"), F.col("q"), F.col("q"), 0.02)).alias("evidence"))


def _results(spark, d) -> DataFrame:
    o = F.col("o_orderkey")
    tier = F.when(o % 10 < 6, "cache").when(o % 10 < 8, "partial").otherwise("full")
    status = F.when(F.col("o_orderstatus") == "F", "forecasted").when(F.col("o_orderstatus") == "O", "needs_acknowledgment").otherwise("watchlist_review")
    return V.table(spark, d, "orders").select(tier.alias("tier"), status.alias("status"), F.when(o % 13 != 0, (o % 100) / 100.0).alias("confidence"), (o % 9 == 0).alias("fallback"))


@query("WITH r AS (SELECT CASE WHEN o_orderkey % 10 < 6 THEN 'cache' WHEN o_orderkey % 10 < 8 THEN 'partial' ELSE 'full' END AS tier, o_orderstatus AS st, CASE WHEN o_orderkey % 13 <> 0 THEN (o_orderkey % 100) / 100.0 END AS c, o_orderkey % 9 = 0 AS fb FROM orders) SELECT count(*) AS total, count(*) FILTER (tier = 'cache') AS cache_hits, count(*) FILTER (tier = 'partial') AS partials, count(*) FILTER (tier = 'full') AS fulls, round(count(*) FILTER (st = 'F') / count(*), 6) AS pct_auto, round(count(*) FILTER (st <> 'F') / count(*), 6) AS pct_review, round(avg(c), 6) AS avg_confidence, count(*) FILTER (fb) AS fallbacks, count(*) FILTER (fb) / count(*) > 0.1 AS high_fallback, count(*) FILTER (tier = 'cache') / count(*) < 0.5 AS low_cache_hit, count(*) FILTER (NOT fb) / count(*) < 0.9 AS low_success FROM r")
def run_statistics(spark, d):
    s = L.run_statistics(_results(spark, d))
    return s.select(*[_r(c).alias(c) if c in ("pct_auto", "pct_review", "avg_confidence") else F.col(c) for c in s.columns])


@query(f"WITH {OUT}, a AS (SELECT model, avg(error) AS m FROM outs WHERE error IS NOT NULL AND horizon = 30 AND model <> 'croston' GROUP BY 1), b AS (SELECT model, avg(error) AS m FROM outs WHERE error IS NOT NULL AND horizon = 14 GROUP BY 1), f AS (SELECT * FROM (VALUES ('naive_forecast'), ('croston'), ('prophet'), ('holts_linear_trend'), ('simple_exponential_smoothing')) t(model)) SELECT f.model, round(a.m, 4) AS mape, round(b.m, 4) AS prior_mape, CASE WHEN a.m IS NULL THEN 'unknown' WHEN round(a.m - b.m, 9) < -0.02 THEN 'improving' WHEN round(a.m - b.m, 9) > 0.02 THEN 'degrading' ELSE 'stable' END AS trend FROM f LEFT JOIN a USING (model) LEFT JOIN b USING (model)")
def self_assessment_health(spark, d):
    p = L.performance(_outcomes(spark, d))
    h = L.model_health(p.where("horizon = 30 and model <> 'croston'"), p.where("horizon = 14"))
    return h.select("model", _r("mape", 4).alias("mape"), _r("prior_mape", 4).alias("prior_mape"), "trend")


@query(f"WITH {D_PART}, t AS (SELECT sku, sum(qty) AS total FROM dp GROUP BY 1) SELECT sku, total, CASE WHEN row_number() OVER (ORDER BY total DESC, sku) <= greatest(1, round((SELECT count(*) FROM t) * 0.2)) THEN 'A' ELSE 'B' END AS criticality FROM t")
def top_volume_criticality(spark, d):
    return L.top_volume(_part(spark, d).groupBy("sku").agg(F.sum("qty").alias("total")))


@query(f"WITH {_TS}, n AS (SELECT sku, model, config_hash, round(alpha / (alpha + beta), 6) AS score, trials FROM ts WHERE sku % 2 = 0), o AS (SELECT sku, model, config_hash, 0.5::DOUBLE AS score, 0 AS trials FROM ts WHERE sku % 3 = 0) SELECT * FROM n UNION ALL SELECT o.* FROM o ANTI JOIN n USING (sku, model, config_hash)")
def similarity_registry_upsert(spark, d):
    t = _thompson(spark, d)
    cols = ["sku", "model", "config_hash"]
    now = L.thompson_means(t.where("sku % 2 = 0")).select(*cols, _r("mean").alias("score"), "trials")
    old = t.where("sku % 3 = 0").select(*cols, F.lit(0.5).alias("score"), F.lit(0).cast("long").alias("trials"))
    return K.upserted(old, now, cols, "trials")


@query(f"WITH {FC}, h AS (SELECT sku, created, horizon, p50 FROM fc WHERE sku % 3 = 0), n AS (SELECT sku, created, horizon, p80 AS p50 FROM fc WHERE sku % 2 = 0) SELECT * FROM h UNION ALL SELECT n.* FROM n ANTI JOIN h USING (sku, created, horizon)")
def outcomes_insert_ignored(spark, d):
    f = V.forecasts(spark, d)
    keys = ["sku", "created", "horizon"]
    return K.insert_ignored(f.where("sku % 3 = 0").select(*keys, "p50"), f.where("sku % 2 = 0").select(*keys, F.col("p80").alias("p50")), keys)


@query(f"WITH {_TS}, o AS (SELECT * FROM ts WHERE sku % 3 = 0), n AS (SELECT * FROM ts WHERE sku % 2 = 0) SELECT coalesce(o.sku, n.sku) AS sku, coalesce(o.model, n.model) AS model, coalesce(o.config_hash, n.config_hash) AS config_hash, coalesce(n.beta, o.alpha) AS alpha, coalesce(o.trials, 0) + CASE WHEN n.sku IS NULL THEN 0 ELSE 1 END AS trials FROM o FULL JOIN n ON o.sku = n.sku AND o.model = n.model AND o.config_hash = n.config_hash")
def thompson_counted_upsert(spark, d):
    t = _thompson(spark, d)
    keys = ["sku", "model", "config_hash"]
    return K.counted_upsert(t.where("sku % 3 = 0").select(*keys, "alpha", "trials"), t.where("sku % 2 = 0").select(*keys, F.col("beta").alias("alpha")), keys, "trials", [])


# ---- evaluation

_FOLDS = f"""{S_BRAND}, f AS (SELECT sku, q, n, cut FROM (SELECT *, unnest(range(200, n - 6, 100)) AS cut FROM sb)),
l AS (SELECT sku, q, n, cut, list_reduce(list_transform(q[1:cut], lambda x: CAST(x AS DOUBLE)), lambda s, x: 0.3::DOUBLE * x + 0.7::DOUBLE * s) AS level FROM f),
w AS (SELECT sku, cut, h AS horizon, level * h AS forecast, list_sum(q[cut + 1:cut + h]) AS actual FROM l, (VALUES (7), (14), (30)) t(h) WHERE n - cut >= h),
e AS (SELECT *, abs(actual - forecast) / nullif(actual, 0) AS mape, abs(actual - forecast) AS mae, power(actual - forecast, 2) AS sq FROM w)"""


@query(f"WITH {_FOLDS} SELECT sku, cut, horizon, round(forecast, 4) AS forecast, actual FROM e")
def walk_forward_folds(spark, d):
    w = W.walk_forward(V.series(_brand(spark, d)), 200, 100)
    return w.select("sku", "cut", "horizon", _r("forecast", 4).alias("forecast"), "actual")


@query(f"WITH {_FOLDS}, p AS (SELECT *, CASE WHEN sku LIKE '%1' THEN 'stable' ELSE 'trending' END AS pattern FROM e) SELECT CASE WHEN grouping(sku) = 0 THEN 'sku' WHEN grouping(pattern) = 0 THEN 'pattern' ELSE 'overall' END AS grain, sku, pattern, horizon, round(avg(mape), 6) AS avg_mape, round(quantile_cont(mape, 0.5), 6) AS median_mape, round(sqrt(avg(sq)), 4) AS rmse, count(mape) AS n FROM p GROUP BY GROUPING SETS ((sku, pattern, horizon), (pattern, horizon), (horizon))")
def accuracy_grouping_sets(spark, d):
    w = W.walk_forward(V.series(_brand(spark, d)), 200, 100).withColumn("pattern", F.when(F.col("sku").endswith("1"), "stable").otherwise("trending"))
    return L.accuracy_rollups(w).select("grain", "sku", "pattern", "horizon", _r("avg_mape").alias("avg_mape"), _r("median_mape").alias("median_mape"), _r("rmse", 4).alias("rmse"), "n")


@query(f"WITH {OUT} SELECT model, round(avg(error), 6) AS avg_mape FROM outs WHERE horizon = 30 AND model <> 'prophet' AND error IS NOT NULL GROUP BY 1")
def mean_mape_per_model(spark, d):
    return _outcomes(spark, d).where("horizon = 30 and model <> 'prophet' and error is not null").groupBy("model").agg(_r(F.avg("error")).alias("avg_mape"))


# ---- signals and streams


@query(f"WITH {SIG}, now AS (SELECT max(ts) AS t FROM sig) SELECT signal_id, sku, value FROM sig, now WHERE signal_type = 'error' AND (expires_at IS NULL OR expires_at > t) AND signal_id % 4 <> 0 ORDER BY ts DESC, signal_id DESC LIMIT 20")
def signal_peek_latest_n(spark, d):
    s = V.signals(spark, d)
    now = s.agg(F.max("ts").alias("t")).scalar()
    return G.peek(s, now, "error", claimed=s.where("signal_id % 4 = 0"), limit=20).select("signal_id", "sku", "value")


@query(f"WITH {SIG}, now AS (SELECT max(ts) AS t FROM sig) SELECT signal_type, count(*) AS n FROM sig, now WHERE expires_at IS NULL OR expires_at > t GROUP BY 1")
def signal_unexpired_ttl(spark, d):
    s = V.signals(spark, d)
    return G.live(s, s.agg(F.max("ts").alias("t")).scalar()).groupBy("signal_type").agg(F.count("*").alias("n"))


@query(f"WITH {SIG}, now AS (SELECT max(ts) AS t FROM sig) SELECT signal_id FROM sig, now WHERE signal_type = 'purchase' AND (expires_at IS NULL OR expires_at > t) AND signal_id % 2 <> 0")
def signal_consume_unclaimed(spark, d):
    s = V.signals(spark, d)
    return G.consume(s, s.where("signal_id % 2 = 0"), s.agg(F.max("ts").alias("t")).scalar(), "purchase").select("signal_id")


@query("SELECT event_type, round(avg(CAST(json_extract(props, '$.k') AS DOUBLE)), 6) AS mean_k, count(*) AS n FROM events GROUP BY 1")
def signal_payload_json(spark, d):
    return V.table(spark, d, "events").groupBy("event_type").agg(_r(F.avg(G.payload_number(F.col("props"), "k"))).alias("mean_k"), F.count("*").alias("n"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def events_tumbling(spark, d):
    e = V.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return G.tumbling(e).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("SELECT time_bucket(INTERVAL 3 HOUR, ts) - INTERVAL 3 HOUR * k AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events, (VALUES (0), (1)) t(k) GROUP BY 1, 2")
def events_sliding(spark, d):
    e = V.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return G.sliding(e).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("WITH a AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS f FROM events), b AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM a) SELECT user_id, min(ts) AS start, count(*) AS n FROM b GROUP BY user_id, s")
def events_sessions(spark, d):
    e = V.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return G.sessions(e).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS tenant, regexp_matches(n_name, '^[A-Za-z0-9-]{1,64}$') AS valid_tenant, regexp_matches(n_name, '^[A-Za-z0-9_-]{1,128}$') AS valid_run FROM nation")
def id_validation(spark, d):
    return V.table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("tenant"), F.col("n_name").rlike(G.TENANT_ID).alias("valid_tenant"), F.col("n_name").rlike(G.RUN_ID).alias("valid_run"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS sku, CASE WHEN h IS NULL OR h >= 18 THEN 'full' ELSE 'micro' END AS mode FROM (SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN c_custkey % 30 END AS h FROM customer)")
def execution_mode(spark, d):
    h = F.when(F.col("c_custkey") % 10 != 0, F.col("c_custkey") % 30)
    return V.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("sku"), S.execution_mode(h, 18).alias("mode"))


@query("SELECT i AS chunk, count(*) AS n, min(s_suppkey) AS first_key FROM (SELECT s_suppkey, ntile(7) OVER (ORDER BY s_suppkey) - 1 AS i FROM supplier) GROUP BY 1")
def balanced_chunks(spark, d):
    return R.balanced_chunks(V.table(spark, d, "supplier"), 7, "s_suppkey").groupBy("chunk").agg(F.count("*").alias("n"), F.min("s_suppkey").alias("first_key"))


# ---- extensions


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity * power(1 - l_discount, -1.5), 6) AS adjusted FROM lineitem WHERE l_discount >= 0.05")
def clearance_elasticity(spark, d):
    li = V.table(spark, d, "lineitem").where("l_discount >= 0.05")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", _r(S.clearance(F.col("l_quantity"), F.col("l_discount"), P.DEFAULTS["price_elasticity_clearance"])).alias("adjusted"))


@query("WITH t AS (SELECT p_brand, p_size, sum(l_quantity) AS q FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2) SELECT p_brand AS style, p_size AS size, round(q / sum(q) OVER (PARTITION BY p_brand), 6) AS share FROM t")
def size_curve_distribution(spark, d):
    t = V.table(spark, d, "lineitem").join(V.table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand", "p_size").agg(F.sum("l_quantity").alias("q"))
    return t.select(F.col("p_brand").alias("style"), F.col("p_size").alias("size"), _r(F.col("q") / F.sum("q").over(Window.partitionBy("p_brand"))).alias("share"))


@query(f"WITH {D_PART}, f AS (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY d) AS day FROM dp) SELECT p_type AS category, day, round(quantile_cont(qty, 0.5), 4) AS p50, count(*) AS comps FROM f JOIN part ON sku = p_partkey WHERE day <= 20 GROUP BY 1, 2 HAVING count(*) >= 3")
def category_comps_trajectory(spark, d):
    f = _part(spark, d).withColumn("day", F.row_number().over(Window.partitionBy("sku").orderBy("d"))).where("day <= 20")
    j = f.join(V.table(spark, d, "part"), F.col("sku") == F.col("p_partkey"))
    return j.groupBy(F.col("p_type").alias("category"), "day").agg(_r(F.percentile("qty", 0.5), 4).alias("p50"), F.count("*").alias("comps")).where("comps >= 3")


@query("SELECT p_partkey AS sku, CASE WHEN k <= 7 THEN 7 WHEN k <= 14 THEN 14 WHEN k <= 30 THEN 30 WHEN k <= 60 THEN 60 WHEN k <= 90 THEN 90 WHEN k <= 150 THEN 150 WHEN k <= 180 THEN 180 ELSE 365 END AS horizon FROM (SELECT p_partkey, p_size * 8 AS k FROM part)")
def nearest_ceiling_horizon(spark, d):
    return V.table(spark, d, "part").select(F.col("p_partkey").alias("sku"), S.ceiling_horizon(F.col("p_size") * 8).alias("horizon"))


# ---- whole runs

_FLAGSHIP = _FLAG.replace(f"WITH {S_BRAND}", f"WITH {S_BRAND}, t AS (SELECT sku, q[1:n - 14] AS tr, q[n - 13:n] AS te FROM sb), tm AS (SELECT sku, te, list_reduce(list_transform(tr, lambda x: CAST(x AS DOUBLE)), lambda a, x: 0.3::DOUBLE * x + 0.7::DOUBLE * a) AS lv FROM t), bt AS (SELECT sku, list_avg(list_transform(list_filter(te, lambda y: y <> 0), lambda y: abs((y - lv) / y))) AS mape FROM tm), lev AS (SELECT sku, n, list_reduce(list_transform(q, lambda x: CAST(x AS DOUBLE)), lambda a, x: 0.3::DOUBLE * x + 0.7::DOUBLE * a) AS level FROM sb)") + (
    ", al AS (SELECT fl.sku, n, level, mape, concat_ws('|', CASE WHEN stockout THEN 'stockout' END, CASE WHEN promo_spike THEN 'promo_spike' END, CASE WHEN unusual_drop THEN 'unusual_drop' END, CASE WHEN high_volatility THEN 'high_volatility' END, CASE WHEN mape > 0.5 THEN 'high_mape' END) AS flags, least(0.95, greatest(0.3, 0.9 * (1 - least(coalesce(mape, 0.5), 0.5)) * CASE WHEN stockout OR promo_spike OR unusual_drop OR high_volatility THEN 0.8 ELSE 1.0 END)) AS c FROM fl JOIN bt USING (sku) JOIN lev USING (sku)) "
    "SELECT sku, n AS n_days, " + ", ".join(f"round(level * {h}, 4) AS h{h}" for h in H) + ", round(mape, 6) AS mape, flags, round(c, 6) AS confidence, CASE WHEN c >= 0.7 THEN 'auto_proceed' WHEN c >= 0.6 THEN 'review_suggested' WHEN c >= 0.45 THEN 'review_required' ELSE 'manual_override' END AS tier, CASE WHEN mape > 0.5 OR c < 0.7 THEN 'needs_acknowledgment' ELSE 'forecasted' END AS status, CASE WHEN c >= 0.85 THEN 'low' WHEN c >= 0.7 THEN 'medium' ELSE 'high' END AS risk FROM al"
)


@query(_FLAGSHIP)
def flagship(spark, d):
    return W.flagship(V.series(_brand(spark, d)), P.defaults())


@query()
def forecast_run(spark, d):
    """The whole run per part: model by pattern, tuned, backtested, eight horizons with quantiles, confidence and labels."""
    s = V.series(_part(spark, d)).withColumns({"pattern": V.pattern_of(F.col("sku")), "alerts": F.col("sku") % 10 == 0, "b2b": F.col("sku") % 7 == 0, "promo": F.when(F.col("sku") % 3 == 0, F.transform("ds", lambda x: F.when(F.dayofmonth(x) == 1, 0.8).otherwise(1.0)))})
    f = W.run(s, P.defaults(), prepare=True)
    quant = [_r(f"forecast_{h}d.{q}", 3).alias(f"{q}_{h}d") for h in (7, 30, 365) for q in ("p50", "p90")]
    return f.select("sku", "n", "pattern", "model", "alpha", "window", _r("mape", 4).alias("mape"), F.array_join("flags", "|").alias("flags"), "quantile", *quant, _r("confidence", 4).alias("confidence"), "tier", "status", "risk")


@query("SELECT p_partkey AS sku, array_to_string(list_filter(['promo', 'weekend', 'season', 'price'], lambda f: CASE f WHEN 'promo' THEN p_size / 50.0 WHEN 'weekend' THEN (p_size % 10) / 10.0 WHEN 'season' THEN 0.3 ELSE 0.0 END >= 0.3), ',') AS features FROM part")
def feature_reliability_floor(spark, d):
    names = F.array(*[F.lit(x) for x in ("promo", "weekend", "season", "price")])
    known = F.create_map(F.lit("promo"), F.col("p_size") / 50.0, F.lit("weekend"), (F.col("p_size") % 10) / 10.0, F.lit("season"), F.lit(0.3).cast("double"))
    return V.table(spark, d, "part").select(F.col("p_partkey").alias("sku"), F.array_join(S.reliable_features(names, known, P.DEFAULTS["feature_reliability_floor"]), ",").alias("features"))


@query("SELECT DISTINCT p_brand AS style, c AS cut, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS id FROM (SELECT p_brand, c, sha256(p_brand || '|' || c) AS h FROM part, (VALUES (200), (300)) t(c))")
def window_keys(spark, d):
    b = V.table(spark, d, "part").select(F.col("p_brand").alias("style")).distinct().withColumn("cut", F.explode(F.array(F.lit(200), F.lit(300))))
    return b.select("style", "cut", S.window_key(F.col("style"), F.col("cut")).alias("id"))


@query("SELECT c_custkey, TRY_CAST(CASE WHEN c_custkey % 3 = 0 THEN 'x' || c_acctbal ELSE CAST(c_acctbal AS VARCHAR) END AS DECIMAL(12, 6))::DOUBLE AS amount FROM customer")
def safe_decimal_coercion(spark, d):
    text = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("x"), F.col("c_acctbal").cast("string"))).otherwise(F.col("c_acctbal").cast("string"))
    return V.table(spark, d, "customer").select("c_custkey", S.safe_decimal(text).cast("double").alias("amount"))


from . import records  # noqa: E402, F401  (its queries register here)
