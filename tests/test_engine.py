"""Parameters, files, sinks, the learning loop and the signal bus."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from spindrift import params as P
from spindrift.functions import scoring as S
from spindrift.operators import learning as L
from spindrift.operators import sinks as K
from spindrift.sources import files
from spindrift.streaming import signals as G


def test_params(spark):
    assert len(P.DEFAULTS) == 58
    with pytest.raises(P.UnknownParam):
        P.defaults()["nothing"]
    with pytest.raises(P.UnknownParam):
        P.defaults(nothing=1)
    full = P.defaults_table(spark).withColumn("tenant_id", F.lit("a"))
    assert P.wide(full).first()["risk_low_min"] == 0.85
    some = full.where("param_name <> 'risk_low_min'")
    assert [tuple(r) for r in P.missing(some).collect()] == [("a", "risk_low_min")]
    with pytest.raises(Exception, match="unknown parameter risk_low_min"):
        P.wide(some).collect()
    e = spark.createDataFrame([("a", "quantile_stable", 0.9)], "tenant_id string, param_name string, evidence double")
    v = P.ema_update(full, e).where("param_name = 'quantile_stable'").first()["value"]
    assert v == pytest.approx(0.8 + 0.1 * 0.1)


def test_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text("sku,order_date,quantity,pattern\na,2024-01-02,5,stable\na,03-01-2024,-2,stable\na,bad,1,stable\na,2024-01-05,x,seasonal\nb,2024-01-05,1,odd\n")
    r = files.load_csv(spark, str(tmp_path / "x.csv")).orderBy("date").collect()
    assert [(x["date"], x["qty"]) for x in r] == [(dt.date(2024, 1, 2), 5.0), (dt.date(2024, 1, 3), 0.0), (dt.date(2024, 1, 5), 0.0)]
    assert files.load_csv(spark, str(tmp_path / "x.csv"), history_days=2).count() == 1
    assert files.schema_faults(spark.range(1), StructType([StructField("id", DoubleType()), StructField("z", DoubleType())])) == ["missing column z", "id: bigint instead of double"]
    with pytest.raises(ValueError):
        (tmp_path / "y.csv").write_text("a,b\n1,2\n")
        files.load_csv(spark, str(tmp_path / "y.csv"))


@pytest.mark.parametrize("name", sorted(files.SCENARIOS))
def test_scenarios(spark, name):
    pattern, args = files.SCENARIOS[name]
    rows = files.scenario(spark, name).collect()
    assert len(rows) == args["days"] and all(r["qty"] >= 0 for r in rows) and pattern in P.PATTERNS
    assert rows == files.scenario(spark, name).collect()
    if args.get("b2b"):
        assert all(r["qty"] == 0 for r in rows if r["d"].weekday() >= 5)


def test_sinks(spark, tmp_path):
    t = K.Table(spark, str(tmp_path / "t"))
    a = spark.createDataFrame([(1, "x", 1), (2, "y", 1)], "k int, v string, at int")
    b = spark.createDataFrame([(2, "z", 2), (3, "w", 1), (3, "v", 2)], "k int, v string, at int")
    assert t.read() is None
    t.write(K.upserted(t.read(), a, ["k"], "at"))
    for _ in range(2):  # twice gives what once gives
        t.write(K.upserted(t.read(), b, ["k"], "at"))
        assert sorted(tuple(r) for r in t.read().collect()) == [(1, "x", 1), (2, "z", 2), (3, "v", 2)]
    ins = K.insert_ignored(t.read(), b, ["k"])
    assert ins.count() == 3
    c = K.counted_upsert(None, a.select("k", "v"), ["k"], "n", ["v"])
    c = K.counted_upsert(c, b.select("k", "v").dropDuplicates(["k"]), ["k"], "n", ["v"])
    assert {r["k"]: (r["v"], r["n"]) for r in c.collect() if r["k"] < 3} == {1: ("x", 1), 2: ("y", 2)}
    w = K.BatchWriter(str(tmp_path / "b"), frozenset({"ok"}))
    with pytest.raises(ValueError):
        w.add("no", a)
    w.add("ok", a.withColumn("s", F.struct("k")))
    assert w.flush() == 1 and w.flush() == 0 and spark.read.parquet(str(tmp_path / "b/ok")).first()["s"].startswith("{")
    K.replace_partition(a.withColumn("tenant_id", F.lit(1)), str(tmp_path / "p"))
    K.replace_partition(b.withColumn("tenant_id", F.lit(2)), str(tmp_path / "p"))
    K.replace_partition(a.limit(1).withColumn("tenant_id", F.lit(1)), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).groupBy("tenant_id").count().orderBy("tenant_id").collect() == [(1, 1), (2, 3)]
    K.reports({"r": a}, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv/r")).count() == 2


def test_confidence_bounds_and_flags(spark):
    p = P.defaults()
    no = F.lit(False)
    none = F.lit(None).cast("double")
    c = lambda mape, flags: S.confidence(p, F.lit("stable"), mape, flags, none, none, F.lit(1.0), no, no, F.lit(1.0))
    empty = F.array().cast("array<string>")
    r = spark.range(1).select(c(F.lit(0.1), empty), c(F.lit(float("nan")), empty), c(F.lit(0.1), F.array(F.lit("high_mape"))), c(F.lit(0.1), F.array(F.lit("stockout"))), c(F.lit(-5.0), empty)).first()
    assert r[0] == pytest.approx(0.81) and r[1] == pytest.approx(0.45) and r[2] == pytest.approx(0.81) and r[3] == pytest.approx(0.648) and r[4] == 0.95


def test_range_sums_edges(spark):
    d = lambda k: dt.date(2024, 1, k)
    spans = spark.createDataFrame([("a", d(1), 7), ("a", d(8), 7), ("b", d(1), 7)], "sku string, created date, horizon int")
    daily = spark.createDataFrame([("a", d(1), 2.0), ("a", d(7), 3.0), ("a", d(8), 5.0), ("a", d(15), 7.0), ("b", d(20), 1.0)], "sku string, d date, qty double")
    got = {(r["sku"], r["created"]): (r["actual"], r["n_days"]) for r in L.range_sums(spans, daily).collect()}
    assert got == {("a", d(1)): (5.0, 2), ("a", d(8)): (5.0, 1), ("b", d(1)): (0.0, 0)}


def test_thompson(spark):
    s = spark.createDataFrame([("a", "m", "c1", 9.0, 1.0, 0), ("a", "m", "c2", 1.0, 9.0, 0), ("a", "m", "c3", 2.0, 2.0, 0), ("a", "m", "c4", 2.0, 3.0, 0)], "sku string, model string, config_hash string, alpha double, beta double, trials int")
    assert L.thompson_best(s).first()["config_hash"] == "c1"
    for run in ("r1", "r2", "r3"):
        got = L.thompson_sample(s, run, 2).collect()
        assert len(got) == 2 and any(r["incumbent"] for r in got)
    t = spark.createDataFrame([("a", "m", "c1", 0.1, 0.2), ("a", "m", "c2", 0.5, 0.2)], "sku string, model string, config_hash string, mape double, baseline double")
    u = {r["config_hash"]: (r["alpha"], r["beta"], r["trials"]) for r in L.thompson_update(s, t).collect()}
    assert u["c1"] == (10.0, 1.0, 1) and u["c2"] == (1.0, 10.0, 1) and u["c3"] == (2.0, 2.0, 0)


def test_signals_and_states(spark):
    t = F.lit("2024-01-01 00:00:00").cast("timestamp")
    rows = spark.createDataFrame([("a", 1, "m", 0.1, 7.0, "low"), ("a", 2, "m", 0.3, -1.0, "high")], "tenant_id string, sku int, model string, mape double, confidence double, risk string").withColumn("status", F.lit("x"))
    assert [r["confidence"] for r in G.accuracy_signals(rows, t).orderBy("sku").collect()] == [1.0, 0.0]
    assert G.risk_signals(rows, t).count() == 1 and G.cross_sku_signals(rows, t).count() == 1
    with pytest.raises(ValueError):
        G.emit(rows, "nothing", t, ["model"])
    assert G.valid_transition("PLANNING", "ACTING") and not G.valid_transition("REPORTING", "FAILED")
    log = spark.createDataFrame([("r", 1, "PRELOADING"), ("r", 2, "PERCEIVING"), ("r", 3, "ACTING")], "run_id string, seq int, state string")
    assert [r["state"] for r in G.invalid_transitions(log).collect()] == ["ACTING"]
    with pytest.raises(ValueError):
        G.check_ids("a b", "r")


def test_stream_equals_batch(spark, tmp_path):
    src = "/root/testdata/sf0.001/events.parquet"
    (tmp_path / "in").mkdir()
    spark.read.parquet(src).repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
    events = G.stream(spark, str(tmp_path / "in"), files=1)
    seen = {}

    def sink(batch, _):
        for r in batch.collect():
            seen[r["start"], r["event_type"]] = (r["n"], r["total"])

    for _ in range(2):  # a restart from the checkpoint repeats nothing
        G.run_once(G.tumbling(events), sink, str(tmp_path / "cp")).awaitTermination()
    batch = G.tumbling(spark.read.parquet(src).withColumn("ts", F.col("ts").cast("timestamp"))).collect()
    assert seen == {(r["start"], r["event_type"]): (r["n"], r["total"]) for r in batch}


def test_feature_search_and_fallback(spark):
    from spindrift.plans import tuning

    table = {(): 0.5, ("a",): 0.495, ("b",): 0.3, ("b", "c"): 0.07}
    got = tuning.feature_search([], ["a", "b", "c", "d"], lambda f: table.get(tuple(f), 0.4))
    assert got == (["b", "c"], 0.07)
    full = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "sku string, level double")
    out = {r["sku"]: (r["level"], r["used_fallback"]) for r in tuning.with_fallback(full.where("sku = 'x'").withColumn("level", F.lit(9.0)), full).collect()}
    assert out == {"x": (9.0, False), "y": (2.0, True)}
