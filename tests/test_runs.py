"""Runs, their log and tables, and the break search against exhaustive search."""

import itertools
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from spindrift import params as P
from spindrift.functions import scoring as S
from spindrift.operators import arrow as A
from spindrift.operators import runs as U
from spindrift.operators import sinks as K
from spindrift.plans import forecast as W
from spindrift.plans.orchestrated import Run
from spindrift.sources import registry as G
from spindrift.streaming.signals import InvalidTransition

NOW = datetime(2030, 1, 1)


def boom():
    raise ValueError("boom")


@pytest.mark.parametrize("stage, logged, status", [("ACTING", "FAILED", U.BROKEN), ("LEARNING", "LEARNING", U.READY), (None, "COMPLETE", U.DONE)])
def test_orchestrate(spark, tmp_path, stage, logged, status):
    root = f"file://{tmp_path}"
    runs = K.Table(spark, f"{root}/runs")
    runs.write(spark.createDataFrame([("t", "r", U.READY, NOW), ("t", "other", U.READY, NOW)], G.TABLES["runs"]))
    log, ticks = U.StateLog(spark, root), itertools.count()
    handlers = {s: (lambda: None) for s in U.STAGES}
    if stage:
        handlers[stage] = boom
    go = lambda: U.orchestrate(log, runs, "t", "r", handlers, lambda: datetime(2030, 1, 1, 0, 0, next(ticks)))
    if stage:
        with pytest.raises(ValueError, match="boom"):
            go()
    else:
        assert go() == "COMPLETE"
    rows = log.read().orderBy("at").collect()
    assert rows[-1]["to_state"] == logged and (rows[-1]["reason"] == "boom") == (logged == "FAILED")
    assert {r["run_id"]: r["status"] for r in runs.read().collect()} == {"r": status, "other": U.READY}
    with pytest.raises(ValueError):
        U.orchestrate(log, runs, "bad tenant!", "r", handlers, lambda: NOW)


def test_illegal_steps_leave_no_row(spark, tmp_path):
    log = U.StateLog(spark, f"file://{tmp_path}")
    log.append("t", "r", "IDLE", "PRELOADING", NOW)
    with pytest.raises(InvalidTransition):
        log.append("t", "r", "PRELOADING", "COMPLETE", NOW)
    assert log.read().count() == 1


def test_run_without_parameters_fails(spark, tmp_path):
    root = f"file://{tmp_path}"
    demand = spark.createDataFrame([("a", [1.0] * 30, 30, "stable")], "sku string, q array<double>, n int, pattern string").withColumn("ds", F.lit(None).cast("array<date>"))
    run = Run(spark, root, "t", "r", demand, lambda: NOW)
    with pytest.raises(P.UnknownParam):
        run.go()
    assert [r["to_state"] for r in U.StateLog(spark, root).read().collect()].count("FAILED") == 1


def test_upserts_take_one_of_equal_rows(spark):
    rows = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, v string")
    want = sorted(map(tuple, K.insert_ignored(None, rows, ["k"]).collect()))
    for n in (1, 3):
        assert sorted(map(tuple, K.insert_ignored(None, rows.repartition(n), ["k"]).collect())) == want
        assert sorted(map(tuple, K.upserted(None, rows.orderBy(F.desc("v")).repartition(n), ["k"]).collect())) == want


def test_clamped_metrics(spark):
    df = spark.createDataFrame([(1.5,), (1e9,), (float("nan"),), (float("-inf"),), (None,)], "x double")
    assert [r[0] for r in df.select(S.clamp_metric(F.col("x"))).collect()] == [1.5, 99.0, None, None, None]


def test_breaks_against_exhaustive_search():
    r = np.random.default_rng(3)
    for case in range(6):
        q = np.concatenate([r.normal(10, 1, 9 + case), r.normal(10 + 6 * (case % 3), 1, 12), r.normal(4, 1, 8)])
        d = (q[:, None] - q[None, :]) ** 2
        kernel = np.exp(-d / np.median(d[d > 0]))
        cost = lambda s, e: (e - s) - kernel[s:e, s:e].sum() / (e - s)
        options = [c for k in range(4) for c in itertools.combinations(range(7, len(q) - 6), k) if all(b - a >= 7 for a, b in itertools.pairwise((0, *c, len(q))))]
        total = lambda c: sum(cost(a, b) for a, b in itertools.pairwise((0, *c, len(q)))) + 10 * len(c)
        found = A.breaks(q, 0.3)
        assert total(found) == pytest.approx(min(map(total, options)))
        strong = A.breaks(q, 3.0)  # penalty 1
        assert sum(cost(a, b) for a, b in itertools.pairwise((0, *strong, len(q)))) + len(strong) == pytest.approx(min(total(c) - 9 * len(c) for c in options))


def test_breaks_lower_confidence(spark):
    q = [10.0 + (k % 3) for k in range(100)] + [60.0 + (k % 3) for k in range(120)]
    s = spark.createDataFrame([(k, q, len(q), "stable") for k in (1, 2)], "sku int, q array<double>, n int, pattern string").withColumn("ds", F.lit(None).cast("array<date>"))
    c = {r["sku"]: r["confidence"] for r in W.run(s.withColumn("alerts", F.col("sku") == 1), P.defaults(), seasonal=False).collect()}
    assert c[1] == pytest.approx(max(0.3, c[2] * 0.85), rel=1e-6)


def test_seasonal_items_are_tuned_and_backtested_by_their_own_model(spark):
    t = np.arange(140)
    q = (50 + 20 * np.cos(2 * np.pi * t / 7)).tolist()
    s = spark.createDataFrame([("a", q, 140, "seasonal")], "sku string, q array<double>, n int, pattern string").withColumn("ds", F.lit(None).cast("array<date>"))
    own, flat = (W.run(s, P.defaults(), seasonal=k).first() for k in (True, False))
    assert own["model"] == "prophet" and own["mape"] < 0.05 < flat["mape"] and own["val_mape"] < 0.05 and own["alpha"] is None
    assert own["forecast_7d"]["mean"] == pytest.approx(350, rel=0.05)


def test_seasonal_weights_and_multiplicative_form():
    t = np.arange(140)
    level = 50 + 10 * np.cos(2 * np.pi * t / 7)
    spiked, weights = level.copy(), np.ones(140)
    spiked[::9], weights[::9] = 400, 0.0
    assert np.abs(A.seasonal_fit(spiked, 14, weights=weights) - level[:14]).max() < 3 < np.abs(A.seasonal_fit(spiked, 14) - level[:14]).max()
    growing = np.expm1(np.log1p(20) + 0.01 * t + 0.5 * np.cos(2 * np.pi * t / 7))
    ahead = np.expm1(np.log1p(20) + 0.01 * (t[:7] + 140) + 0.5 * np.cos(2 * np.pi * (t[:7] + 140) / 7))
    error = lambda m: A.seasonal_error(ahead, A.seasonal_fit(growing, 7, multiplicative=m))
    assert error(True) < 0.1 < error(False)


def test_preparation_filters_caps_and_shapes(spark):
    start = date(2024, 1, 1)  # a Monday
    ds = [start + timedelta(days=k) for k in range(84)]
    q = [float(10 + 5 * (k % 7 == 0)) for k in range(84)]
    q[30] = 500.0
    promo = [0.5 if k == 30 else 1.0 for k in range(84)]
    weekend, flat = [d for d in ds if d.weekday() >= 5], [1.0] * 7
    cases = [("a", ds, q, "stable", True, promo), ("b", ds, q, "seasonal", False, promo), ("c", weekend, [3.0] * len(weekend), "stable", True, None), ("d", ds, q, "stable", False, None), ("e", [], [], "stable", True, None)]
    s = spark.createDataFrame(cases, "sku string, ds array<date>, q array<double>, pattern string, b2b boolean, promo array<double>").withColumns({"n": F.size("q"), "weights": F.lit(None).cast("array<double>")})
    s = s.withColumn("model", F.when(F.col("pattern") == "seasonal", "prophet").otherwise("simple_exponential_smoothing"))
    got = {r["sku"]: r for r in W.prepared(s, 3.0).collect()}

    kept = [(d, x) for d, x in zip(ds, q) if d.weekday() < 5]
    want = [x for _, x in kept]
    k = [d for d, _ in kept].index(ds[30])
    mean = sum(want) / len(want)
    days = [np.mean([x for d, x in kept if d.weekday() == w]) / mean for w in range(5)] + [0.0, 0.0]
    assert got["a"]["dow"] == pytest.approx(days)
    want[k] = min(500.0, 3 * float(np.mean(want[k - 13 : k + 1])))
    assert want[k] < 500 and got["a"]["q"] == pytest.approx(want) and got["a"]["ds"] == [d for d, _ in kept] and got["a"]["n"] == 84
    assert got["b"]["q"] == q and got["b"]["weights"] == promo and got["b"]["dow"] == flat
    assert got["c"]["q"] == [3.0] * len(weekend) and not got["c"]["b2b"] and got["c"]["dow"] == flat
    assert got["d"]["q"] == q and got["d"]["dow"][5] < 1 < got["d"]["dow"][2] and got["e"]["q"] == [] and got["e"]["dow"] == flat

    plain, shaped = ({r["sku"]: r for r in W.run(s.where("n > 0").drop("model", "weights"), P.defaults(), seasonal=False, prepare=x).collect()} for x in (False, True))
    level = plain["d"]["forecast_7d"]["mean"] / 7
    ahead = [(ds[-1] + timedelta(days=i + 1)).weekday() for i in range(30)]
    assert shaped["d"]["forecast_30d"]["mean"] == pytest.approx(level * sum(got["d"]["dow"][w] for w in ahead), rel=1e-3)
    assert shaped["c"]["forecast_30d"]["mean"] == pytest.approx(plain["c"]["forecast_30d"]["mean"])
