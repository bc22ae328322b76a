"""Model folds against plain recurrences, edge cases and invariants."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spindrift import params as P
from spindrift.functions import models as M
from spindrift.operators import arrow as A
from spindrift.operators import series as R
from spindrift.plans import forecast as W

CASES = [[], [5.0], [3.0, 4.0], [0.0] * 10, [7.0] * 20, [0, 0, 4, 0, 0, 0, 2, 0, 1.0], [1.0, 2, 3, 4, 5, 6, 7, 8], [0.0, 0, 9], [10.0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 12]]


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in q]) for i, q in enumerate(rows)], "sku int, q array<double>").coalesce(1)


def ses(q, a=0.3):
    s = q[0] if q else 0.0
    for y in q[1:]:
        s = a * y + (1 - a) * s
    return s


def holt(q, a=0.3, b=0.1, p=0.95):
    if len(q) < 2:
        return (float(np.mean(q)) if q else 0.0, 0.0)
    lv, t = q[0], q[1] - q[0]
    for y in q[2:]:
        new = a * y + (1 - a) * (lv + p * t)
        lv, t = new, b * (new - lv) + (1 - b) * p * t
    return lv, t


def croston(q, a=0.1, variant="SBA"):
    nz = [i for i, x in enumerate(q) if x > 0]
    if len(nz) < 2:
        return ses(q)
    if variant == "TSB":
        z, p = q[nz[0]], 1 / (nz[0] + 1)
        for x in q[nz[0] + 1 :]:
            p = a * (x > 0) + (1 - a) * p
            z = a * x + (1 - a) * z if x > 0 else z
        return z * p
    z, w = q[nz[0]], 1.0
    for i, j in zip(nz, nz[1:]):
        z, w = a * q[j] + (1 - a) * z, a * (j - i) + (1 - a) * w
    return z / max(w, 1e-6) * (1 - a / 2 if variant == "SBA" else 1)


def test_folds_match_recurrences(spark):
    q = F.col("q")
    out = frame(spark, CASES).select("sku", M.ses_level(q).alias("ses"), M.holt_state(q).alias("h"), M.holt_total(M.holt_state(q), 30).alias("h30"), *[M.croston_rate(q, 0.1, v).alias(v) for v in ("SBA", "classic", "TSB")], M.naive_level(q).alias("naive")).collect()
    for r in out:
        c = [float(x) for x in CASES[r["sku"]]]
        assert r["ses"] == pytest.approx(ses(c), abs=1e-9)
        lv, t = holt(c)
        assert (r["h"]["l"], r["h"]["t"]) == pytest.approx((lv, t), abs=1e-9)
        reach = np.cumsum(0.95 ** np.arange(1, 31))
        assert r["h30"] == pytest.approx(np.maximum(0, lv + t * reach).sum(), abs=1e-6)
        for v in ("SBA", "classic", "TSB"):
            assert r[v] == pytest.approx(croston(c, 0.1, v), abs=1e-9)
        assert r["naive"] == pytest.approx(0.0 if not c else np.mean(c) if len(c) < 7 else np.mean(c[-7:]), abs=1e-9)


def test_clean_drops_what_is_not_a_number(spark):
    df = spark.createDataFrame([([1.0, math.nan, math.inf, -math.inf, None, 2.0],)], "q array<double>")
    assert df.select(M.clean(F.col("q"))).first()[0] == [1.0, 0.0, 0.0, 0.0, 0.0, 2.0]


def test_bootstrap_equals_seeded_sample(spark):
    rng = np.random.default_rng(5)
    rows = [(float(p), rng.normal(0, 5, n).tolist()) for p, n in ((50, 3), (2, 10), (100, 30), (0, 12))]
    df = spark.createDataFrame(rows, "p double, r array<double>")
    for (p, r), got in zip(rows, df.select(M.bootstrap_quantiles(F.col("p"), F.col("r"), F.lit("stable"))).collect()):
        s = np.maximum(0, np.random.default_rng(42).choice(np.array(r), 1000) + p)
        want = [0, 0, 0] if p == 0 else [np.percentile(s, k) for k in (50, 80, 90)]
        assert list(got[0])[1:] == pytest.approx(want, abs=1e-9)


def test_lognormal_quantiles(spark):
    df = spark.createDataFrame([(100.0, "cold_start"), (100.0, "nobody")], "p double, k string")
    got = df.select(M.bootstrap_quantiles(F.col("p"), F.array().cast("array<double>"), F.col("k"))).collect()
    for (_, k), g in zip([(0, "cold_start"), (0, "")], got):
        s = np.random.default_rng(42).lognormal(math.log(100), math.log(1 + M.SPREAD.get(k, 0.5)), 1000)
        assert list(g[0])[1:] == pytest.approx([np.percentile(s, x) for x in (50, 80, 90)], rel=1e-9)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(0, 50), min_size=3, max_size=40), min_size=1, max_size=5))
def test_invariants(spark, rows):
    q = F.col("q")
    s = frame(spark, rows).withColumn("h", M.holt_state(q, phi=1.0))
    out = s.select(M.ses_level(q).alias("l"), M.holt_total(F.col("h"), 30, 1.0).alias("u"), M.bootstrap_quantiles(M.ses_level(q), M.residuals(q), F.lit("stable")).alias("b"), F.array_min("q").alias("lo"), F.array_max("q").alias("hi"), R.level_scale(q).alias("k")).collect()
    for r in out:
        assert r["lo"] - 1e-9 <= r["l"] <= r["hi"] + 1e-9 and r["u"] >= 0 and 0.5 <= r["k"] <= 2.0
        assert r["b"]["p50"] <= r["b"]["p80"] + 1e-9 and r["b"]["p80"] <= r["b"]["p90"] + 1e-9


def test_flags(spark):
    rows = [[0, 0, 0, 5], [1] * 10 + [9], [10] * 10 + [1, 1, 1, 1], [0, 0, 20, 0, 0, 0, 0, 20.0], [5] * 12]
    got = [r["flags"] for r in R.with_flags(frame(spark, rows)).orderBy("sku").collect()]
    assert "stockout" in got[0] and "promo_spike" in got[1] and "unusual_drop" in got[2] and "high_volatility" in got[3] and got[4] == []


def test_structural_break_and_seasonal():
    q = np.r_[np.full(60, 10.0), np.full(60, 40.0)] + np.tile([0, 1, 0, -1], 30)
    assert abs(A.breaks(q, 3.0)[0] - 60) <= 2
    assert A.breaks(np.full(40, 3.0)) == [] and A.breaks(np.ones(3)) == []
    t = np.arange(140)
    f = A.seasonal_fit(50 + 10 * np.cos(2 * np.pi * t / 7), 14)
    assert np.abs(f - (50 + 10 * np.cos(2 * np.pi * np.arange(140, 154) / 7))).max() < 2
    assert A.seasonal_fit(np.zeros(0)).sum() == 0 and (A.seasonal_fit(np.full(20, 4.0)) == 4.0).all()


def test_structural_break_of_the_first_year(spark):
    q = [10.0 + k % 2 for k in range(150)] + [40.0 + k % 2 for k in range(580)]
    r = A.structural_break(spark.createDataFrame([(1, q)], "sku int, q array<double>")).first()
    assert r["n"] == 730 and abs(r["break_at"] - 150) <= 2 and r["rows_after"] == 730 - r["break_at"] and r["state"] == "truncated"


def test_holt_is_tuned_as_holt(spark):
    s = spark.createDataFrame([(1, [float(10 + 3 * k) for k in range(100)], 100)], "sku int, q array<double>, n int").withColumn("pattern", F.lit("trending"))
    r = W.run(s, P.defaults(), seasonal=False).first()
    assert r["model"] == "holts_linear_trend" and r["val_mape"] < 1e-6 and r["mape"] < 1e-6
    assert abs(r["forecast_7d"]["mean"] - sum(10 + 3 * k for k in range(100, 107))) < 1e-3


def test_folds_and_split(spark):
    s = frame(spark, [list(range(30))])
    f = R.folds(s, 10, 5).orderBy("cut").collect()
    assert [r["cut"] for r in f] == [10, 15, 20] and all(len(r["train"]) == r["cut"] and len(r["train"]) + len(r["ahead"]) == 30 for r in f)
    r = R.split(s, 14).first()
    assert len(r["train"]) == 16 and r["test"] == [float(x) for x in range(16, 30)]
