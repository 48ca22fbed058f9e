"""Formula tests with hand-computed values."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.functions import holidays, series


def test_gaussian_taps_sum_to_one_and_match():
    taps = series.gaussian_edge_taps(1.5)
    assert len(taps) == 7
    assert math.isclose(sum(taps), 1.0, rel_tol=1e-12)
    expected = [0.478932, 0.322309, 0.145336, 0.043592, 0.008626, 0.001117, 0.000089]
    assert [round(t, 6) for t in taps] == expected


def test_kalman_three_points(spark):
    df = spark.createDataFrame([([1.0, 3.0, 2.0],)], "y array<double>")
    got = df.select(series.kalman_smooth(F.col("y")).alias("k")).first()["k"]
    assert [round(v, 6) for v in got] == [1.741978, 1.756818, 1.759226]


def test_kalman_edge_lengths(spark):
    df = spark.createDataFrame([([],), ([5.0],), ([2.0, 2.0],)], "y array<double>")
    got = [r["k"] for r in df.select(series.kalman_smooth(F.col("y")).alias("k")).collect()]
    assert got[0] == []
    assert got[1] == [5.0]
    assert [round(v, 9) for v in got[2]] == [2.0, 2.0]


def _np_kalman(y, q=0.01, r=1.0):
    n = len(y)
    pm, m, p = np.zeros(n), np.zeros(n), np.zeros(n)
    for t in range(n):
        pm[t] = 1.0 if t == 0 else p[t - 1] + q
        prev = y[0] if t == 0 else m[t - 1]
        k = pm[t] / (pm[t] + r)
        m[t] = prev + k * (y[t] - prev)
        p[t] = (1 - k) * pm[t]
    s = m.copy()
    for t in range(n - 2, -1, -1):
        s[t] = m[t] + p[t] / pm[t + 1] * (s[t + 1] - m[t])
    return s


def test_kalman_matches_numpy_smoother(spark):
    rng = np.random.default_rng(3)
    ys = [rng.normal(10, 5, size=n).tolist() for n in (4, 12, 24, 40)]
    df = spark.createDataFrame([(y,) for y in ys], "y array<double>")
    got = [r["k"] for r in df.select(series.kalman_smooth(F.col("y")).alias("k")).collect()]
    for y, k in zip(ys, got):
        assert np.allclose(k, _np_kalman(np.array(y)), atol=1e-9)


@pytest.mark.parametrize("nu,t", [(3, 3.182), (7, 2.365)])
def test_t_pvalue_closed_form(spark, nu, t):
    df = spark.range(1).select(series._t_sf_two_sided(F.lit(t), nu).alias("p"))
    assert abs(df.first()["p"] - 0.05) < 5e-4


def test_linregress_matches_numpy(spark):
    rng = np.random.default_rng(7)
    rows = [rng.normal(0, 3, size=5).tolist() for _ in range(20)]
    df = spark.createDataFrame(rows, [f"y{i}" for i in range(5)])
    fit = series.linregress([F.col(f"y{i}") for i in range(5)])
    got = df.select(fit["slope"].alias("s"), fit["intercept"].alias("i")).collect()
    for y, g in zip(rows, got):
        s, i = np.polyfit(np.arange(5), y, 1)
        assert math.isclose(g["s"], s, abs_tol=1e-9) and math.isclose(g["i"], i, abs_tol=1e-9)


def test_flat_series_pvalue_is_one(spark):
    df = spark.range(1).select(*[F.lit(2.0).alias(f"y{i}") for i in range(5)])
    fit = series.linregress([F.col(f"y{i}") for i in range(5)])
    r = df.select(fit["slope"].alias("s"), fit["p_value"].alias("p")).first()
    assert r["s"] == 0.0 and r["p"] == 1.0


def test_easter_dates(spark):
    df = spark.createDataFrame([(1995,), (2000,), (2001,), (2011,), (2024,)], "year int")
    got = [r["e"] for r in df.select(holidays.easter_sunday(F.col("year")).alias("e")).collect()]
    assert got == [dt.date(1995, 4, 16), dt.date(2000, 4, 23), dt.date(2001, 4, 15), dt.date(2011, 4, 24), dt.date(2024, 3, 31)]


def test_holiday_counts_per_month(spark):
    years = spark.createDataFrame([(2001,)], "year int")
    counts = {r["POSTING_DATE"].month: r["Holidays"] for r in holidays.holidays_per_month(holidays.holiday_calendar(years)).collect()}
    # 2001: Good Friday 13 Apr, Easter Monday 16 Apr, Anzac Day 25 Apr
    assert counts == {1: 2, 4: 3, 12: 2}


def test_kalman_engines_agree(spark):
    rng = np.random.default_rng(5)
    ys = [rng.normal(10, 5, size=n).round(2).tolist() for n in (1, 2, 7, 24, 24, 31)]
    got = series.np_kalman_smooth(ys)
    df = spark.createDataFrame([(y,) for y in ys], "y array<double>")
    native = [r["k"] for r in df.select(series.kalman_smooth(F.col("y")).alias("k")).collect()]
    for a, b, y in zip(got, native, ys):
        assert np.allclose(a, b, atol=1e-12)
        assert np.allclose(a, _np_kalman(np.array(y)), atol=1e-9)
