"""Seasonal comparison, ladders, present value."""

import math

import numpy as np
from pyspark.sql import functions as F

from churnlens.functions import ladders as L
from churnlens.operators import boards, seasonal


def _series_df(spark, series):
    rows = []
    for c, xs in series.items():
        for i, x in enumerate(xs):
            rows.append((c, f"{2000 + i // 12}-{i % 12 + 1:02d}-01", float(x)))
    return spark.createDataFrame(rows, "CUSTOMER_SHIPTO string, d string, predicted double").select(
        "CUSTOMER_SHIPTO", F.to_date("d").alias("POSTING_DATE"), "predicted"
    )


def test_pure_period_three(spark):
    xs = [1.0, 5.0, 2.0] * 8
    out = seasonal.seasonal_compare(_series_df(spark, {"a": xs})).first()
    assert out["period_after"] == 3 and out["period_before"] == 3
    s = out["seasonal_after"]
    assert abs(sum(s[:3])) < 1e-9
    assert np.allclose(s, [s[0], s[1], s[2]] * 4)


def test_arrow_and_native_engines_agree(spark):
    rng = np.random.default_rng(11)
    data = {f"c{i}": (rng.normal(20, 6, size=n)).round(2).tolist() for i, n in enumerate([10, 18, 20, 24, 30, 36])}
    data["flat"] = [4.0] * 24
    df = _series_df(spark, data)
    a = {r["CUSTOMER_SHIPTO"]: r for r in seasonal.seasonal_compare(df, engine="arrow").collect()}
    b = {r["CUSTOMER_SHIPTO"]: r for r in seasonal.seasonal_compare(df, engine="native").collect()}
    assert a.keys() == b.keys()
    for k in a:
        for f in ("diff_phase", "period_after", "period_before", "seasonal_shift"):
            assert a[k][f] == b[k][f], (k, f)
        for f in ("amplitude", "mean_before", "mean_after"):
            if a[k][f] is None:
                assert b[k][f] is None
            else:
                assert math.isclose(a[k][f], b[k][f], abs_tol=1e-9)
    assert a["c0"]["period_after"] is None  # fewer than 18 points
    assert a["flat"]["period_after"] == 1


def test_magnitude_ladder_steps():
    steps = L.MAGNITUDE_STEPS
    assert steps[0] == (0.5, -10.0) and steps[9] == (0.05, -1.0) and steps[10] == (0.0, 0.0)
    assert steps[11] == (-0.05, 0.5) and steps[-1] == (-0.5, 5.0)


def test_risk_score_ladders(spark):
    from churnlens.operators import score

    rows = [("a", 100.0, 90.0, -0.30, -0.6, -2.0, 200.0, 5.0), ("b", 10.0, 10.0, 0.30, 0.6, 2.0, 5.0, None)]
    df = spark.createDataFrame(rows, "CUSTOMER_SHIPTO string, CCH double, CCH_lag_1 double, percent_decline double,"
                               " magnitute_drop double, miss_period double, max_cch double, cross_zero double")
    got = {r["CUSTOMER_SHIPTO"]: r for r in score.risk_score(df, __import__("datetime").date(2001, 7, 1)).collect()}
    # a: size 8 * (12 + 1.6*5 + 3) / 2.15 = 85.58 -> (85.58+100)/2 = 92.79 -> 93
    assert got["a"]["risk_score"] == 93.0
    assert got["a"]["risk_value"].startswith("200107: Current CCH:100, Last mth CCH:90, 6 mth CCH likely decrease within 30%.")
    assert "Churn likely in 5 mth." in got["a"]["risk_value"] and "Missed pred purch of 3 mth." in got["a"]["risk_value"]
    # b: size 3 * (-12 - 16 - 3) / 2.15 = -43.26 -> 28.37 -> 28
    assert got["b"]["risk_score"] == 28.0


def test_present_value_example(spark):
    df = spark.range(1).select(boards.customer_pv(F.lit(10.0), F.lit(-1000.0), 0.05).alias("pv"))
    assert abs(df.first()["pv"] - 3.461538) < 1e-6
