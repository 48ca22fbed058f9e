"""Exact quantiles and least squares against numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.functions.quantiles import exact_quantiles
from churnlens.operators import ml


def test_exact_quantiles(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), float(rnd.choice([1, 2, 2.5, rnd.random() * 9]))) for _ in range(3000)]
    rows += [("lone", 4.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: (r.n, list(r.q)) for r in exact_quantiles(df, ["g"], F.col("v"), probs).collect()}
    assert set(got) == {"a", "b", None, "lone"}
    for g, (n, q) in got.items():
        own = [v for k, v in rows if k == g and v is not None]
        assert n == len(own) and np.allclose(q, np.quantile(own, probs))
    whole = exact_quantiles(df, [], F.col("v"), [0.5]).first()
    assert math.isclose(whole.q[0], np.median([v for _, v in rows if v is not None]))
    assert exact_quantiles(df.limit(0), ["g"], F.col("v"), [0.5]).count() == 0


def test_ols_with_dependent_columns(spark):
    """Two equal features: the least-norm solution, with errors and p-values."""
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(200, 2)) * [1, 50]
    y = 0.7 * x[:, 0] - 0.01 * x[:, 1] + 0.2 + rnd.normal(size=200)
    df = spark.createDataFrame([(i, i, float(a), float(b), float(a), float(v)) for i, ((a, b), v) in enumerate(zip(x, y))],
                               "SNAPSHOT long, CUSTOMER_NUMBER long, p double, q double, p2 double, purchase double")
    table, fitted = ml.ols_pvalues(df, ["p", "q", "p2"])
    got = {r.variable: r for r in table.collect()}
    design = np.column_stack([x[:, 0], x[:, 1], x[:, 0], np.ones(200)])
    scale = np.sqrt((design**2).mean(axis=0))
    coef, _, rank, _ = np.linalg.lstsq(design / scale, y, rcond=None)
    assert rank == 3
    resid = y - design / scale @ coef
    cov = np.linalg.pinv((design / scale).T @ (design / scale)) * (resid @ resid) / (200 - rank)
    for i, name in enumerate(["p", "q", "p2", "const"]):
        assert math.isclose(got[name].coef, coef[i] / scale[i], rel_tol=1e-6)
        assert math.isclose(got[name].std_err, math.sqrt(cov[i, i]) / scale[i], rel_tol=1e-6)
        assert got[name].p_value is not None
    assert got["p"].p_value < 1e-6 and got["q"].p_value < 1e-6
    assert np.allclose(sorted(r.resid for r in fitted.collect()), sorted(resid))


@pytest.mark.parametrize("t, df, p", [(0.0, 5, 1.0), (2.0, 10, 0.07338803477074037), (-2.570581835636314, 5, 0.05), (12.706204736432095, 1, 0.05), (1.959963984540054, 10**7, 0.05)])
def test_student_t(t, df, p):
    assert math.isclose(ml.student_t_two_sided(t, df), p, rel_tol=1e-5)


def test_background_mean_takes_all_rows(spark):
    from churnlens.operators import explain

    df = spark.range(12_000).selectExpr("CAST(id AS string) AS CUSTOMER_SHIPTO", "id AS POSTING_DATE", "CAST(id AS double) AS a")
    assert explain.background_means(df, ["a"]).first().a == 5999.5
    assert explain.background_sample(df, 7).count() == 7


def test_lasso_path_against_its_conditions(spark):
    """At each penalty the coefficients meet the optimality conditions of the problem."""
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(300, 6)) * [1, 2, 1, 0.5, 1, 0]
    y = 2 * x[:, 0] - x[:, 1] + 0.05 * x[:, 2] + rnd.normal(size=300) * 0.1 + 4
    z = np.column_stack([np.ones(300), x, y])
    alphas = np.array([1.5, 0.5, 0.1, 0.01])
    xc, yc = x - x.mean(axis=0), y - y.mean()
    for alpha, b in zip(alphas, ml.lasso_path(z.T @ z, alphas, tol=1e-10)):
        grad = xc.T @ (yc - xc @ b) / 300
        assert np.all(np.abs(grad) <= alpha + 1e-6)
        assert np.allclose(grad[b != 0], alpha * np.sign(b[b != 0]), atol=1e-6)
    cols = [f"c{i}" for i in range(7)]
    df = spark.createDataFrame([(i % 3, *map(float, r)) for i, r in enumerate(z[:, 1:])], "f int, " + ", ".join(f"{c} double" for c in cols))
    got = ml.fold_moments(df, cols, F.col("f"), 3)
    assert np.allclose(got.sum(axis=0), z.T @ z) and np.allclose(got[1], z[1::3].T @ z[1::3])


def test_classification_report(spark):
    rows = [(1.0, 1.0)] * 6 + [(1.0, 0.0)] * 2 + [(0.0, 0.0)] * 9 + [(0.0, 1.0)] * 3
    got = {r["class"]: r for r in ml.classification_report(spark.createDataFrame(rows, "label double, prediction double")).collect()}
    assert set(got) == {"0.0", "1.0", "accuracy", "macro avg", "weighted avg"}
    p, r = 6 / 9, 6 / 8
    assert math.isclose(got["1.0"].precision, p) and math.isclose(got["1.0"].recall, r) and math.isclose(got["1.0"].f1, 2 * p * r / (p + r))
    assert math.isclose(got["accuracy"].f1, 15 / 20)
    assert math.isclose(got["macro avg"].recall, (r + 9 / 12) / 2)
    assert math.isclose(got["weighted avg"].precision, (p * 8 + 9 / 11 * 12) / 20)
