"""Time-series formulas as native Spark column expressions (no Python UDF).

Closed-form arithmetic and window aggregates compile into whole-stage
codegen. The Kalman scans use higher-order array functions, which Spark
evaluates per row without codegen; their arrays are one customer's months.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --------------------------------------------------------------------------
# Gaussian smoothing tap
# --------------------------------------------------------------------------


def gaussian_weights(sigma: float = 1.5, truncate: float = 4.0) -> list[float]:
    """Normalised Gaussian kernel w_k for k = -r..r, r = int(truncate*sigma + 0.5)."""
    radius = int(truncate * sigma + 0.5)
    raw = [math.exp(-0.5 * k * k / (sigma * sigma)) for k in range(-radius, radius + 1)]
    s = sum(raw)
    return [x / s for x in raw]


def gaussian_edge_taps(sigma: float = 1.5, truncate: float = 4.0) -> list[float]:
    """Coefficients of x_0..x_r for the first output element of a Gaussian
    filter with mirror ('reflect') padding: x_{-j} = x_{j-1}."""
    w = gaussian_weights(sigma, truncate)
    r = len(w) // 2
    half = w[r:]  # w_0..w_r
    return [half[j] + (half[j + 1] if j + 1 <= r else 0.0) for j in range(r + 1)]


def gaussian_period(lags: Sequence[Column], sigma: float = 1.5) -> Column:
    """Weighted sum of the oldest r+1 values of a window (``lags[j]`` is the
    j-th oldest element); the polars callback keeps element 0 of the
    smoothed window (see SURVEY §2.14, tap='oldest')."""
    taps = gaussian_edge_taps(sigma)
    expr = None
    for coef, x in zip(taps, lags):
        term = x * F.lit(coef)
        expr = term if expr is None else expr + term
    return expr


# --------------------------------------------------------------------------
# Local-level Kalman smoother
# --------------------------------------------------------------------------


def kalman_smooth(y: Column, q: float = 0.01, r: float = 1.0, p0: float = 1.0) -> Column:
    """RTS smoother of a local-level model over an ARRAY<DOUBLE> column.

    A = C = 1, observation noise ``r``, transition noise ``q``, initial mean
    y[0], initial covariance ``p0``. The covariance recursion does not depend
    on the data, so it is one ``aggregate`` over the index; the forward means
    and the backward pass are two more ``aggregate`` scans. Returns
    ARRAY<DOUBLE> of smoothed means, same length as ``y``.
    """
    y = F.coalesce(y, F.array().cast("array<double>"))
    n = F.size(y)
    # predicted covariances P-_t, t = 0..n-1
    pminus = F.aggregate(
        F.sequence(F.lit(2), F.greatest(n, F.lit(2))),
        F.array(F.lit(p0).cast("double")),
        lambda acc, _: F.concat(
            acc,
            F.array(
                (F.lit(1.0) - F.element_at(acc, -1) / (F.element_at(acc, -1) + F.lit(r)))
                * F.element_at(acc, -1)
                + F.lit(q)
            ),
        ),
    )
    pminus = F.slice(pminus, 1, n)
    gain = F.transform(pminus, lambda pm: pm / (pm + F.lit(r)))
    post = F.transform(pminus, lambda pm: (F.lit(1.0) - pm / (pm + F.lit(r))) * pm)
    # forward filtered means
    fwd = F.aggregate(
        F.arrays_zip(y.alias("y"), gain.alias("k")),
        F.struct(F.element_at(y, 1).alias("last"), F.array().cast("array<double>").alias("out")),
        lambda acc, e: F.struct(
            (acc["last"] + e["k"] * (e["y"] - acc["last"])).alias("last"),
            F.concat(acc["out"], F.array(acc["last"] + e["k"] * (e["y"] - acc["last"]))).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    # smoother gains L_t = P_t / P-_{t+1}, t = 0..n-2
    lgain = F.zip_with(F.slice(post, 1, F.greatest(n - 1, F.lit(1))), F.slice(pminus, 2, F.greatest(n, F.lit(1))), lambda a, b: a / b)
    back = F.aggregate(
        F.arrays_zip(F.reverse(F.slice(fwd, 1, F.greatest(n - 1, F.lit(1)))).alias("m"), F.reverse(lgain).alias("l")),
        F.struct(F.element_at(fwd, -1).alias("last"), F.array(F.element_at(fwd, -1)).alias("out")),
        lambda acc, e: F.struct(
            (e["m"] + e["l"] * (acc["last"] - e["m"])).alias("last"),
            F.concat(acc["out"], F.array(e["m"] + e["l"] * (acc["last"] - e["m"]))).alias("out"),
        ),
        lambda acc: F.reverse(acc["out"]),
    )
    return F.when(n == 0, F.array().cast("array<double>")).when(n == 1, fwd).otherwise(back)


def np_kalman_smooth(ys, q: float = 0.01, r: float = 1.0, p0: float = 1.0) -> list[list[float]]:
    """The same smoother with numpy, vectorised over all series of equal
    length in ``ys`` (one recursion step per month for the whole batch).
    Operation order matches ``kalman_smooth`` element by element."""
    import numpy as np

    out: list = [None] * len(ys)
    by_len: dict[int, list[int]] = {}
    for i, y in enumerate(ys):
        by_len.setdefault(len(y), []).append(i)
    for n, idx in by_len.items():
        if n == 0:
            for i in idx:
                out[i] = []
            continue
        y = np.array([np.asarray(ys[i], dtype=float) for i in idx])
        pm = np.empty(n)
        pm[0] = p0
        for t in range(1, n):
            pm[t] = (1.0 - pm[t - 1] / (pm[t - 1] + r)) * pm[t - 1] + q
        k = pm / (pm + r)
        post = (1.0 - pm / (pm + r)) * pm
        m = np.empty_like(y)
        last = y[:, 0]
        for t in range(n):
            last = last + k[t] * (y[:, t] - last)
            m[:, t] = last
        sm = np.empty_like(m)
        sm[:, n - 1] = m[:, n - 1]
        for t in range(n - 2, -1, -1):
            lg = post[t] / pm[t + 1]
            sm[:, t] = m[:, t] + lg * (sm[:, t + 1] - m[:, t])
        for j, i in enumerate(idx):
            out[i] = sm[j].tolist()
    return out


# --------------------------------------------------------------------------
# OLS over equally spaced points
# --------------------------------------------------------------------------


def _t_sf_two_sided(t: Column, nu: int) -> Column:
    """Two-sided p-value of Student's t for odd ``nu`` in closed form."""
    if nu % 2 == 0:
        raise ValueError("closed form implemented for odd degrees of freedom")
    theta = F.atan(F.abs(t) / F.lit(math.sqrt(nu)))
    c = F.cos(theta)
    # sum_{k=0}^{(nu-3)/2} a_k cos^{2k+1}, a_0 = 1, a_k = a_{k-1} * 2k/(2k+1)
    series = None
    coef = 1.0
    for k in range((nu - 1) // 2):
        if k > 0:
            coef *= (2 * k) / (2 * k + 1)
        term = F.lit(coef) * F.pow(c, 2 * k + 1)
        series = term if series is None else series + term
    inner = theta if series is None else theta + F.sin(theta) * series
    return F.lit(1.0) - F.lit(2.0 / math.pi) * inner


def linregress(points: Sequence[Column]) -> dict[str, Column]:
    """Slope, intercept and two-sided p-value of y on x = 0..n-1.

    Mirrors ``scipy.stats.linregress``: r = Sxy/sqrt(Sxx*Syy) (0 when
    Syy = 0), t = r*sqrt(nu/((1-r)(1+r))), p from Student's t with nu = n-2.
    |r| = 1 gives p = 0.
    """
    n = len(points)
    xbar = (n - 1) / 2.0
    sxx = n * (n * n - 1) / 12.0
    ybar = sum(points[1:], points[0]) / F.lit(float(n))
    sxy = None
    for i, p in enumerate(points):
        term = p * F.lit(i - xbar)
        sxy = term if sxy is None else sxy + term
    syy = None
    for p in points:
        term = (p - ybar) * (p - ybar)
        syy = term if syy is None else syy + term
    slope = sxy / F.lit(sxx)
    intercept = ybar - slope * F.lit(xbar)
    r = F.when(syy == 0, F.lit(0.0)).otherwise(sxy / F.sqrt(F.lit(sxx) * syy))
    r = F.least(F.greatest(r, F.lit(-1.0)), F.lit(1.0))
    nu = n - 2
    t = r * F.sqrt(F.try_divide(F.lit(float(nu)), (F.lit(1.0) - r) * (F.lit(1.0) + r)))
    p = F.when(F.abs(r) >= 1.0, F.lit(0.0)).otherwise(_t_sf_two_sided(t, nu))
    return {"slope": slope, "intercept": intercept, "p_value": p, "r": r}
