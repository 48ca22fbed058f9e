"""Seasonal comparison of a customer's series.

Per customer, the month-sorted series is one array (its length is the
number of months, bounded by the calendar). Autocorrelation, classical
additive decomposition and cross-correlation are written with native
higher-order array functions, one step per column so each expression
tree stays small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CUST = "CUSTOMER_SHIPTO"
MONTH = "POSTING_DATE"


def _at(arr: Column, i: Column) -> Column:
    """0-based element access."""
    return F.element_at(arr, i + 1)


def _mean(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, x: a + x) / F.size(arr)


def acf(win: Column, nlags: int = 6) -> Column:
    """Biased autocorrelation of lags 1..nlags (null when the window is flat)."""
    n = F.size(win)
    m = _mean(win)
    c0 = F.aggregate(win, F.lit(0.0), lambda a, x: a + (x - m) * (x - m))
    return F.transform(
        F.sequence(F.lit(1), F.lit(nlags)),
        lambda k: F.try_divide(
            F.aggregate(
                F.sequence(F.lit(0), n - k - 1),
                F.lit(0.0),
                lambda a, t: a + (_at(win, t) - m) * (_at(win, t + k) - m),
            ),
            c0,
        ),
    )


def best_period(acfs: Column) -> Column:
    """1 + argmax over lags 1..n (first maximum); flat window -> 1."""
    return F.coalesce(F.array_position(acfs, F.array_max(acfs)).cast("int"), F.lit(1))


def seasonal_component(win: Column, p: Column) -> Column:
    """Additive seasonal component of ``win`` with period ``p``.

    Centred moving average trend (odd p: p taps; even p: p+1 taps with half
    weight at both ends), detrended values averaged per phase (nulls at the
    ends skipped), centred, then tiled over the window.
    """
    n = F.size(win)
    half = F.floor(p / 2).cast("int")
    even = F.pmod(p, F.lit(2)) == 0
    trend = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda t: F.when(
            (t >= half) & (t <= n - 1 - half),
            F.aggregate(
                F.sequence(-half, half),
                F.lit(0.0),
                lambda a, j: a + _at(win, t + j) * F.when(even & (F.abs(j) == half), F.lit(0.5)).otherwise(F.lit(1.0)),
            )
            / p,
        ),
    )
    detr = F.zip_with(win, trend, lambda x, tr: x - tr)
    phase_avg = F.transform(
        F.sequence(F.lit(0), p - 1),
        lambda i: F.aggregate(
            F.filter(
                F.transform(F.sequence(F.lit(0), n - 1), lambda t: F.when(F.pmod(t, p) == i, _at(detr, t))),
                lambda v: v.isNotNull(),
            ),
            F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("c")),
            lambda a, v: F.struct((a["s"] + v).alias("s"), (a["c"] + 1).alias("c")),
            lambda a: a["s"] / a["c"],
        ),
    )
    centred = F.transform(phase_avg, lambda v: v - _mean(phase_avg))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda t: _at(centred, F.pmod(t, p)))


def cross_corr_argmax(a: Column, v: Column, mode: str = "full") -> Column:
    """Index of the first maximum of the cross-correlation of two equal-length
    arrays: ``full`` has 2n-1 lags (index n-1 = no shift); ``valid`` has one."""
    if mode == "valid":
        return F.lit(0)
    n = F.size(a)
    corr = F.transform(
        F.sequence(F.lit(0), 2 * n - 2),
        lambda k: F.aggregate(
            F.sequence(F.greatest(F.lit(0), n - 1 - k), F.least(n - 1, 2 * n - 2 - k)),
            F.lit(0.0),
            lambda acc, i: acc + _at(a, i + k - (n - 1)) * _at(v, i),
        ),
    )
    return (F.array_position(corr, F.array_max(corr)) - 1).cast("int")


def series_arrays(df: DataFrame, value: str, trim_leading_zeros: bool = False) -> DataFrame:
    """M1-style packing: (customer, x) with x the month-sorted non-null values."""
    packed = df.filter(F.col(value).isNotNull()).groupBy(CUST).agg(
        F.array_sort(F.collect_list(F.struct(F.col(MONTH), F.col(value).cast("double").alias("v")))).alias("s")
    )
    x = F.transform("s", lambda e: e["v"])
    if trim_leading_zeros:
        # Drop values before the first non-zero one
        first = F.array_position(F.transform(x, lambda v: v != 0), F.lit(True))
        x = F.when(first > 0, F.slice(x, first, F.size(x))).otherwise(F.array().cast("array<double>"))
    return packed.select(CUST, x.alias("x"))


def seasonal_compare(
    df: DataFrame,
    value: str = "predicted",
    shift_mode: str = "full",
    trim_leading_zeros: bool = False,
    min_points: int = 18,
    engine: str = "arrow",
) -> DataFrame:
    """Seasonal comparison per customer; ``engine='arrow'`` (default, batched
    numpy in a pandas UDF) or ``'native'`` (higher-order functions)."""
    fn = seasonal_compare_arrow if engine == "arrow" else seasonal_compare_native
    return fn(df, value, shift_mode, trim_leading_zeros, min_points)


def seasonal_compare_native(
    df: DataFrame,
    value: str = "predicted",
    shift_mode: str = "full",
    trim_leading_zeros: bool = False,
    min_points: int = 18,
) -> DataFrame:
    """X6 (X7 with ``trim_leading_zeros=True``): per customer
    diff_phase, amplitude, period_after, period_before, seasonal_after,
    seasonal_before, seasonal_shift, mean_before, mean_after.

    Windows: last 12 points ("after") and points -18..-7 ("before"). With
    fewer than ``min_points`` points the seasonal fields are null. Means:
    halves of the series when it has <= 24 points, else the 12 before the
    last 12 and the last 12 (A29).
    """
    s = series_arrays(df, value, trim_leading_zeros).withColumn("n", F.size("x"))
    enough = F.col("n") >= min_points
    s = s.select(
        "*",
        F.when(enough, F.slice("x", -12, 12)).alias("w_after"),
        F.when(enough, F.slice("x", F.col("n") - 17, 12)).alias("w_before"),
    )
    s = s.select("*", acf(F.col("w_after")).alias("acf_after"), acf(F.col("w_before")).alias("acf_before"))
    s = s.select(
        "*",
        F.when(enough, best_period(F.col("acf_after"))).alias("period_after"),
        F.when(enough, best_period(F.col("acf_before"))).alias("period_before"),
    )
    s = s.select(
        "*",
        F.when(enough, seasonal_component(F.col("w_after"), F.col("period_after"))).alias("seasonal_after"),
        F.when(enough, seasonal_component(F.col("w_before"), F.col("period_before"))).alias("seasonal_before"),
    )
    half = F.floor(F.col("n") / 2).cast("int")
    long_series = F.col("n") > 24
    mean_before = F.when(long_series, _mean(F.slice("x", -24, 12))).otherwise(
        F.when(half > 0, _mean(F.slice("x", 1, half)))
    )
    mean_after = F.when(long_series, _mean(F.slice("x", -12, 12))).otherwise(
        F.when(F.col("n") - half > 0, _mean(F.slice("x", half + 1, F.col("n") - half)))
    )
    return s.select(
        CUST,
        (F.col("period_after") - F.col("period_before")).alias("diff_phase"),
        F.array_max("seasonal_before").alias("amplitude"),
        "period_after",
        "period_before",
        "seasonal_after",
        "seasonal_before",
        F.when(enough, cross_corr_argmax(F.col("seasonal_after"), F.col("seasonal_before"), shift_mode)).alias("seasonal_shift"),
        mean_before.alias("mean_before"),
        mean_after.alias("mean_after"),
    )


# --------------------------------------------------------------------------
# Arrow-batched engine: the same comparison vectorised over a batch of
# customers with numpy (higher-order functions run interpreted, about 40x
# slower on this workload).
# --------------------------------------------------------------------------
import numpy as np  # noqa: E402
import pandas as pd  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

SEASONAL_SCHEMA = T.StructType(
    [
        T.StructField("diff_phase", T.IntegerType()),
        T.StructField("amplitude", T.DoubleType()),
        T.StructField("period_after", T.IntegerType()),
        T.StructField("period_before", T.IntegerType()),
        T.StructField("seasonal_after", T.ArrayType(T.DoubleType())),
        T.StructField("seasonal_before", T.ArrayType(T.DoubleType())),
        T.StructField("seasonal_shift", T.IntegerType()),
        T.StructField("mean_before", T.DoubleType()),
        T.StructField("mean_after", T.DoubleType()),
    ]
)


def np_acf(w: np.ndarray, nlags: int = 6) -> np.ndarray:
    """Rows of ``w`` -> biased ACF of lags 1..nlags (NaN for flat rows)."""
    d = w - w.mean(axis=1, keepdims=True)
    c0 = (d * d).sum(axis=1)
    n = w.shape[1]
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.stack([(d[:, : n - k] * d[:, k:]).sum(axis=1) / c0 for k in range(1, nlags + 1)], axis=1)


def np_best_period(acfs: np.ndarray) -> np.ndarray:
    """First argmax + 1, NaN rows -> 1 (numpy's argmax stops at the first NaN)."""
    filled = np.where(np.isnan(acfs), -np.inf, acfs)
    best = filled.argmax(axis=1) + 1
    return np.where(np.isnan(acfs).any(axis=1), 1, best)


def np_seasonal(w: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Additive seasonal component per row with that row's period."""
    out = np.zeros_like(w)
    n = w.shape[1]
    for per in np.unique(p):
        rows = p == per
        x = w[rows]
        half = per // 2
        taps = np.ones(2 * half + 1)
        if per % 2 == 0:
            taps[0] = taps[-1] = 0.5
        trend = np.full(x.shape, np.nan)
        for t in range(half, n - half):
            trend[:, t] = (x[:, t - half : t + half + 1] * taps).sum(axis=1) / per
        detr = x - trend
        with np.errstate(invalid="ignore"):
            avg = np.stack([np.nanmean(detr[:, i::per], axis=1) for i in range(per)], axis=1)
        avg = avg - avg.mean(axis=1, keepdims=True)
        out[rows] = avg[:, np.arange(n) % per]
    return out


def np_shift(a: np.ndarray, v: np.ndarray, mode: str = "full") -> np.ndarray:
    if mode == "valid":
        return np.zeros(a.shape[0], dtype=int)
    n = a.shape[1]
    corr = np.stack(
        [
            (a[:, max(0, n - 1 - k) + k - (n - 1) : min(n - 1, 2 * n - 2 - k) + k - (n - 1) + 1]
             * v[:, max(0, n - 1 - k) : min(n - 1, 2 * n - 2 - k) + 1]).sum(axis=1)
            for k in range(2 * n - 1)
        ],
        axis=1,
    )
    return corr.argmax(axis=1)


def _compare_batch(xs: pd.Series, shift_mode: str, min_points: int) -> pd.DataFrame:
    arrs = [np.asarray(x, dtype=float) for x in xs]
    lengths = np.array([len(a) for a in arrs], dtype=int)
    columns = {f.name: np.full(len(arrs), None, dtype=object) for f in SEASONAL_SCHEMA.fields}

    def put(name: str, rows: np.ndarray, values) -> None:
        for row, value in zip(rows.tolist(), values.tolist()):  # objects: some cells stay null
            columns[name][row] = value

    for k in np.unique(lengths):  # customers with equally many months at once
        rows = np.flatnonzero(lengths == k)
        x = np.stack([arrs[i] for i in rows])
        before, after = (x[:, -24:-12], x[:, -12:]) if k > 24 else (x[:, : k // 2], x[:, k // 2 :])
        for name, part in (("mean_before", before), ("mean_after", after)):
            if part.shape[1]:
                put(name, rows, part.mean(axis=1))
    rows = np.flatnonzero(lengths >= min_points)
    if len(rows):
        after = np.stack([arrs[i][-12:] for i in rows])
        before = np.stack([arrs[i][-18:-6] for i in rows])
        pa, pb = np_best_period(np_acf(after)), np_best_period(np_acf(before))
        sa, sb = np_seasonal(after, pa), np_seasonal(before, pb)
        found = {
            "period_after": pa, "period_before": pb, "diff_phase": pa - pb, "seasonal_after": sa, "seasonal_before": sb,
            "amplitude": sb.max(axis=1), "seasonal_shift": np_shift(sa, sb, shift_mode),
        }
        for name, values in found.items():
            put(name, rows, values)
    return pd.DataFrame(columns)


def seasonal_compare_arrow(
    df: DataFrame,
    value: str = "predicted",
    shift_mode: str = "full",
    trim_leading_zeros: bool = False,
    min_points: int = 18,
) -> DataFrame:
    """``seasonal_compare`` with the per-customer arithmetic in an
    Arrow-batched pandas UDF (vectorised across the customers of a batch)."""

    @F.pandas_udf(SEASONAL_SCHEMA)
    def compare(xs: pd.Series) -> pd.DataFrame:
        return _compare_batch(xs, shift_mode, min_points)

    s = series_arrays(df, value, trim_leading_zeros)
    return s.select(CUST, compare(F.col("x")).alias("r")).select(CUST, "r.*")
