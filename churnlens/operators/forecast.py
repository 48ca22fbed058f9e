"""Six-month-ahead forecasts with quantile bands.

The reference samples a neural forecaster. Here the sample paths of
horizon h for a customer are the customer's own historical h-month moves
added to the last value: {y_T + (y_{t+h} - y_t) : t + h <= T}. Mean and
P25/P75 (linear interpolation) summarise them. The job is deterministic,
fully distributed and keyed by customer: one window pass (lead 1..6) and
one aggregate that reuses the window's partitioning.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CUST = "CUSTOMER_SHIPTO"
MONTH = "POSTING_DATE"
STATS = ("sample_mean", "lower_bound", "upper_bound")


def _samples(df: DataFrame, keys: list[str], anchor: Column, horizon: int, min_nonzero: int, value: str) -> DataFrame:
    """(keys, h, sample, actual) rows; history is month <= anchor."""
    part = Window.partitionBy(*keys)
    w = part.orderBy(MONTH)
    in_hist = F.col(MONTH) <= anchor
    cols = [
        *[F.col(k) for k in keys],
        F.col(MONTH),
        F.col(value).alias("_y"),
        anchor.alias("_anchor"),
        F.max(F.when(F.col(MONTH) == anchor, F.col(value))).over(part).alias("_yT"),
        F.count(F.when(in_hist & (F.col(value) != 0), 1)).over(part).alias("_nz"),
    ]
    for h in range(1, horizon + 1):
        cols.append(F.lead(value, h).over(w).alias(f"_l{h}"))
        cols.append(F.max(F.when(F.col(MONTH) == F.add_months(anchor, h), F.col(value))).over(part).alias(f"_a{h}"))
    s = df.select(*cols).filter(in_hist & (F.col("_nz") >= min_nonzero))
    per_h = F.array(
        *[
            F.struct(
                F.lit(h).alias("h"),
                F.when(F.add_months(F.col(MONTH), h) <= F.col("_anchor"), F.col("_yT") + F.col(f"_l{h}") - F.col("_y")).alias("sample"),
                F.col(f"_a{h}").alias("actual"),
            )
            for h in range(1, horizon + 1)
        ]
    )
    return s.select(*keys, "_anchor", F.explode(per_h).alias("e")).select(
        *keys, F.col("_anchor").alias("anchor"), "e.h", "e.sample", "e.actual"
    )


def _summarise(samples: DataFrame, keys: list[str]) -> DataFrame:
    q = F.percentile(F.col("sample"), F.array(F.lit(0.25), F.lit(0.75)))
    return (
        samples.groupBy(*keys, "anchor", "h")
        .agg(
            F.avg("sample").alias("sample_mean"),
            q.alias("_q"),
            F.max("actual").alias("actual"),
            F.count("sample").alias("n_samples"),
        )
        .filter(F.col("n_samples") > 0)
        .select(
            *keys,
            "anchor",
            "h",
            F.concat(F.lit("period_"), F.col("h").cast("string")).alias("PERIOD"),
            "sample_mean",
            F.col("_q")[0].alias("lower_bound"),
            F.col("_q")[1].alias("upper_bound"),
            "actual",
        )
    )


def forecast_long(
    panel: DataFrame, start_date: dt.date, horizon: int = 6, min_nonzero: int = 3, value: str = "CCH"
) -> DataFrame:
    """M2 (+P12, A27, A28): (customer, PERIOD, sample_mean, lower_bound,
    upper_bound) for customers with at least ``min_nonzero`` non-zero
    months up to ``start_date``."""
    hist = panel.filter(F.col(MONTH) <= F.lit(start_date))
    s = _samples(hist, [CUST], F.lit(start_date), horizon, min_nonzero, value)
    return _summarise(s, [CUST]).select(CUST, "PERIOD", *STATS)


def forecast_wide(long: DataFrame, start_date: dt.date, horizon: int = 6) -> DataFrame:
    """U4 + F19: one row per customer, ``period_{h}_{stat}`` columns, the
    band width ``period_{h}_uncertainty`` and PREDICTION_DATE."""
    periods = [f"period_{h}" for h in range(1, horizon + 1)]
    wide = long.groupBy(CUST).pivot("PERIOD", periods).agg(*[F.first(s).alias(s) for s in STATS])
    return wide.select(
        "*",
        *[(F.col(f"{p}_upper_bound") - F.col(f"{p}_lower_bound")).alias(f"{p}_uncertainty") for p in periods],
        F.lit(start_date).alias("PREDICTION_DATE"),
    )


def month_anchors(panel: DataFrame, lead_in: int = 6, tail: int = 4, bounds: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """Backtest anchors: every month from first+lead_in to last-tail (the
    reference's list of prediction months). Bounded by the calendar.
    ``bounds``: the panel's first and last month if they are known."""
    first, final = map(F.lit, bounds) if bounds else (panel.select(f(MONTH)).scalar() for f in (F.min, F.max))
    lo, hi = F.add_months(first, lead_in), F.add_months(final, -tail)
    return panel.sparkSession.range(1).select(
        F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 MONTH"))).alias("anchor")
    )


def prefix_stats(y: np.ndarray, at: Sequence[int], horizon: int, min_nonzero: int) -> Iterator[tuple]:
    """For series of equal length (a row each) and each anchor position T: (T, h, rows,
    mean, lower, upper, actual or None) of the samples y[T] + (y[t+h] - y[t]), t + h <= T,
    over the rows with ``min_nonzero`` non-zero values up to T. The moves of a horizon are
    computed once; sums are cumulative and the sorted prefix grows from anchor to anchor."""
    nonzero = np.cumsum(y != 0, axis=1)
    for h in range(1, horizon + 1):
        moves = y[:, h:] - y[:, :-h]
        sums = np.cumsum(moves, axis=1)
        ordered = moves[:, :0]
        for t in at:
            k = t - h + 1
            rows = np.flatnonzero(nonzero[:, t] >= min_nonzero)
            if k < 1 or not len(rows):
                continue
            ordered = np.sort(np.concatenate([ordered, moves[:, ordered.shape[1] : k]], axis=1), axis=1, kind="stable")
            quartiles = []
            for q in (0.25, 0.75):
                pos = q * (k - 1)
                lo, hi = int(np.floor(pos)), int(np.ceil(pos))
                quartiles.append(y[rows, t] + (ordered[rows, lo] if lo == hi else (hi - pos) * ordered[rows, lo] + (pos - lo) * ordered[rows, hi]))
            actual = y[rows, t + h] if t + h < y.shape[1] else None
            yield t, h, rows, y[rows, t] + sums[rows, k - 1] / k, *quartiles, actual


def backtest(panel: DataFrame, anchors: DataFrame, horizon: int = 6, min_nonzero: int = 3, value: str = "CCH") -> DataFrame:
    """M4: the forecast at every anchor month with the realised value.

    The panel is dense and zero-filled. One row per customer holds the series as an array
    (bounded by the calendar); each Arrow batch of customers goes through ``prefix_stats``
    at once, so a customer's months meet in one shuffle and no row is made for a pair of
    month and anchor: the rows made are the result's, customers x anchors x horizon.
    Returns (customer, anchor, h, PERIOD, sample_mean, lower_bound, upper_bound, actual).
    """
    month = lambda c: F.year(c) * 12 + F.month(c) - 1
    wanted = anchors.select(F.array_sort(F.collect_set(month(F.col("anchor"))))).scalar()
    by_customer = panel.groupBy(F.col(CUST).alias("c")).agg(
        F.array_sort(F.collect_list(F.struct(month(F.col(MONTH)).alias("m"), F.col(value).cast("double").alias("y")))).alias("s"))
    series = by_customer.select("c", F.col("s.m").alias("months"), F.col("s.y").alias("ys"), wanted.alias("anchors"))

    def score(batches):
        for rec in batches:
            groups: dict[tuple, list[int]] = {}
            months, anchors_ = rec.column(1).to_pylist(), rec.column(3).to_pylist()
            for i, m in enumerate(months):
                groups.setdefault(tuple(m), []).append(i)
            for m, members in groups.items():
                place = {x: n for n, x in enumerate(m)}
                at = [place[a] for a in anchors_[members[0]] if a in place]
                y = np.array([rec.column(2)[i].as_py() for i in members], dtype=float)
                names = rec.column(0).take(pa.array(members))
                for t, h, rows, mean, lower, upper, actual in prefix_stats(y, at, horizon, min_nonzero):
                    n = len(rows)
                    yield pa.record_batch([
                        names.take(pa.array(rows)), pa.array(np.full(n, m[t]), pa.int32()), pa.array(np.full(n, h), pa.int32()), pa.array(mean),
                        pa.array(lower), pa.array(upper), pa.nulls(n, pa.float64()) if actual is None else pa.array(actual)], names=names_out)

    schema = T.StructType([
        T.StructField("c", panel.schema[CUST].dataType), T.StructField("m", T.IntegerType()), T.StructField("h", T.IntegerType()),
        *[T.StructField(x, T.DoubleType()) for x in (*STATS, "actual")]])
    names_out = schema.names
    anchor = F.make_date(F.floor(F.col("m") / 12).cast("int"), F.col("m") % 12 + 1, F.lit(1))
    return series.mapInArrow(score, schema).select(
        F.col("c").alias(CUST), anchor.alias("anchor"), "h", F.concat(F.lit("period_"), F.col("h").cast("string")).alias("PERIOD"), *STATS, "actual")


def backtest_error(bt: DataFrame) -> DataFrame:
    """Error of the backtest by anchor and horizon: count, MAE, RMSE and the
    share of actuals inside [P25, P75]."""
    err = F.col("actual") - F.col("sample_mean")
    inside = F.when((F.col("actual") >= F.col("lower_bound")) & (F.col("actual") <= F.col("upper_bound")), 1.0).otherwise(0.0)
    return (
        bt.filter(F.col("actual").isNotNull())
        .groupBy("anchor", "PERIOD")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.abs(err)).alias("mae"),
            F.sqrt(F.avg(err * err)).alias("rmse"),
            F.avg(inside).alias("coverage"),
        )
    )


def backtest_wide(bt: DataFrame, horizon: int = 6) -> DataFrame:
    """The backtest as the training table's forecast columns: one row per
    (customer, anchor) with PREDICTION_DATE = anchor."""
    periods = [f"period_{h}" for h in range(1, horizon + 1)]
    wide = bt.groupBy(CUST, "anchor").pivot("PERIOD", periods).agg(*[F.first(s).alias(s) for s in STATS])
    return wide.withColumnRenamed("anchor", "PREDICTION_DATE")
