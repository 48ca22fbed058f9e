"""Data profiles for exploration (A35-A37): describe, histogram and
per-class quantiles as small result tables (the reference plots them)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions.quantiles import exact_quantiles
from churnlens.sources.stage import stage


def _long(df: DataFrame, columns: Sequence[str], *keys: str) -> DataFrame:
    """(keys, variable, v): a row for each value of each column."""
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("v")) for c in columns]))
    return df.select(*keys, values.alias("e")).select(*keys, "e.variable", "e.v")


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: count, nulls, mean, stddev, min, median, max
    (exact). Counts and moments are one aggregate; the medians come from
    ``exact_quantiles``, which spreads a column over all tasks."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"{c}__count"), F.count(F.when(x.isNull(), 1)).alias(f"{c}__nulls"),
            F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__stddev"),
            F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"),
        ]
    wide = df.agg(*aggs)
    stats = ["count", "nulls", "mean", "stddev", "min", "max"]
    rows = F.array(*[
        F.struct(F.lit(c).alias("variable"), *[F.col(f"`{c}__{s}`").cast("double").alias(s) for s in stats]) for c in columns])
    out = wide.select(F.explode(rows).alias("r")).select("r.*")
    medians = exact_quantiles(_long(df, columns), ["variable"], F.col("v"), [0.5]).select("variable", F.col("q")[0].alias("median"))
    return out.join(medians, "variable", "left").select(
        "variable", F.col("count").cast("bigint").alias("count"), F.col("nulls").cast("bigint").alias("nulls"),
        "mean", "stddev", "min", "median", "max")


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins between the column's min and max (a flat column
    spans [v - .5, v + .5]); the last bin is closed. Bounds come from a
    one-row aggregate used as scalar subqueries."""
    x = F.col(column).cast("double")
    lo0 = df.select(F.min(x)).scalar()
    hi0 = df.select(F.max(x)).scalar()
    lo = F.when(lo0 == hi0, lo0 - 0.5).otherwise(lo0)
    hi = F.when(lo0 == hi0, hi0 + 0.5).otherwise(hi0)
    width = (hi - lo) / bins
    b = F.least(F.floor((x - lo) / width), F.lit(bins - 1)).cast("bigint")
    return (
        df.filter(x.isNotNull())
        .groupBy(b.alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select("bin", (lo + F.col("bin") * width).alias("bin_lo"), (lo + (F.col("bin") + 1) * width).alias("bin_hi"), "count")
    )


def class_quantiles(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Per class and variable: n, mean and exact quantiles 0/.25/.5/.75/1
    (the data behind violin / density plots)."""
    long = stage(_long(df, columns, label), "class-values")
    means = long.groupBy(label, "variable").agg(F.avg("v").alias("mean"))
    q = exact_quantiles(long, [label, "variable"], F.col("v"), [0.0, 0.25, 0.5, 0.75, 1.0])
    q = q.select(F.col(label).alias("_label"), F.col("variable").alias("_variable"), "n", "q")
    both = means.join(q, means[label].eqNullSafe(q["_label"]) & (means["variable"] == q["_variable"]), "left")
    return both.select(
        label, "variable", F.coalesce("n", F.lit(0)).alias("n"), "mean",
        *[F.col("q")[i].alias(n) for i, n in enumerate(["p0", "p25", "p50", "p75", "p100"])],
    )
