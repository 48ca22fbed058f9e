"""Exact quantiles of groups of any size.

``percentile`` keeps every distinct value of a group in one task. Here the
values are counted, the counts are range-partitioned by (group, value), so a
group that holds all rows spreads over all partitions, and running counts come
from the totals of the partitions before. A quantile at rank q (n - 1) is the
linear interpolation between the values at its two neighbouring ranks, as
``percentile`` and the SQL standard's ``percentile_cont`` have it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.sources.stage import stage


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(right[f"r_{k}"])
    return on


def exact_quantiles(df: DataFrame, groups: Sequence[str], value: Column, probs: Sequence[float]) -> DataFrame:
    """(groups, n, q): the number of non-null values and the array of their
    quantiles at ``probs``. Null is a group like any other; NaN counts as the
    largest value. A group without values gives no row."""
    groups = list(groups)
    counts = df.select(*groups, value.cast("double").alias("v")).where("v IS NOT NULL").groupBy(*groups, "v").agg(F.count(F.lit(1)).alias("n"))
    counts = stage(counts.repartitionByRange(*groups, "v").withColumn("part", F.spark_partition_id()), "value-counts")
    totals = counts.groupBy(*groups, "part").agg(F.sum("n").alias("t"))  # at most one row for each group and partition
    per_group = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("t").over(per_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = totals.select(*[F.col(k).alias(f"r_{k}") for k in groups], F.col("part").alias("r_part"),
                           before.alias("start"), F.sum("t").over(per_group).alias("whole"))
    rows = counts.join(starts, _same(counts, starts, groups) & (counts["part"] == starts["r_part"]))
    end = F.col("start") + F.sum("n").over(Window.partitionBy(*groups, "part").orderBy("v"))
    rows = rows.select(*[counts[k] for k in groups], "v", "whole", (end - F.col("n")).alias("lo"), end.alias("hi"))

    def at(rank: Column) -> Column:  # the value that stands at a rank, found in one row
        return F.max(F.when((F.col("lo") <= rank) & (rank < F.col("hi")), F.col("v")))

    aggs = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("whole") - 1)
        aggs += [at(F.floor(pos)).alias(f"a{i}"), at(F.ceil(pos)).alias(f"b{i}")]
    picked = rows.groupBy(*groups).agg(F.max("whole").alias("n"), *aggs)
    q = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("n") - 1)
        w = pos - F.floor(pos)
        q.append(F.when(w == 0, F.col(f"a{i}")).otherwise(F.col(f"a{i}") * (1 - w) + F.col(f"b{i}") * w))
    return picked.select(*groups, "n", F.array(*q).alias("q"))
