"""Normalise result types of registered queries (decimal sums to double,
small integers to bigint) so Spark and DuckDB results compare exactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round_half_away(c: Column, digits: int) -> Column:
    """Round half away from zero in double arithmetic, as DuckDB's ``round``
    does. Used where a value can sit on a decimal tie; ``finalize`` keeps
    ``F.round`` (measured faster on wide outputs)."""
    m = 10.0 ** digits
    scaled = F.abs(c) * m
    r = F.signum(c) * F.floor(scaled + 0.5).cast("double") / m
    return F.when(F.isnan(c) | (scaled >= 4.5e15), c * m / m).otherwise(r)


def finalize(df: DataFrame, digits: int | None = None) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
            if digits is not None:
                c = F.round(c, digits)
        elif isinstance(f.dataType, T.DoubleType) and digits is not None:
            c = F.round(c, digits)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)
