"""Sources and sinks.

S1 reads a relational source through Spark's JDBC reader; connection
options (URL, user, password, driver) always come from the caller -- none
are stored here. S2 runs parameterised SQL with named parameter markers
instead of text substitution.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_jdbc(spark: SparkSession, query: str, options: dict[str, str], partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A query against a relational source. With a partition column and
    bounds the read is split into ``num_partitions`` parallel range queries;
    otherwise it is one connection (fine for small dimension tables)."""
    r = spark.read.format("jdbc").options(**options)
    if partition_column is not None:
        r = (
            r.option("dbtable", f"({query}) q")
            .option("partitionColumn", partition_column)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", str(num_partitions or 8))
        )
    else:
        r = r.option("query", query)
    return r.load()


def sql_with_dates(spark: SparkSession, sql: str, start_date: dt.date, end_date: dt.date) -> DataFrame:
    """SQL text with ``:start_date`` / ``:end_date`` parameter markers."""
    return spark.sql(sql, args={"start_date": start_date, "end_date": end_date})


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header row."""
    df.write.mode("overwrite").option("header", True).csv(path)


ACTION_LIST_SCHEMA = T.StructType([T.StructField("SAPCustomerNumber__c", T.StringType())])


def read_action_list(spark: SparkSession, path: str) -> DataFrame:
    """An action list (customer ids) from CSV with a declared schema."""
    return spark.read.schema(ACTION_LIST_SCHEMA).option("header", True).csv(path)


def status_schema(panel_columns: list[str]) -> T.StructType:
    """The dashboards' status table: customer, month, the panel's
    numeric columns, flags and status (declared, never inferred)."""
    fields = [T.StructField("CUSTOMER_SHIPTO", T.StringType()), T.StructField("POSTING_DATE", T.DateType())]
    fields += [T.StructField(c, T.DoubleType()) for c in panel_columns]
    fields += [
        T.StructField("RISK_CHECK", T.IntegerType()),
        T.StructField("GROWTH", T.IntegerType()),
        T.StructField("RISK_UNCHECK", T.IntegerType()),
        T.StructField("RISK_STATUS", T.StringType()),
    ]
    return T.StructType(fields)


def read_status_csv(spark: SparkSession, path: str, panel_columns: list[str]) -> DataFrame:
    """Read a status CSV (UTF-8, header, comma) with the declared schema."""
    return (
        spark.read.schema(status_schema(panel_columns))
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("sep", ",")
        .csv(path)
    )
