"""Dense customer x month panel and its window features.

Plan shape: the rollup's rows are dealt by customer once. Each month
with facts is then repeated for the empty months up to the customer's next one
(from the global first, to the global last month), so the grid's zero rows are
made where they are used and never shuffled. Every window uses
the same spec -- partition by customer, order by month -- so the whole feature
chain runs behind that exchange, and so do the Kalman aggregate and its join
back. Zeros shrink to a tenth and less in a shuffle, so the number of parts
comes from the rows that the panel will have and not from the bytes shuffled.
"""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.functions import holidays as hol
from churnlens.functions import series

CUST = "CUSTOMER_SHIPTO"
MONTH = "POSTING_DATE"

# The panel's 34 numeric measures, in the reference's order.
PANEL_SUMS = [
    "CNTD_RENTAL_POSTING_DATE", "CNTD_POSTING_DATE", "CNT_POSTING_DATE",
    "AVG_DOCUMENT_ISSUE_DIFF", "AVG_POST_ISSUE_DIFF", "REFERENCE_ITEMS",
    "POSTING_PERIOD", "ORDER_NO", "CCH", "DAY_BETWEEN_POSTING", "SALE_QTY",
    "RENTAL_BILLED_QTY", "PRODUCT_SALES", "RENTAL_SALES", "DELIVERY",
    "DAILY_RENT", "MONTHLY_RENT", "QUARTERLY_RENT", "ANNUAL_RENT",
    "Other_Rent_Period", "DISCOUNT_RATIO", "MATERIAL_020112_SALE",
    "MATERIAL_050299_SALE", "MATERIAL_020110_SALE", "MATERIAL_020104_SALE",
    "MATERIAL_111899_SALE", "MATERIAL_051299_SALE", "PROD_SMLLD2_SALE",
    "PROD_1MEDLE_SALE", "PROD_SMLLD_SALE", "PROD_5MEDLE_SALE",
    "PROD_LRGLG_SALE", "PROD_4MEDLE2_SALE", "PROD_8LRGLG_SALE",
]
# Columns that get lags 1..6.
LAG_COLUMNS = [
    "CCH", "RENTAL_SALES", "POSTING_PERIOD", "SALE_QTY", "CNTD_RENTAL_POSTING_DATE",
    "DAILY_RENT", "CNT_POSTING_DATE", "PROD_LRGLG_SALE", "Holidays",
    "Smoothed_Holidays", "KSD",
]
N_LAGS = 6
N_LEADS = 6
N_BACK = 12  # months that a row of create_lags looks back: those of its 12-month flag
ROWS_PER_TASK = 250_000  # panel rows: what a task sorts at once


def by_customer() -> Window:
    return Window.partitionBy(CUST).orderBy(MONTH)


# Identifier / attribute columns kept as text when present.
TEXT_COLUMNS = ["CUSTOMER_NUMBER", "SHIP_TO", "INDUSTRY", "INDUSTRY_SUBLEVEL", "PLANT", "CUSTOMER_SHIPTO"]


def cast_present(df: DataFrame, columns: list[str] = TEXT_COLUMNS, to: str = "string") -> DataFrame:
    """P5: cast the listed columns that exist in ``df``."""
    return df.select(*[F.col(c).cast(to).alias(c) if c in columns else F.col(c) for c in df.columns])


def month_bounds(monthly: DataFrame) -> tuple[dt.date, dt.date] | None:
    """The first and last month of the rollup (None: it is empty): one column of the staged
    rollup read once, so that everything after has them as literals."""
    lo, hi = monthly.select(F.to_date(F.col(MONTH), "yyyy-MM").alias("m")).agg(F.min("m"), F.max("m")).first()
    return (lo, hi) if lo else None


def panel_parts(monthly: DataFrame, bounds: tuple[dt.date, dt.date] | None) -> int:
    """Parts for the panel of a staged rollup: its rows are customers times months."""
    customers = monthly.agg(F.approx_count_distinct("CUSTOMER_NUMBER")).first()[0]
    lo, hi = bounds or (dt.date(1, 1, 1), dt.date(1, 1, 1))
    months = (hi.year - lo.year) * 12 + hi.month - lo.month + 1
    return max(1, -(-customers * months // ROWS_PER_TASK))


def dense_panel(monthly: DataFrame, bounds: tuple[dt.date, dt.date] | None = None, parts: int | None = None) -> DataFrame:
    """X11: rollup rows -> one row per (customer, month) over the global
    month range, numeric measures summed (A24) and zero-filled (P7), dealt by
    customer. ``bounds``: the range if it is known, else two scalar subqueries;
    ``parts``: the number of parts, else Spark's."""
    rows = cast_present(monthly).select(
        F.col("CUSTOMER_NUMBER").cast("string").alias(CUST),
        F.to_date(F.col(MONTH), "yyyy-MM").alias(MONTH),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in PANEL_SUMS],
    )
    lo, hi = map(F.lit, bounds) if bounds else (rows.select(f(MONTH)).scalar() for f in (F.min, F.max))
    rows = rows.repartition(parts, CUST) if parts else rows.repartition(CUST)
    # rows without customer or month have no place in the grid, but their customer has
    placed = F.col(CUST).isNotNull() & F.col(MONTH).between(lo, hi)
    rows = rows.select(CUST, F.when(placed, F.col(MONTH)).otherwise(lo).alias(MONTH),
                       *[F.when(placed, F.col(c)).otherwise(0.0).alias(c) for c in PANEL_SUMS])
    facts = rows.groupBy(CUST, MONTH).agg(*[F.sum(c).alias(c) for c in PANEL_SUMS])
    w = by_customer()
    start = F.when(F.lag(MONTH).over(w).isNull(), lo).otherwise(F.col(MONTH))
    end = F.coalesce(F.add_months(F.lead(MONTH).over(w), -1), hi)
    span = facts.select("*", F.sequence(start, end, F.expr("INTERVAL 1 MONTH")).alias("_span"))
    grid = span.select(CUST, F.col(MONTH).alias("_own"), F.explode("_span").alias(MONTH), *PANEL_SUMS)
    own = F.col(MONTH) == F.col("_own")
    return grid.select(CUST, MONTH, *[F.when(own, F.col(c)).otherwise(0.0).alias(c) for c in PANEL_SUMS])


def calendar_of(spark: SparkSession, bounds: tuple[dt.date, dt.date] | None) -> DataFrame | None:
    """The rule-made holidays of the years between the panel's bounds, if they are known: a dense
    panel has every month between them, so it needn't be made to list its years."""
    if not bounds:
        return None
    years = spark.range(bounds[0].year, bounds[1].year + 1).select(F.col("id").cast("int").alias("year"))
    return hol.holiday_calendar(years)


def holiday_counts(panel: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Holiday count per month: of the caller's ``holidays`` (date, holiday), else of the
    rule-made calendar for the years present in the panel."""
    if holidays is None:
        holidays = hol.holiday_calendar(panel.select(F.year(MONTH).alias("year")).distinct())
    return hol.holidays_per_month(holidays)


def add_holidays(panel: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Left join the month's holiday count (a dimension bounded by the
    calendar, so it is broadcast), zero when none."""
    counts = holiday_counts(panel, holidays)
    return panel.join(F.broadcast(counts), MONTH, "left").withColumn(
        "Holidays", F.coalesce(F.col("Holidays"), F.lit(0)).cast("bigint")
    )


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _kalman_batch(ys: pd.Series) -> pd.Series:
    return pd.Series(series.np_kalman_smooth(list(ys)))


def kalman_levels(panel: DataFrame, value: str = "CCH", engine: str = "arrow") -> DataFrame:
    """Per customer, the RTS-smoothed level of ``value`` by month.

    One row per customer with the sorted series as an array (bounded by the
    number of months). ``engine='arrow'`` runs the recursion in numpy over a
    whole Arrow batch of customers at once; ``'native'`` uses higher-order
    array functions (no Python, but interpreted per row: ~10x slower here).
    """
    series_df = panel.groupBy(CUST).agg(
        F.array_sort(F.collect_list(F.struct(F.col(MONTH), F.col(value).cast("double").alias("v")))).alias("s")
    )
    ys = F.transform("s", lambda e: e["v"])
    smooth = _kalman_batch(ys) if engine == "arrow" else series.kalman_smooth(ys)
    return series_df.select(CUST, F.transform("s", lambda e: e[MONTH]).alias("months"), smooth.alias("ks"))


def panel_features(panel: DataFrame, holidays: DataFrame | None = None, tap: str = "oldest", last: dt.date | None = None) -> DataFrame:
    """X12 + create_lags: ``window_features``, then ``create_lags``. ``last``: only the rows of
    the dense panel's last month are wanted, which look back N_BACK months at most; the lags,
    where rows are widest, are made for no month before those. The rows of the months between
    are returned too, and lack what they would look back to."""
    df = window_features(panel, holidays, tap)
    if last:
        df = df.filter(F.col(MONTH) >= F.add_months(F.lit(last), -N_BACK))
    return create_lags(df)


def window_features(panel: DataFrame, holidays: DataFrame | None = None, tap: str = "oldest") -> DataFrame:
    """Holidays (a caller's table, or the rule-made calendar), Kalman level and its difference,
    rolling variance, Gaussian period, smoothed holidays, zero fill of the
    warm-up nulls, and the row's number ``_i``. ``tap``: which
    end of the smoothed 12 months the Gaussian period is taken at, the oldest (as the
    reference's callback does) or the latest; the filter's mirrored edges are alike."""
    if tap not in ("oldest", "latest"):
        raise ValueError(tap)
    w = by_customer()
    # the panel is dealt by customer: its windows, the Kalman aggregate and the join
    # between them need no exchange
    df = add_holidays(panel, holidays).withColumn("_i", F.row_number().over(w))
    ks = kalman_levels(df)
    # one row per customer: hashed, so that the panel's rows stay in the windows' order
    df = df.join(ks.select(CUST, "ks").hint("shuffle_hash"), CUST, "left").withColumn(
        "KS_filtered", F.element_at("ks", F.col("_i"))
    ).drop("ks")
    w12 = w.rowsBetween(-11, 0)
    full12 = F.col("_i") >= 12
    df = df.select(
        "*",
        (F.col("KS_filtered") - F.lag("KS_filtered", 1).over(w)).alias("KSD"),
        F.when(full12, F.var_samp("CCH").over(w12)).alias("cv2"),
        F.when(full12, F.var_samp("SALE_QTY").over(w12)).alias("cv2_sales"),
        F.when(full12, series.gaussian_period([F.lag("CCH", 11 - j if tap == "oldest" else j).over(w) for j in range(7)])).alias("period"),
        F.avg("Holidays").over(w12).alias("Smoothed_Holidays"),
    )
    # before create_lags: warm-up nulls of KSD, cv2, period
    return df.na.fill(0.0, subset=["KSD", "cv2", "cv2_sales", "period"])


def create_lags(df: DataFrame) -> DataFrame:
    """Lags, rolling means, leads and the 12-month flag of ``window_features``' rows."""
    w = by_customer()
    lags = [F.lag(c, i).over(w).alias(f"{c}_lag_{i}") for c in LAG_COLUMNS for i in range(1, N_LAGS + 1)]
    rolls = [
        F.when(F.col("_i") >= n, F.avg("CCH").over(w.rowsBetween(-(n - 1), 0))).alias(f"ROLL_MEAN_{n}")
        for n in (3, 6)
    ]
    leads = [F.lead(c, i).over(w).alias(f"{c}_shift_{i}") for c in ("CCH", "Smoothed_Holidays") for i in range(1, N_LEADS + 1)]
    less12 = F.lag(MONTH, 12).over(w).isNotNull().cast("int").alias("less12")
    return df.select("*", *lags, *rolls, *leads, less12).drop("_i")


def period_diff_bucket(features: DataFrame) -> DataFrame:
    """W7 + F14: month-on-month change of ``period`` (first row 0) and its
    bucket ``miss_period``."""
    w = by_customer()
    diff = F.coalesce(F.col("period") - F.lag("period", 1).over(w), F.lit(0.0))
    d = F.col("period_diff")
    # fixed values: the bucket's upper bounds
    bucket = (
        F.when(d <= -3, -3).when(d <= -2, -2).when(d <= -1, -1).when(d <= 0.5, 0)
        .when(d <= 1.5, 1).when(d <= 2.5, 2).when(d > 2.5, 3).otherwise(0)
    )
    return features.withColumn("period_diff", diff).withColumn("miss_period", bucket.cast("bigint"))
