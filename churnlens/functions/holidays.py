"""National public-holiday dimension generated from date rules.

The reference calls a holiday-rules library; here the calendar is a small
DataFrame derived from the years present in the data: fixed-date holidays
plus Good Friday and Easter Monday from the Gregorian Easter computus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values: (month, day, name) of the fixed-date national holidays.
FIXED_HOLIDAYS = [
    (1, 1, "New Year's Day"),
    (1, 26, "Australia Day"),
    (4, 25, "Anzac Day"),
    (12, 25, "Christmas Day"),
    (12, 26, "Boxing Day"),
]


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter Sunday (anonymous Gregorian / Meeus-Jones-Butcher)."""
    y = year.cast("int")
    a = F.pmod(y, F.lit(19))
    b = F.floor(y / 100).cast("int")
    c = F.pmod(y, F.lit(100))
    d = F.floor(b / 4).cast("int")
    e = F.pmod(b, F.lit(4))
    f = F.floor((b + 8) / 25).cast("int")
    g = F.floor((b - f + 1) / 3).cast("int")
    h = F.pmod(19 * a + b - d - g + 15, F.lit(30))
    i = F.floor(c / 4).cast("int")
    k = F.pmod(c, F.lit(4))
    l_ = F.pmod(32 + 2 * e + 2 * i - h - k, F.lit(7))
    m = F.floor((a + 11 * h + 22 * l_) / 451).cast("int")
    month = F.floor((h + l_ - 7 * m + 114) / 31).cast("int")
    day = F.pmod(h + l_ - 7 * m + 114, F.lit(31)) + 1
    return F.make_date(y, month, day)


def holiday_calendar(years: DataFrame, year_col: str = "year") -> DataFrame:
    """(date, holiday) rows for each distinct year in ``years``."""
    y = F.col(year_col)
    fixed = F.array(
        *[F.struct(F.make_date(y, F.lit(m), F.lit(dd)).alias("date"), F.lit(name).alias("holiday")) for m, dd, name in FIXED_HOLIDAYS]
    )
    easter = easter_sunday(y)
    moving = F.array(
        F.struct(F.date_sub(easter, 2).alias("date"), F.lit("Good Friday").alias("holiday")),
        F.struct(F.date_add(easter, 1).alias("date"), F.lit("Easter Monday").alias("holiday")),
    )
    return (
        years.select(y).distinct()
        .select(F.explode(F.concat(fixed, moving)).alias("h"))
        .select("h.date", "h.holiday")
    )


def holidays_per_month(calendar: DataFrame) -> DataFrame:
    """Number of distinct holiday dates per month start."""
    return (
        calendar.groupBy(F.trunc("date", "MM").alias("POSTING_DATE"))
        .agg(F.count_distinct("date").alias("Holidays"))
    )


def with_days_in_lieu(calendar: DataFrame) -> DataFrame:
    """``calendar`` (date, holiday: a caller's table or ``holiday_calendar``) and a day in
    lieu for each date in it that falls on a weekend: the next working day that is neither
    a holiday nor already in lieu of an earlier one.

    Working days that aren't holidays are numbered. A weekend holiday (the i-th) could have
    the free day f_i, the first after it; taking them in order, each later than the one
    before, gives day i + max over j <= i of (f_j - j): one running maximum. The windows run
    over the calendar's days, whose number doesn't depend on the data.
    """
    dates = calendar.select("date").distinct()
    span = dates.agg(F.min("date").alias("lo"), F.max("date").alias("hi"), F.count("*").cast("int").alias("n"))
    days = span.select(F.explode(F.sequence("lo", F.date_add("hi", 14 + 2 * F.col("n")))).alias("date")).join(
        dates.withColumn("off", F.lit(True)), "date", "left")
    weekend = F.dayofweek("date").isin(1, 7)
    order = Window.orderBy("date")
    days = days.select("date", weekend.alias("weekend"), F.col("off").isNotNull().alias("off"))
    days = days.withColumn("free", (~F.col("weekend") & ~F.col("off")).cast("int")).withColumn("number", F.sum("free").over(order))
    lost = days.where("weekend AND off").withColumn("i", F.row_number().over(order))
    lost = lost.withColumn("number", F.col("i") + F.max(F.col("number") + 1 - F.col("i")).over(order))
    lieu = lost.select("number", F.col("date").alias("lost")).join(days.where("free = 1").select("number", "date"), "number")
    names = calendar.groupBy(F.col("date").alias("lost")).agg(F.min("holiday").alias("holiday"))
    return calendar.select("date", "holiday").unionByName(
        lieu.join(names, "lost").select("date", F.concat("holiday", F.lit(" (in lieu)")).alias("holiday")))
