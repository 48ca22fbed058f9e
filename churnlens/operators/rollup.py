"""Monthly customer rollup of the profitability ledger.

Two aggregates per (customer, month), joined on that key:

* the measures (sums, counts, averages, date bounds, day bitmaps): fixed-width buffers,
  so one hash aggregate, partial on the map side, over the full-width rows;
* the values: four distinct counts, the string maxima and the list of materials. The
  ledger's few columns for them become narrow (key, kind, value) rows, which are
  de-duplicated by hash, so a hot customer-month spreads over many tasks and a value
  leaves a task once; counts, maxima and lists are taken over what is left.

The ledger is scanned twice, the second time only for the key and the value columns. One
scan would carry every measure through each copy of a row (that is what Spark's Expand
does for several distinct counts), and string maxima beside sums would sort those rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The ledger's material-group and product-hierarchy codes and
# the output column each one feeds, in the reference's column order.
MATERIAL_GROUP_COLUMNS = [
    ("02-01-12", "MATERIAL_020112_SALE"),
    ("05-02-99", "MATERIAL_050299_SALE"),
    ("02-01-10", "MATERIAL_020110_SALE"),
    ("02-01-04", "MATERIAL_020104_SALE"),
    ("11-18-99", "MATERIAL_111899_SALE"),
    ("05-12-99", "MATERIAL_051299_SALE"),
]
PRODUCT_HIERARCHY_COLUMNS = [
    ("CO10500001LRGLG", "PROD_LRGLG_SALE"),
    ("CO10500001SMLLD2", "PROD_SMLLD2_SALE"),
    ("CO10500001MEDLE", "PROD_1MEDLE_SALE"),
    ("CD10010015SMLLD", "PROD_SMLLD_SALE"),
    ("CD10010015MEDLE", "PROD_5MEDLE_SALE"),
    ("CA50100024MEDLE2", "PROD_4MEDLE2_SALE"),
    ("CA50100028LRGLG", "PROD_8LRGLG_SALE"),
]
# Revenue and deduction terms of the net-sales expression.
REVENUE_TERMS = ["VVR98", "VVR99", "VVR95", "VVRR2", "VVR03", "VVR94", "VVR88", "VVRR1"]
DEDUCTION_TERMS = ["VVR93", "VVR92", "VVR89", "VVR70"]
RENTAL_UNITS = ["CMO", "CDA"]


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def deductions() -> Column:
    total = _zero(DEDUCTION_TERMS[0])
    for c in DEDUCTION_TERMS[1:]:
        total = total + _zero(c)
    return total


def net_sales() -> Column:
    """Revenue terms minus deduction terms, each null counted as 0."""
    revenue = _zero(REVENUE_TERMS[0])
    for c in REVENUE_TERMS[1:]:
        revenue = revenue + _zero(c)
    return revenue - deductions()


def ledger_filter(
    tx: DataFrame,
    start: dt.date | None,
    end: dt.date | None,
    country: str = "AU",
    ledger: int = 2,
    exclude_order_type: str | None = "0CT%",
) -> DataFrame:
    """Country, ledger, order-type exclusion, half-open date range.

    The range compares the DATE column to DATE literals (sargable), so it
    reaches the scan as a pushed filter.
    """
    cond = F.col("LAND1") == F.lit(country)
    if ledger is not None:
        cond = cond & (F.col("PALEDGER") == F.lit(ledger))
    if exclude_order_type is not None:
        cond = cond & ~F.col("AUART").like(exclude_order_type)
    if start is not None:
        cond = cond & (F.col("BUDAT") >= F.lit(start))
    if end is not None:
        cond = cond & (F.col("BUDAT") < F.lit(end))
    return tx.filter(cond)


def customer_key() -> Column:
    """P3: 'PEA' + client + '.' + company + '.' + customer (null-propagating)."""
    return F.concat(F.lit("PEA"), F.col("MANDT"), F.lit("."), F.col("BUKRS"), F.lit("."), F.col("KNDNR"))


def month_days(date: Column) -> Column:
    """Distinct dates within a month, by a bitmap of its days."""
    return F.coalesce(F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.dayofmonth(date)))), F.lit(0)).cast("bigint")


def _measures(material_codes: Sequence[tuple[str, str]], product_codes: Sequence[tuple[str, str]], detail: bool) -> list[Column]:
    rental = F.col("VVQ01_ME").isin(*RENTAL_UNITS)
    product = (F.col("VVQ01_ME") != "CMO") & (F.col("VVQ01_ME") != "CDA")
    sales = F.col("sales")
    period = F.col("WWRCP")
    m = [
        F.datediff(F.max("BUDAT"), F.min("BUDAT")).alias("DAY_BETWEEN_POSTING"),
        # a group's dates are of one month: the set of days is 31 bits, no distinct pass
        month_days(F.when(rental, F.col("BUDAT"))).alias("CNTD_RENTAL_POSTING_DATE"),
        month_days(F.col("BUDAT")).alias("CNTD_POSTING_DATE"),
        (F.count(F.lit(1)).alias("CNT_ALL") if detail else F.count("BUDAT").alias("CNT_POSTING_DATE")),
        # T-SQL AVG over INT truncates toward zero (T5)
        F.avg(F.datediff("FADAT", "WADAT")).cast("bigint").alias("AVG_DOCUMENT_ISSUE_DIFF"),
        F.avg(F.datediff("FADAT", "BUDAT")).cast("bigint").alias("AVG_POST_ISSUE_DIFF"),
        F.sum(F.when(F.col("VVQ01_ME") == "CDA", _zero("VVQ13")).otherwise(0)).alias("CCH"),
        F.sum(F.when(product, _zero("VVQ13")).otherwise(0)).alias("SALE_QTY"),
        F.sum(F.when(rental, _zero("VVQ01"))).alias("RENTAL_BILLED_QTY"),
        F.sum(F.when(product, sales)).alias("PRODUCT_SALES"),
        F.sum(F.when(rental, sales)).alias("RENTAL_SALES"),
        F.sum(F.when(product, F.col("VVR13"))).alias("DELIVERY"),
        F.count(F.when(period.like("D"), 1)).alias("DAILY_RENT"),
        F.count(F.when(period == "M", 1)).alias("MONTHLY_RENT"),
        F.count(F.when(period == "Q", 1)).alias("QUARTERLY_RENT"),
        F.count(F.when(period == "A", 1)).alias("ANNUAL_RENT"),
        F.count(F.when(~period.isin("A", "D", "M", "Q"), 1)).alias("Other_Rent_Period"),
        F.round(
            F.sum(
                F.when(sales == 0, F.lit(0.0)).otherwise(
                    deductions().cast("double") / sales.cast("double")
                )
            ),
            3,
        ).alias("DISCOUNT_RATIO"),
    ]
    m += [F.sum(F.when(F.col("MATKL") == code, sales)).alias(name) for code, name in material_codes]
    m += [F.sum(F.when(F.col("PRODH") == code, sales)).alias(name) for code, name in product_codes]
    return m


# Ledger column -> output column of the distinct counts and the maxima (the
# detail form has its own names for two of them, and the user as well).
COUNTED = [("ARTNR", "CNTD_MATERIAL"), ("MATKL", "MATERIAL_GROUP"), ("RPOSN", "REFERENCE_ITEMS"), ("KAUFN", "ORDER_NO")]
COUNTED_DETAIL = [("ARTNR", "CNTD_MATERIAL"), ("MATKL", "MATERIAL_GROUP"), ("RPOSN", "CNTD_REFERENCE_ITEMS"), ("KAUFN", "CNTD_ORDER_NO")]
MAXIMA = [("WWI06", "INDUSTRY"), ("WWI04", "INDUSTRY_SUBLEVEL"), ("VKORG", "PLANT"), ("PERDE", "POSTING_PERIOD")]
MAXIMA_DETAIL = [*MAXIMA, ("USNAM", "USERNAME")]
NO_KEY = "\0"  # stands for a null in a key, so that the two aggregates join on plain equality


def _values(base: DataFrame, keys: list[str], detail: bool, materials: bool) -> DataFrame:
    """The keys with the distinct counts, string maxima and, with ``materials``, the sorted
    list of materials."""
    counted, maxima = (COUNTED_DETAIL, MAXIMA_DETAIL) if detail else (COUNTED, MAXIMA)
    columns = [c for c, _ in [*counted, *maxima]]
    each = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(c).cast("string").alias("value")) for i, c in enumerate(columns)])
    values = (
        base.select(*keys, F.explode(each).alias("e")).select(*keys, "e.kind", "e.value")
        .where(F.col("value").isNotNull()).distinct()
    )
    of = lambda i: F.when(F.col("kind") == i, F.col("value"))
    out = [F.count_if(F.col("kind") == i).alias(name) for i, (_, name) in enumerate(counted)]
    # over distinct values of one key: as many as the attribute has; a hash aggregate, where max would sort
    out += [F.array_max(F.collect_set(of(i))).alias(name) for i, (_, name) in enumerate(maxima, len(counted))]
    if materials:
        out.append(F.array_join(F.array_sort(F.collect_set(of(0))), ", ").alias("MATERIAL_SET"))
    return values.groupBy(*keys).agg(*out)


def _rollup(base: DataFrame, keys: list[str], material_codes, product_codes, detail: bool, materials: bool) -> DataFrame:
    """One row per key (ledger columns, and ``POSTING_DATE``, the month)."""
    named = {f"_key{i}": F.date_format("BUDAT", "yyyy-MM") if k == "POSTING_DATE" else F.col(k).cast("string") for i, k in enumerate(keys)}
    base = base.select("*", *[F.coalesce(c, F.lit(NO_KEY)).alias(k) for k, c in named.items()])
    counted = COUNTED_DETAIL if detail else COUNTED
    measures = base.groupBy(*named).agg(*_measures(material_codes, product_codes, detail))
    values = _values(base, list(named), detail, materials)
    joined = measures.join(values.hint("merge"), list(named), "left")
    return joined.select(
        *[F.nullif(F.col(n), F.lit(NO_KEY)).alias(k) for n, k in zip(named, keys)],
        *[c for c in measures.columns if c not in named],
        *[F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for _, name in counted],
        *[c for c in values.columns if c not in named and c not in {name for _, name in counted}],
    )


def _in_order(columns: list[str], detail: bool) -> list[str]:
    """The reference's column order: counts and maxima before and between the measures."""
    counted, maxima = (COUNTED_DETAIL, MAXIMA_DETAIL) if detail else (COUNTED, MAXIMA)
    (c0, c1, c2, c3), names = [n for _, n in counted], [n for _, n in maxima]
    issue = columns.index("AVG_POST_ISSUE_DIFF") + 1
    start = columns.index("DAY_BETWEEN_POSTING")
    rest = [c for c in columns[issue:] if c not in (c0, c1, c2, c3, *names)]
    return ["POSTING_DATE", c0, c1, *names, *columns[start:issue], c2, c3, *rest]


def monthly_rollup(
    tx: DataFrame,
    start: dt.date | None,
    end: dt.date | None,
    keys: str = "customer",
    material_codes: Sequence[tuple[str, str]] = MATERIAL_GROUP_COLUMNS,
    product_codes: Sequence[tuple[str, str]] = PRODUCT_HIERARCHY_COLUMNS,
    detail: bool = False,
    materials: bool = False,
) -> DataFrame:
    """A1/A2/A3: one row per customer (or customer x ship-to) and month.

    ``keys='customer'``: composite customer number, SHIP_TO '0' (A1).
    ``keys='shipto'``: raw customer and ship-to, no prefix, no product
    hierarchies (A2).
    ``detail=True``: adds MAX(USNAM) and COUNT(*) with the detail names (A3);
    ``materials=True``: and the list of materials as the last column (A23).
    """
    base = ledger_filter(tx, start, end).withColumn("sales", net_sales())
    if keys == "customer":
        rows = _rollup(base, ["KNDNR", "MANDT", "BUKRS", "POSTING_DATE"], material_codes, product_codes, detail, materials)
        head = [customer_key().alias("CUSTOMER_NUMBER")]
        if not detail:
            head.append(F.lit("0").alias("SHIP_TO"))
    elif keys == "shipto":
        product_codes = ()  # this form ends with the material groups
        rows = _rollup(base, ["KNDNR", "KUNWE", "POSTING_DATE"], material_codes, product_codes, detail, materials)
        head = [F.col("KNDNR").alias("CUSTOMER_NUMBER"), F.col("KUNWE").alias("SHIP_TO")]
    else:
        raise ValueError(keys)
    return rows.select(*head, *_in_order(rows.columns, detail))


def material_set(
    tx: DataFrame,
    start: dt.date | None,
    end: dt.date | None,
    material_codes: Sequence[tuple[str, str]] = MATERIAL_GROUP_COLUMNS,
    product_codes: Sequence[tuple[str, str]] = PRODUCT_HIERARCHY_COLUMNS,
) -> DataFrame:
    """A3 + A21 + A23 + J5/J6: detail rollup with the month's distinct
    materials as one ', '-separated, sorted string.

    The reference builds the string with a correlated FOR XML subquery; here
    the materials are one of the kinds of values that the rollup
    de-duplicates anyway, so the list needs no scan and no join of its own.
    The trailing-separator trim is the intent (a clean list), see T7.
    """
    return monthly_rollup(tx, start, end, "customer", material_codes, product_codes, detail=True, materials=True)
