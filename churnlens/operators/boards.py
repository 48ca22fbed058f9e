"""Status dashboards, action labels and present value (A31-A33, W12, W13,
F15, F16, J18, J20, P18, P19, X13)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.functions.quantiles import exact_quantiles

CUST = "CUSTOMER_SHIPTO"
MONTH = "POSTING_DATE"
STATUS = "RISK_STATUS"


def action_labels(panel: DataFrame, have_action: DataFrame, no_action: DataFrame,
                  id_col: str = "SAPCustomerNumber__c") -> DataFrame:
    """action = 1 for customers on the action list, 0 for customers on
    the no-action list (which wins), rows without a label dropped. Both lists
    are de-duplicated ids; the joins are by key, never a collect."""
    yes = have_action.select(F.col(id_col).alias(CUST)).distinct().withColumn("_yes", F.lit(True))
    no = no_action.select(F.col(id_col).alias(CUST)).distinct().withColumn("_no", F.lit(True))
    df = panel.join(yes.hint("merge"), CUST, "left").join(no.hint("merge"), CUST, "left")
    action = F.when(F.col("_no"), F.lit(0)).when(F.col("_yes"), F.lit(1))
    return df.withColumn("action", action).filter(F.col("action").isNotNull()).drop("_yes", "_no")


def status_of(scores: DataFrame, actions: DataFrame | None = None, score_col: str = "risk_score",
              risk_above: float = 65, growth_below: float = 45) -> DataFrame:
    """A customer's status from its score and action flag:
    risk_check (risk and actioned), risk_uncheck (risk otherwise), growth."""
    df = scores.select(CUST, score_col)
    if actions is not None:
        df = df.join(actions.select(CUST, "action").distinct().hint("merge"), CUST, "left")
    else:
        df = df.withColumn("action", F.lit(None).cast("int"))
    s = F.col(score_col)
    status = (
        F.when((s > risk_above) & (F.col("action") == 1), "risk_check")
        .when(s > risk_above, "risk_uncheck")
        .when(s < growth_below, "growth")
    )
    return df.select(
        CUST,
        status.alias(STATUS),
        F.when(status == "risk_check", 1).otherwise(0).alias("RISK_CHECK"),
        F.when(status == "growth", 1).otherwise(0).alias("GROWTH"),
        F.when(status == "risk_uncheck", 1).otherwise(0).alias("RISK_UNCHECK"),
    )


def status_table(panel: DataFrame, status: DataFrame) -> DataFrame:
    """The dashboards' table: panel rows with their customer's status."""
    return panel.join(status.hint("merge"), CUST, "left")


def _not_growth(df: DataFrame) -> DataFrame:
    """Exclude the 'growth' member, keep null statuses."""
    return df.filter(~F.col(STATUS).eqNullSafe("growth"))


def _last_months(df: DataFrame, as_of: dt.date, months: int) -> DataFrame:
    """Relative-month filter, first period -(months-1), future included."""
    start = F.add_months(F.trunc(F.lit(as_of), "MM"), -(months - 1))
    return df.filter(F.col(MONTH).isNotNull() & (F.col(MONTH) >= start))


def status_countd(table: DataFrame) -> DataFrame:
    """Distinct customers per status (growth excluded)."""
    return _not_growth(table).groupBy(STATUS).agg(F.count_distinct(CUST).alias("customers"))


def _average(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    return df.groupBy(F.trunc(MONTH, "MM").alias(MONTH), STATUS).agg(*[F.avg(m).alias(f"avg_{m.lower()}") for m in measures])


def status_avg(table: DataFrame, as_of: dt.date, months: int = 12) -> DataFrame:
    """Average product sales, CCH and deliveries by month and status over
    the last ``months`` months, growth excluded."""
    return _average(_last_months(_not_growth(table), as_of, months), ["PRODUCT_SALES", "CCH", "DELIVERY"])


def status_rental_avg(table: DataFrame) -> DataFrame:
    """Average rental sales by month and status, growth excluded, over
    all months (this sheet has no date filter)."""
    return _average(_not_growth(table), ["RENTAL_SALES"])


def pct_diff(value: Column, base: Column) -> Column:
    """Percent difference from the base ((v - base) / |base|)."""
    return F.try_divide(value - base, F.abs(base))


def _first(value: str) -> Column:
    """The status's value in its first month: the base of every comparison."""
    w = Window.partitionBy(STATUS).orderBy(MONTH).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.first(value).over(w)


def _base(value: str, offset: int | None) -> Column:
    """The value of the status's first month, or of ``offset`` (-2: two) months
    earlier in the view."""
    if offset is None:
        return _first(value)
    return F.lag(value, -offset).over(Window.partitionBy(STATUS).orderBy(MONTH))


def _compounded(value: str, offset: int | None = None) -> Column:
    """Growth a period since the base: (v / first)^(1 / (k - 1)) - 1 for the k-th
    month; with an offset, over as many periods as it has."""
    k = F.row_number().over(Window.partitionBy(STATUS).orderBy(MONTH))
    ratio = F.try_divide(F.col(value), _base(value, offset))
    periods = k - 1 if offset is None else F.lit(-offset)
    return F.when((k > 1) & (ratio > 0), F.pow(ratio, F.lit(1.0) / periods) - 1)


def _median(df: DataFrame, value: str) -> DataFrame:
    q = exact_quantiles(df.withColumn(MONTH, F.trunc(MONTH, "MM")), [MONTH, STATUS], F.col(value), [0.5])
    return q.select(MONTH, STATUS, F.col("q")[0].alias(f"median_{value.lower()}"))


def status_median_pct(table: DataFrame, as_of: dt.date, months: int = 16) -> DataFrame:
    """A33 + W12: exact median CCH by (month, status) over the last ``months``
    months, growth excluded, and its percent difference from the status's
    first month."""
    med = _median(_last_months(_not_growth(table), as_of, months), "CCH")
    return med.withColumn("pct_diff", pct_diff(F.col("median_cch"), _first("median_cch")))


def status_median_growth(table: DataFrame, as_of: dt.date, months: int = 12) -> DataFrame:
    """Compound growth of the exact median CCH over the last ``months``
    months, growth excluded."""
    med = _median(_last_months(_not_growth(table), as_of, months), "CCH")
    return med.withColumn("compound_growth", _compounded("median_cch"))


def status_sales_pct(table: DataFrame, as_of: dt.date, months: int = 12) -> DataFrame:
    """Average product sales by month and status, their percent
    difference from the status's first month, and the average holidays (the
    size mark); last ``months`` months, growth excluded."""
    avg = _average(_last_months(_not_growth(table), as_of, months), ["PRODUCT_SALES", "Holidays"])
    return avg.withColumn("pct_diff", pct_diff(F.col("avg_product_sales"), _first("avg_product_sales")))


def blend(primary: DataFrame, secondary: DataFrame, link: list[str], measures: dict[str, Column]) -> DataFrame:
    """Data blending: the secondary source aggregated to the link
    fields, then left-joined to the primary view (primary rows are kept)."""
    agg = secondary.groupBy(*link).agg(*[c.alias(n) for n, c in measures.items()])
    return primary.join(agg, link, "left")


def status_blend(table: DataFrame, scores: DataFrame, as_of: dt.date, months: int = 16,
                 score_col: str = "At_Risk_Score__c") -> DataFrame:
    """Sheet with MEDIAN CCH by (month, status) blended with the secondary
    status source's average score on the month link."""
    primary = status_median_pct(table, as_of, months)
    secondary = _last_months(table.join(scores.select(CUST, score_col).hint("merge"), CUST, "inner"), as_of, months)
    return blend(primary, secondary, [MONTH], {"avg_score": F.avg(score_col)})


def status_growth(table: DataFrame, offset: int | None = None) -> DataFrame:
    """Compound monthly growth of average CCH, growth excluded, against the first
    month or (T14) the month ``offset`` before."""
    return _average(_not_growth(table), ["CCH"]).withColumn("compound_growth", _compounded("avg_cch", offset))


def score_bins(scores: DataFrame, score_col: str = "risk_score", size: int = 10) -> DataFrame:
    """F16: numeric bins of width ``size`` pegged at 0, with counts."""
    b = (F.floor(F.col(score_col) / size) * size).cast("bigint")
    return scores.groupBy(b.alias("score_bin")).agg(F.count(F.lit(1)).alias("customers"))


def rental_type(panel: DataFrame) -> DataFrame:
    """'Daily' / 'Monthly' / 'Others' rental type per row, counted."""
    t = F.when(F.col("DAILY_RENT") > 0, "Daily").when(F.col("MONTHLY_RENT") > 0, "Monthly").otherwise("Others")
    return panel.groupBy(t.alias("rental_type")).agg(F.count(F.lit(1)).alias("rows"))


def customer_pv(revenue: Column, growth: Column, discount: Column | float, max_growth: float = 1.5,
                min_growth: float = -0.7, loss_probability: float = 0.1, horizon: int = 12) -> Column:
    """Present value of a revenue stream growing at a clamped rate over
    ``horizon`` periods; declining streams also carry a loss probability."""
    d = discount if isinstance(discount, Column) else F.lit(float(discount))
    g = F.greatest(F.least(growth, F.lit(max_growth)), F.lit(min_growth))
    q = F.when(g >= 0, F.lit(1.0) + g).otherwise((F.lit(1.0) + g) * F.lit(1.0 - loss_probability))
    rev = revenue.cast("double")
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(horizon)),
        F.lit(0.0),
        lambda acc, t: acc + rev * F.pow(q, t) / F.pow(F.lit(1.0) + d, t),
    )


def pv_table(panel: DataFrame, as_of: dt.date, discount: float = 0.1) -> DataFrame:
    """Per customer: revenue of the last 12 months before ``as_of`` and its
    growth against the 12 months before, valued with ``customer_pv``."""
    end = F.trunc(F.lit(as_of), "MM")
    rev = F.col("PRODUCT_SALES") + F.col("RENTAL_SALES")
    last = (F.col(MONTH) >= F.add_months(end, -12)) & (F.col(MONTH) < end)
    prev = (F.col(MONTH) >= F.add_months(end, -24)) & (F.col(MONTH) < F.add_months(end, -12))
    agg = panel.groupBy(CUST).agg(
        F.sum(F.when(last, rev).otherwise(0.0)).alias("revenue_0"),
        F.sum(F.when(prev, rev).otherwise(0.0)).alias("revenue_prev"),
    )
    growth = F.coalesce(F.try_divide(F.col("revenue_0") - F.col("revenue_prev"), F.col("revenue_prev")), F.lit(0.0))
    return agg.withColumn("growth_rate", growth).withColumn(
        "pv", customer_pv(F.col("revenue_0"), F.col("growth_rate"), discount)
    )
