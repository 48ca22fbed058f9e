"""Next-best-action snapshots.

Every snapshot anchor T0 defines month offsets T_i = T0 - i months. All
anchors run in ONE job. The anchors are parameters, so the outermost bounds of
a window over all of them are literals that reach the scan; what is left of a
fact row is repeated, inside generated code, for the anchors whose windows
contain it, and every aggregate is keyed by (SNAPSHOT, ...). The final table
goes to ``sources.snapshots.SnapshotTable``, a partition per anchor.

Distinct counts are cascades of hash aggregates: first one row per (group,
value), with the conditions as flags, then a sum of flags. A value leaves a task
once, a hot group spreads by its values, and no row is copied for each count. What
depends on the month only (items) is counted once per month, before the rows are
repeated for the overlapping windows of the anchors.

The rows between the outermost bounds are read from the sources once and staged: several
aggregates read them, and their number gives the parts of the items' hash tables. Tables
that grow with the facts are merged, not broadcast: through the driver goes none of them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.operators.rollup import DEDUCTION_TERMS, NO_KEY, REVENUE_TERMS, month_days, net_sales
from churnlens.sources.stage import stage

SNAP = "SNAPSHOT"
ROWS_PER_TASK = 50_000  # items: a task has a hash table of all their values


def T(i: int) -> Column:
    """Month offset T_i of the row's anchor."""
    return F.add_months(F.col(SNAP), -i)


@dataclass
class DeliveryCodes:
    """Code lists of the delivery profile."""

    # Transport groups, delivery types and customer groups.
    dangerous: Sequence[str] = ("0C21", "0C09", "0C15", "0C11", "0C12", "0C18", "0C08",
                                "0C20", "0C13", "0C17", "0C10", "0C14", "0C16", "0C19")
    general: Sequence[str] = ("0C03", "0C06", "0C05", "0C07", "0C01", "0C04", "0C02")
    air: Sequence[str] = ("0C09", "0C08", "0C10", "0C06", "0C04")
    sea: Sequence[str] = ("0C20", "0C19", "0C05", "0C02")
    waterway: Sequence[str] = ("0C13", "0C17", "0C14")
    debit: Sequence[str] = ("0CD1", "0CD2", "0CD3", "0CD4")
    consignment: Sequence[str] = ("0CK1", "0CK2", "0CK3", "0CK4")
    standard: Sequence[str] = ("0CN1", "0CN2", "0CN3", "0CN4")
    thirdparty: Sequence[str] = ("0CB1", "0CB2", "0CB3", "0CB4")
    kdgrp_d0: str = "D0"
    kdgrp_gf: str = "GF"


@dataclass
class Windows:
    """Month windows as (from T_a, to T_b) meaning T_a <= date < T_b."""

    mapping: tuple[int, int] = (6, 0)
    customer: tuple[int, int] = (18, 12)
    history: tuple[int, int] = (18, 6)
    new: tuple[int, int] = (6, 0)
    offsets: Sequence[int] = field(default_factory=lambda: list(range(7, 13)))


def month_shift(month: dt.date, k: int) -> dt.date:
    """The first day of the month ``k`` months later."""
    n = month.year * 12 + month.month - 1 + k
    return dt.date(n // 12, n % 12 + 1, 1)


def _spans(anchors: Sequence[dt.date], win: tuple[int, int]) -> list[tuple[dt.date, dt.date, dt.date]]:
    """Each anchor's month with its window's bounds, first days of months."""
    months = sorted({a.replace(day=1) for a in anchors})
    return [(a, month_shift(a, -win[0]), month_shift(a, -win[1])) for a in months]


def _near(df: DataFrame, anchors: Sequence[dt.date], date_col: str, win: tuple[int, int]) -> DataFrame:
    """Rows of ``df`` between the outermost bounds of the anchors' windows."""
    day, spans = F.col(date_col), _spans(anchors, win)
    return df.where((day >= F.lit(min(lo for _, lo, _ in spans))) & (day < F.lit(max(hi for _, _, hi in spans))))


def _per_anchor(df: DataFrame, anchors: Sequence[dt.date], date_col: str, win: tuple[int, int]) -> DataFrame:
    """Rows of ``df`` repeated for each anchor (a month) whose window contains
    them: T_a <= date < T_b. ``date_col`` may be a day or the first of a month."""
    day = F.col(date_col)
    inside = F.array(*[F.when((day >= F.lit(lo)) & (day < F.lit(hi)), F.lit(a)) for a, lo, hi in _spans(anchors, win)])
    return _near(df, anchors, date_col, win).select("*", F.explode(F.array_compact(inside)).alias(SNAP))


def near_items(items: DataFrame, anchors: Sequence[dt.date], w: Windows = Windows()) -> DataFrame:
    """The items between the outermost bounds of all windows, staged."""
    return stage(_near(items, anchors, "ERDAT", _outermost(w.history, w.new)), "items")


def _outermost(*wins: tuple[int, int]) -> tuple[int, int]:
    return max(a for a, _ in wins), min(b for _, b in wins)


def customer_shiptos(tx: DataFrame, anchors: Sequence[dt.date], w: Windows = Windows(),
                     shipto_col: str = "KUNWE", country: str = "AU") -> DataFrame:
    """(SNAPSHOT, KNDNR, KUNWE): the ship-tos a customer bought for in the window."""
    return (
        _per_anchor(tx.filter(F.col("LAND1") == country), anchors, "BUDAT", w.mapping)
        .select(SNAP, "KNDNR", F.col(shipto_col).alias("KUNWE"))
        .distinct()
    )


def shipto_deliveries(deliveries: DataFrame, anchors: Sequence[dt.date], w: Windows = Windows()) -> DataFrame:
    """(SNAPSHOT, VBELN, KUNNR): the deliveries to a ship-to in the window."""
    return _per_anchor(deliveries, anchors, "LDDAT", w.mapping).select(SNAP, "VBELN", "KUNNR").distinct()


def mapping(tx: DataFrame, deliveries: DataFrame, anchors: Sequence[dt.date], w: Windows = Windows(),
            shipto_col: str = "KUNWE", country: str = "AU") -> DataFrame:
    """(customer, ship-to, delivery) triples active in the window.

    The GROUP BY over the join equals the join of the two de-duplicated
    sides, so both sides are reduced to distinct keys before the join.
    """
    left = customer_shiptos(tx, anchors, w, shipto_col, country)
    right = shipto_deliveries(deliveries, anchors, w)
    return left.join(right.hint("merge"), (left[SNAP] == right[SNAP]) & (right["KUNNR"] == left["KUNWE"])).select(
        left[SNAP], "KNDNR", "KUNWE", "VBELN", "KUNNR"
    )


def customer_table(tx: DataFrame, mapping_df: DataFrame, anchors: Sequence[dt.date], w: Windows = Windows(),
                   country: str = "AU") -> DataFrame:
    """J2 + A17: CCH and product sales of mapped customers, overall and for
    the month offsets (T15: with the default windows these months lie outside
    the history window and stay 0 / null, as written)."""
    base = _per_anchor(tx.filter(F.col("LAND1") == country), anchors, "BUDAT", w.customer).join(
        mapping_df.select(SNAP, "KNDNR").distinct().hint("merge"), [SNAP, "KNDNR"], "left_semi"
    )
    cda = F.col("VVQ01_ME") == "CDA"
    product = (F.col("VVQ01_ME") != "CMO") & (F.col("VVQ01_ME") != "CDA")
    month = F.trunc("BUDAT", "MM")
    qty = F.coalesce(F.col("VVQ13"), F.lit(0))
    aggs = [F.sum(F.when(cda, qty).otherwise(0)).alias("CCH")]
    aggs += [F.sum(F.when(cda & (month == T(k)), qty).otherwise(0)).alias(f"T_{i}_CCH") for i, k in enumerate(w.offsets, 1)]
    aggs += [F.sum(F.when(product, net_sales())).alias("PRODUCT_SALES")]
    aggs += [F.sum(F.when(product & (month == T(k)), net_sales())).alias(f"T_{i}_PRODUCT_SALES") for i, k in enumerate(w.offsets, 1)]
    return base.groupBy(SNAP, "KNDNR").agg(*aggs)


def delivery_gaps(d: DataFrame, w: Windows = Windows()) -> DataFrame:
    """W9 + A15 without a window over a ship-to's deliveries.

    The days between consecutive deliveries (first -> 0) telescope: their
    sum is last - first, so the average is (max - min) / count. The distinct
    gaps of a month only depend on the ship-to's distinct delivery dates
    (bounded by the calendar, whatever the delivery volume): the first
    delivery of a date has gap = date - previous date, any further delivery
    on the same date has gap 0. T-SQL AVG of INT truncates (T5).
    """
    overall = d.groupBy(SNAP, "KUNNR").agg(
        F.floor(F.datediff(F.max("LDDAT"), F.min("LDDAT")) / F.count(F.lit(1))).cast("bigint").alias("AVG_TIME_DELIVERY")
    )
    dates = d.groupBy(SNAP, "KUNNR", "LDDAT").agg(F.count(F.lit(1)).alias("_n"))
    win = Window.partitionBy(SNAP, "KUNNR").orderBy("LDDAT")
    dates = dates.withColumn("_gap", F.coalesce(F.datediff("LDDAT", F.lag("LDDAT").over(win)), F.lit(0)))
    gaps = dates.select(
        SNAP, "KUNNR", "LDDAT",
        F.explode(F.when(F.col("_n") > 1, F.array(F.col("_gap"), F.lit(0))).otherwise(F.array(F.col("_gap")))).alias("gap"),
    )
    distinct = gaps.select(SNAP, "KUNNR", F.trunc("LDDAT", "MM").alias("mth"), "gap").distinct()
    per_month = distinct.groupBy(SNAP, "KUNNR").agg(*[
        F.avg(F.when(F.col("mth") == T(k), F.col("gap"))).cast("bigint").alias(f"T_{i}_TIME_DELIVERY")
        for i, k in enumerate(w.offsets, 1)
    ])
    return overall.join(per_month.hint("merge"), [SNAP, "KUNNR"])


def delivery_profile(deliveries: DataFrame, anchors: Sequence[dt.date], w: Windows = Windows(),
                     codes: DeliveryCodes = DeliveryCodes()) -> DataFrame:
    """W9 + A15 + A16: per ship-to, days between deliveries and counts by
    transport group, delivery type and customer group."""
    d = _per_anchor(deliveries, anchors, "LDDAT", w.history)

    tr, lf, kd = F.col("TRAGR"), F.col("LFART"), F.col("KDGRP")
    flags = {
        "CNTD_DANGEROUS": tr.isin(*codes.dangerous),
        "CNTD_GENERAL": tr.isin(*codes.general),
        "CNTD_AIR": tr.isin(*codes.air),
        "CNTD_SEA": tr.isin(*codes.sea),
        "CNTD_WATERWAY": tr.isin(*codes.waterway),
        "CNTD_DEBIT_ITEMS": lf.isin(*codes.debit),
        "CNTD_CONSIGNMENT": lf.isin(*codes.consignment),
        "CNTD_STANDARD": lf.isin(*codes.standard),
        "CNTD_THIRDPARTY": lf.isin(*codes.thirdparty),
        "CNTD_D0_KDGRP": kd == codes.kdgrp_d0,
        "CNTD_NULL_KDGRP": kd.isNull(),
        "CNTD_GF_KDGRP": kd == codes.kdgrp_gf,
    }
    counts = _flagged(d, [SNAP, "KUNNR"], "VBELN", flags)
    routes = d.groupBy(SNAP, "KUNNR", "ROUTE").agg(F.lit(1).alias("_one")).groupBy(SNAP, "KUNNR").agg(F.count("ROUTE").alias("CNTD_ROUTE"))
    counts = routes.join(counts.hint("merge"), [SNAP, "KUNNR"])
    return delivery_gaps(d, w).join(counts.hint("merge"), [SNAP, "KUNNR"])


def _flagged(df: DataFrame, keys: list[str], value: str, flags: dict[str, Column]) -> DataFrame:
    """For each flag the number of distinct values of ``value`` in a group that have a row
    with it: first a row per (group, value) with the greatest of each flag, then sums."""
    known = F.col(value).isNotNull()
    one = df.groupBy(*keys, value).agg(*[F.max(F.when(known & c, 1).otherwise(0)).alias(name) for name, c in flags.items()])
    return one.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in flags])


def items_profile(items: DataFrame, anchors: Sequence[dt.date], w: Windows = Windows()) -> DataFrame:
    """A14 + A20: per delivery and month, then per delivery (AVG of monthly
    sums is not a plain AVG). AVG of counts truncates (T5). ``items`` are counted
    first, for the number of parts: give them staged (``near_items``)."""
    it = _near(items, anchors, "ERDAT", w.history).select(
        "*", F.coalesce("VBELN", F.lit(NO_KEY)).alias("_v"), F.trunc("ERDAT", "MM").alias("mth"))
    it = it.repartition(max(1, -(-it.count() // ROWS_PER_TASK)), "_v", "mth")
    mv, vg = F.col("MVGR1"), F.col("VGBEL")
    sums = it.groupBy("_v", "mth").agg(
        F.sum("LGMNG").alias("mth_stock_diff"),
        F.max("LGMNG").alias("mth_max_stock_diff"),
        F.min("LGMNG").alias("mth_min_stock_diff"),
        month_days(F.col("ERDAT")).alias("CNTD_MTH_DATES"),
        F.sum(F.when(F.col("GEWEI") == "KG", F.col("BRGEW"))).alias("SUM_MTH_VOL_KG"),
        F.sum(F.when(F.col("MEINS") == "CYL", F.col("LFIMG"))).alias("SUM_MTH_LFIMG_CYL"),
        F.sum(F.when(F.col("VOLEH") == "M3", F.col("VOLUM"))).alias("SUM_MTH_VOLUM_M3"),
        F.max(F.col("VBELN").isNotNull().cast("bigint")).alias("CNTD_SHIPTO"),  # the delivery itself
    )
    kinds = [(vg, mv), (F.col("MATNR"), F.lit(None).cast("string")), (F.col("MATKL"), F.lit(None).cast("string"))]
    values = it.select("_v", "mth", F.explode(F.array(*[
        F.struct(F.lit(i).alias("kind"), value.alias("value"), code.alias("mv")) for i, (value, code) in enumerate(kinds)])).alias("e")).select("_v", "mth", "e.*")
    entry, mv = F.col("kind") == 0, F.col("mv")
    counts = values.withColumn("value", F.when(F.col("value").isNotNull(), F.concat(F.col("kind").cast("string"), F.lit(":"), "value")))
    counts = _flagged(counts, ["_v", "mth"], "value", {
        "CNTD_NULL_DIFOT": entry & mv.isNull(),
        "CNTD_DIFOT": entry & mv.isNotNull(),
        "CNTD_Z08DIFOT": entry & (mv == "Z08"),
        "CNTD_Z01DIFOT": entry & (mv == "Z01"),
        "CNTD_P07DIFOT": entry & (mv == "P07"),
        "CNTD_MTH_ENTRIES": entry,
        "CNTD_MATNR": F.col("kind") == 1,
        "CNTD_MATKL": F.col("kind") == 2,
    })
    # a month's figures are the same for every anchor whose window has it
    whole = _per_anchor(sums.join(counts.hint("merge"), ["_v", "mth"]), anchors, "mth", w.history)
    monthly = whole.withColumn("VBELN", F.nullif(F.col("_v"), F.lit(NO_KEY))).drop("_v")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    ti = lambda c: F.avg(c).cast("bigint")
    return monthly.groupBy(SNAP, "VBELN").agg(
        F.avg("mth_stock_diff").alias("AVG_STOCK_DIFF"),
        F.max("mth_max_stock_diff").alias("MAX_STOCK_DIFF"),
        F.min("mth_min_stock_diff").alias("MIN_STOCK_DIFF"),
        F.sum("CNTD_NULL_DIFOT").alias("SUM_NULL_DIFOT"),
        F.sum("CNTD_DIFOT").alias("SUM_DIFOT"),
        F.sum("CNTD_Z08DIFOT").alias("SUM_Z08DIFOT"),
        ti("CNTD_NULL_DIFOT").alias("AVG_NULL_DIFOT"),
        ti("CNTD_DIFOT").alias("AVG_DIFOT"),
        ti("CNTD_Z08DIFOT").alias("AVG_Z08DIFOT"),
        ti("CNTD_Z01DIFOT").alias("AVG_Z01DIFOT"),
        ti("CNTD_P07DIFOT").alias("AVG_P07DIFOT"),
        ti("CNTD_MTH_DATES").alias("AVG_MTH_DATES"),
        ti("CNTD_MTH_ENTRIES").alias("AVG_MTH_ENTRIES"),
        F.sum(z("SUM_MTH_VOL_KG")).alias("SUM_MTH_VOL_KG"),
        F.sum(z("SUM_MTH_LFIMG_CYL")).alias("SUM_MTH_LFIMG_CYL"),
        F.sum(z("SUM_MTH_VOLUM_M3")).alias("SUM_MTH_VOLUM_M3"),
        F.sum(z("CNTD_MATNR")).alias("CNTD_MATNR"),
        F.sum(z("CNTD_MATKL")).alias("CNTD_MATKL"),
        F.avg(z("CNTD_MATNR")).cast("bigint").alias("AVG_MATNR"),
        F.avg(z("CNTD_MATKL")).cast("bigint").alias("AVG_MATKL"),
        F.sum(z("CNTD_SHIPTO")).alias("CNTD_SHIPTO"),
        *[
            F.sum(F.when(F.col("mth") == T(k), F.col("CNTD_MTH_ENTRIES")).otherwise(0)).alias(f"T_{i}_ENTRIES")
            for i, k in enumerate(w.offsets, 1)
        ],
    )


def new_items(items: DataFrame, anchors: Sequence[dt.date], w: Windows = Windows(),
              keys: Sequence[str] = ("VBELN", "MATNR", "MATKL", "VGBEL")) -> DataFrame:
    """J3 + A18: items of the new window with no matching item in the
    history window (NOT EXISTS -> left anti join; null keys survive), counted
    per delivery. ``keys=("VBELN", "MATNR")`` gives 'new to the delivery'."""
    new = _per_anchor(items, anchors, "ERDAT", w.new)
    old = _per_anchor(items, anchors, "ERDAT", w.history).select(SNAP, *keys).distinct()
    fresh = new.join(old.hint("merge"), [SNAP, *keys], "left_anti")
    kinds = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(c).alias("value")) for i, c in enumerate(("MATNR", "MATKL", "VGBEL"))])
    values = fresh.select(SNAP, "VBELN", F.explode(kinds).alias("e")).select(SNAP, "VBELN", "e.*").distinct()
    have = lambda i: F.count(F.when(F.col("kind") == i, F.col("value")))
    return values.groupBy(SNAP, "VBELN").agg(have(0).alias("NEW_MATNR"), have(1).alias("NEW_MATKL"), have(2).alias("NEW_ENTRIES"))


def snapshot(pairs: DataFrame, deliveries: DataFrame, new_df: DataFrame, profile_df: DataFrame, cust_df: DataFrame,
             items_df: DataFrame, offsets: Sequence[int] = range(7, 13), dedup: bool = False) -> DataFrame:
    """J4 + A19: the mapping left-joined to new items and inner-joined to the
    three profiles, then one row per customer and snapshot. Join keys are not
    unique on the mapping side, so sums count a customer's values once per
    mapped delivery (T9, as written). ``dedup=True`` counts a customer's value
    once and a ship-to's once for each of its customers.

    The mapping's rows are not made: deliveries and their items are first
    summed per ship-to (``_n``: how many mapping rows it stands for), and
    only (customer, ship-to) pairs are joined to those sums. A sum over
    mapping rows is then a sum over pairs, a value per customer or ship-to
    counts ``_n`` times, an average is sum over count.
    """
    n = len(list(offsets))
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    times = F.lit(1) if dedup else F.col("_n")  # mapping rows that a pair stands for
    total = lambda c: F.sum(F.col(c) * times)
    own = F.max if dedup else total  # a customer's value is the same in all its pairs
    new_cols = ["NEW_MATNR", "NEW_MATKL", "NEW_ENTRIES"]
    item_cols = ["CNTD_MATNR", "CNTD_MATKL", "CNTD_SHIPTO", *[f"T_{i}_ENTRIES" for i in range(1, n + 1)]]
    sums = (
        deliveries.join(new_df.hint("merge"), [SNAP, "VBELN"], "left").join(items_df.hint("merge"), [SNAP, "VBELN"], "inner")
        .groupBy(SNAP, "KUNNR").agg(
            F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(c) for c in new_cols], *[F.sum(z(c)).alias(c) for c in item_cols])
    )
    profile_cols = ["CNTD_DANGEROUS", "CNTD_GENERAL", "CNTD_AIR", "CNTD_SEA", "CNTD_WATERWAY", "CNTD_DEBIT_ITEMS",
                    "CNTD_CONSIGNMENT", "CNTD_STANDARD", "CNTD_THIRDPARTY", "CNTD_D0_KDGRP", "CNTD_NULL_KDGRP",
                    "CNTD_GF_KDGRP"]
    per_shipto = sums.join(profile_df.select(SNAP, "KUNNR", "AVG_TIME_DELIVERY", *profile_cols).hint("merge"), [SNAP, "KUNNR"], "inner")
    j = pairs.withColumnRenamed("KUNWE", "KUNNR").join(per_shipto.hint("merge"), [SNAP, "KUNNR"], "inner")
    j = j.join(cust_df.hint("merge"), [SNAP, "KNDNR"], "inner")
    rows = F.sum("_n")
    # a customer's own values are the same in all its rows: their average is the value
    cust_cols = ["CCH", *[f"T_{i}_CCH" for i in range(1, n + 1)]]
    sale_cols = [f"T_{i}_PRODUCT_SALES" for i in range(1, n + 1)]
    aggs = [x for c in cust_cols for x in (own(c).alias(c), F.max(c).alias(f"AVG_{c}"))]
    aggs += [own("PRODUCT_SALES").alias("PRODUCT_SALES")]
    aggs += [x for c in sale_cols for x in (own(c).alias(c), F.max(c).alias(f"AVG_{c}"))]
    aggs += [F.sum(c).alias(c) for c in new_cols]
    aggs += [total(c).alias(c) for c in profile_cols]
    aggs += [
        (F.sum(F.col("AVG_TIME_DELIVERY") * times) / F.sum(times)).cast("bigint").alias("TIME_DELIVERY"),
        F.sum("CNTD_MATNR").alias("CNTD_MATNR"),
        F.sum("CNTD_MATKL").alias("CNTD_MATKL"),
        (F.sum("CNTD_MATNR") / rows).cast("bigint").alias("AVG_MATNR"),
        (F.sum("CNTD_MATKL") / rows).cast("bigint").alias("AVG_MATKL"),
        F.sum("CNTD_SHIPTO").alias("CNTD_SHIPTO"),
    ]
    aggs += [F.sum(f"T_{i}_ENTRIES").alias(f"T_{i}_ENTRIES") for i in range(1, n + 1)]
    return j.groupBy(SNAP, F.col("KNDNR").alias("CUSTOMER_NUMBER")).agg(*aggs)


def nba_snapshot(tx: DataFrame, deliveries: DataFrame, items: DataFrame, anchors: Sequence[dt.date],
                 w: Windows = Windows(), codes: DeliveryCodes = DeliveryCodes(), shipto_col: str = "KUNWE",
                 dedup: bool = False) -> DataFrame:
    """All snapshot anchors in one job, over the staged rows of their windows."""
    used = dict.fromkeys(["LAND1", "BUDAT", "KNDNR", shipto_col, "VVQ01_ME", "VVQ13", *REVENUE_TERMS, *DEDUCTION_TERMS])
    tx = stage(_near(tx, anchors, "BUDAT", _outermost(w.mapping, w.customer)).select(*used), "ledger")
    deliveries = stage(_near(deliveries, anchors, "LDDAT", _outermost(w.mapping, w.history)), "deliveries")
    items = near_items(items, anchors, w)
    pairs = customer_shiptos(tx, anchors, w, shipto_col)
    sent = shipto_deliveries(deliveries, anchors, w)
    mapped = pairs.join(sent.select(SNAP, F.col("KUNNR").alias("KUNWE")).distinct().hint("merge"), [SNAP, "KUNWE"], "left_semi")
    return snapshot(
        pairs,
        sent,
        new_items(items, anchors, w),
        delivery_profile(deliveries, anchors, w, codes),
        customer_table(tx, mapped, anchors, w),
        items_profile(items, anchors, w),
        w.offsets,
        dedup,
    )


def purchase_label(snap: DataFrame) -> DataFrame:
    """F18 + D5: purchase = 1 when new materials were bought (x > 0; null -> 0)."""
    return snap.withColumn("purchase", F.when(F.col("NEW_MATNR") > 0, 1).otherwise(0))
