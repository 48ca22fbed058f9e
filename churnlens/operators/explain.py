"""Attribution of a customer's predicted CCH to readable drivers (M10, M11,
M17, F8, A30, P13, O2, D6, F9, J19).

Occlusion attribution: for every explained customer and feature j, the
feature is replaced by its background mean and the model is re-scored;
contribution_j = f(x) - f(x with x_j := mean). All variants of all
customers are scored in one ``transform``. Variable names are mapped to
driver names by an ordered chain of regex replacements (applied twice),
joined as a small broadcast table (one row per model feature).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlens.operators.ml import VARIABLES, clean_numeric

CUST = "CUSTOMER_SHIPTO"

# Ordered (pattern, replacement) chain from feature names to
# driver names. A repeated key keeps its first position and its last value.
DRIVER_RULES = [
    (r"period_\d+_", ""),
    (r"_lag_\d", ""),
    (r"_shift_\d", ""),
    (r"Smoothed_Holidays", "Holidays"),
    (r"cv2", "Cyclicality"),
    (r"_\d", ""),
    (r"sample_mean", "Trend"),
    (r"ROLL_MEAN", "CCH"),
    (r"CCH", "CCH"),
    (r"uncertainty", "Irregularity"),
    (r"upper_bound", "Irregularity"),
    (r"lower_bound", "Irregularity"),
    (r"DISCOUNT_RATIO", "Discount"),
    (r"CNTD_RENTAL_POSTING_DATE", "Rental_Freq"),
    (r"CNTD_POSTING_DATE", "Posting_Freq"),
    (r"CNT_POSTING_DATE", "Interactions"),
    (r"PROD_LRGLG_SALE", "Product_Type"),
    (r"PROD_5MEDLE_SALE", "Product_Type"),
    (r"PROD_1MEDLE_SALE", "Product_Type"),
    (r"PROD_SMLLD_SALE", "Product_Type"),
    (r"PROD_4MEDLE2_SALE", "Product_Type"),
    (r"PROD_8LRGLG_SALE", "Product_Type"),
    (r"MATERIAL_020112_SALE", "Product_Type"),
    (r"MATERIAL_050299_SALE", "Product_Type"),
    (r"MATERIAL_020110_SALE", "Product_Type"),
    (r"MATERIAL_020104_SALE", "Product_Type"),
    (r"MATERIAL_111899_SALE", "Product_Type"),
    (r"MATERIAL_051299_SALE", "Product_Type"),
    (r"PROD_SMLLD2_SALE", "Product_Type"),
    (r"PRODLRGLG_SALE", "Product_Type"),
    (r"PRODMEDLE2_SALE", "Product_Type"),
    (r"MATERIAL50299_SALE", "Product_Type"),
    (r"MATERIAL20110_SALE", "Product_Type"),
    (r"MATERIAL51299_SALE", "Product_Type"),
    (r"MATERIAL20104_SALE", "Product_Type"),
    (r"MATERIAL11899_SALE", "Product_Type"),
    (r"MATERIAL20112_SALE", "Product_Type"),
    (r"RENTAL_BILLED_QTY", "Rental"),
    (r"less12", "lesser_data"),
    (r"PRODMEDLE_SALE", "Product_Type"),
    (r"KSD", "Missed_Purchases"),
    (r"KS_filtered", "Missed_Purchases"),
    (r"DELIVERY", "Delivery"),
    (r"RENTAL_SALES", "Rental"),
    (r"DAILY_RENT", "Rent_Collect_Period"),
    (r"MONTHLY_RENT", "Rent_Collect_Period"),
    (r"QUARTERLY_RENT", "Rent_Collect_Period"),
    (r"ANNUAL_RENT", "Rent_Collection_Freq"),
    (r"Other_Rent_Period", "Rent_Collect_Period"),
    (r"REFERENCE_ITEMS", "Interactions"),
    (r"POSTING_PERIOD", "Interactions"),
    (r"DAY_BETWEEN_POSTING", "Interactions"),
    (r"AVG_DOCUMENT_ISSUE_DIFF", "Delays"),
    (r"AVG_POST_ISSUE_DIFF", "Delays"),
    (r"PRODUCT_SALES", "Sales"),
    (r"SALE_QTY", "Sales"),
]
# Drivers left out of the sentence (regex search).
EXCLUDED_DRIVERS = '^$|intercept|Trend|Uncertainty|Holidays|""'


def driver_name(c: Column, passes: int = 2) -> Column:
    """F8: fold of regexp_replace over the ordered rules, ``passes`` times."""
    for _ in range(passes):
        for pat, rep in DRIVER_RULES:
            c = F.regexp_replace(c, pat, rep)
    return c


def driver_table(spark: SparkSession, variables: Sequence[str] = VARIABLES) -> DataFrame:
    """One row per model feature with its driver name (bounded by the model)."""
    df = spark.createDataFrame([(v,) for v in variables], "variable string")
    return df.withColumn("driver", driver_name(F.col("variable")))


def background_means(train: DataFrame, variables: Sequence[str] = VARIABLES) -> DataFrame:
    """The mean of every feature over all training rows: one row. (The
    reference averages a sample of 5000 rows; the mean needs none.)"""
    return clean_numeric(train, variables).agg(*[F.avg(v).alias(v) for v in variables])


def background_sample(train: DataFrame, n: int, key: Sequence[str] = (CUST, "POSTING_DATE"), seed: int = 42) -> DataFrame:
    """O3: a repeatable sample of ``n`` rows, by a seeded hash of the key."""
    return train.orderBy(F.xxhash64(*[F.col(k) for k in key], F.lit(seed)), *key).limit(n)


def occlusion(model, rows: DataFrame, means: DataFrame, variables: Sequence[str] = VARIABLES,
              prediction: str = "pred3") -> DataFrame:
    """(customer, variable, contribution) for every explained row."""
    data = clean_numeric(rows.select(CUST, *variables), variables)
    bg = means.select(*[F.col(v).alias(f"_m_{v}") for v in variables]).withColumn("_one", F.lit(1))
    data = data.withColumn("_one", F.lit(1)).join(F.broadcast(bg), "_one").drop("_one")
    k = F.explode(F.sequence(F.lit(0), F.lit(len(variables)))).alias("_j")
    variants = data.select("*", k).select(
        CUST,
        "_j",
        *[F.when(F.col("_j") == i + 1, F.col(f"_m_{v}")).otherwise(F.col(v)).alias(v) for i, v in enumerate(variables)],
    )
    scored = model.transform(variants).select(CUST, "_j", F.col(prediction).alias("_p"))
    w = Window.partitionBy(CUST)
    full = F.max(F.when(F.col("_j") == 0, F.col("_p"))).over(w)
    names = F.array(*[F.lit(v) for v in variables])
    return (
        scored.select(CUST, "_j", "_p", full.alias("_full"))
        .filter(F.col("_j") > 0)
        .select(CUST, F.element_at(names, F.col("_j")).alias("variable"), (F.col("_full") - F.col("_p")).alias("contribution"))
    )


def top_drivers(contrib: DataFrame, drivers: DataFrame, k: int = 3) -> DataFrame:
    """A30 + P13 + O2 + F9: |signed sum| per driver, excluded drivers
    removed, top ``k`` (ties by name), one sentence per customer."""
    g = (
        contrib.join(F.broadcast(drivers), "variable")
        .groupBy(CUST, F.col("driver").alias("variable_name"))
        .agg(F.abs(F.sum("contribution")).alias("contribution"))
        .filter(~F.col("variable_name").rlike(EXCLUDED_DRIVERS))
    )
    w = Window.partitionBy(CUST).orderBy(F.col("contribution").desc(), F.col("variable_name"))
    top = g.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    names = top.groupBy(CUST).agg(F.array_sort(F.collect_list(F.struct("rank", "variable_name"))).alias("t")).select(
        CUST, F.transform("t", lambda e: e["variable_name"]).alias("names")
    )
    n = F.size("names")
    listing = (
        F.when(n >= 2, F.concat(F.array_join(F.slice("names", 1, n - 1), ", "), F.lit(", and "), F.element_at("names", -1)))
        .otherwise(F.element_at("names", 1))
    )
    return names.select(CUST, F.concat(F.lit("This is due to "), listing, F.lit(". ")).alias("explainer"))


def explain_risk(model, fit_rows: DataFrame, risk: DataFrame, means: DataFrame, drivers: DataFrame,
                 variables: Sequence[str] = VARIABLES) -> DataFrame:
    """J17 + D6 + J19: explain customers on the risk list (max_cch >= 0,
    else empty), then append the sentence to their risk text."""
    rows = fit_rows.join(risk.select(CUST).hint("merge"), CUST, "left_semi")
    ex = top_drivers(occlusion(model, rows.filter(F.col("max_cch") >= 0), means, variables), drivers)
    out = risk.join(ex.hint("merge"), CUST, "left").withColumn("explainer", F.coalesce("explainer", F.lit("")))
    return out.select(CUST, "risk_score", F.concat_ws(" ", "risk_value", "explainer").alias("risk_value"), "explainer")


def driver_global(contrib: DataFrame, drivers: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature over explained customers."""
    return contrib.join(F.broadcast(drivers), "variable").groupBy("variable", "driver").agg(
        F.avg(F.abs("contribution")).alias("mean_abs_contribution"), F.count(F.lit(1)).alias("n")
    )


def feature_attribution(model, rows: DataFrame, features: Sequence[str], score: Column, block: int = 4) -> DataFrame:
    """Variable, mean_abs_contribution, mean_contribution, n over *all* rows: what each
    feature adds to a row's score against its mean in the rows (one aggregate, broadcast).

    A row's own score is computed first and travels with it, so its variants needn't meet
    again: each of the passes scores ``block`` variants of a row (one feature at its mean)
    and adds their differences up on the map side. No variant is shuffled, only a row per
    feature and task. ``score`` is a column of the model's output.
    """
    data = clean_numeric(rows, features).select(*features)
    means = data.agg(*[F.avg(f).alias(f"_m_{f}") for f in features])
    full = model.transform(data).select(*features, score.alias("_full")).crossJoin(F.broadcast(means))  # one row
    out = None
    for start in range(0, len(features), block):
        part = list(features)[start : start + block]
        variants = full.select("*", F.explode(F.array(*[F.lit(f) for f in part])).alias("_feature")).select(
            "_feature", "_full",
            *[F.when(F.col("_feature") == f, F.col(f"_m_{f}")).otherwise(F.col(f)).alias(f) if f in part else F.col(f) for f in features])
        gain = F.col("_full") - score
        sums = model.transform(variants).groupBy(F.col("_feature").alias("variable")).agg(
            F.avg(F.abs(gain)).alias("mean_abs_contribution"), F.avg(gain).alias("mean_contribution"), F.count(F.lit(1)).alias("n"))
        out = sums if out is None else out.unionByName(sums)
    return out
