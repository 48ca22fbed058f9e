"""Spark ML jobs.

Model fitting runs on Spark ML estimators over assembled feature vectors;
splits are hash-based (repeatable, no global sort); metrics are aggregates.
"""

from __future__ import annotations

import datetime as dt
import math
import statistics
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlens.functions.quantiles import exact_quantiles
from churnlens.sources.stage import stage

RANK_TOLERANCE = 1e-10
CUST = "CUSTOMER_SHIPTO"
MONTH = "POSTING_DATE"

# The 59 model features of the six horizon regressors.
VARIABLES = [
    "period_1_sample_mean", "period_2_sample_mean", "period_3_sample_mean",
    "period_4_sample_mean", "period_5_sample_mean", "period_6_sample_mean",
    "CNT_POSTING_DATE", "CCH", "CCH_lag_1", "CCH_lag_2", "CCH_lag_3", "CCH_lag_4",
    "CCH_lag_5", "CCH_lag_6", "SALE_QTY", "DAILY_RENT", "MONTHLY_RENT",
    "QUARTERLY_RENT", "ANNUAL_RENT", "Smoothed_Holidays_shift_1",
    "Smoothed_Holidays_shift_2", "Smoothed_Holidays_shift_3",
    "Smoothed_Holidays_shift_4", "Smoothed_Holidays_shift_5",
    "Smoothed_Holidays_shift_6", "period_1_lower_bound", "period_2_lower_bound",
    "period_3_lower_bound", "period_4_lower_bound", "period_5_lower_bound",
    "period_6_lower_bound", "period_1_upper_bound", "period_2_upper_bound",
    "period_3_upper_bound", "period_4_upper_bound", "period_5_upper_bound",
    "period_6_upper_bound", "less12", "RENTAL_BILLED_QTY", "PRODUCT_SALES",
    "RENTAL_SALES", "cv2", "cv2_sales", "RENTAL_SALES_lag_1", "RENTAL_SALES_lag_2",
    "RENTAL_SALES_lag_3", "RENTAL_SALES_lag_4", "RENTAL_SALES_lag_5",
    "RENTAL_SALES_lag_6", "SALE_QTY_lag_1", "SALE_QTY_lag_2", "SALE_QTY_lag_3",
    "SALE_QTY_lag_4", "SALE_QTY_lag_5", "SALE_QTY_lag_6", "DELIVERY",
    "MATERIAL_020112_SALE", "MATERIAL_020110_SALE", "MATERIAL_020104_SALE",
]
# The purchase model's 13 features.
PURCHASE_FEATURES = [
    "CCH", "AVG_CCH", "PRODUCT_SALES", "CNTD_DANGEROUS", "CNTD_SEA", "CNTD_WATERWAY",
    "CNTD_DEBIT_ITEMS", "CNTD_MATNR", "CNTD_MATKL", "CNTD_STANDARD", "T_1_ENTRIES",
    "T_2_ENTRIES", "T_3_ENTRIES",
]
# Columns never used as lasso candidates.
LASSO_EXCLUDE = [
    *[f"period_{h}_uncertainty" for h in range(1, 7)], "period_diff", "miss_period",
    "POSTING_DATE", "cv2_sales", "CCH_shift_1", "CCH_shift_2", "CCH_shift_3", "CCH_shift_4",
    "CCH_shift_5", "CCH_shift_6", "ORDER_NO", "PREDICTION_DATE", "CUSTOMER_SHIPTO",
]


def hash_split(df: DataFrame, keys: Sequence[str], test_pct: int, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Repeatable train/test split from a hash of the row key."""
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(100))
    return df.filter(bucket >= test_pct), df.filter(bucket < test_pct)


def clean_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P8 + P7: +-inf and NaN to null, then null to 0, features as double."""
    out = []
    for c in cols:
        x = F.col(c).cast("double")
        out.append(F.when(F.isnan(x) | x.isin(float("inf"), float("-inf")), None).otherwise(x).alias(c))
    keep = [F.col(f"`{c}`") for c in df.columns if c not in cols]
    return df.select(*keep, *out).na.fill(0.0, subset=list(cols))


def training_set(features: DataFrame, bt_wide: DataFrame) -> DataFrame:
    """M5 (J16, F19): backtest forecasts joined to the panel row of their
    prediction month, with the band width per horizon.

    The months are compared by their difference, so the join's key is the customer: the
    wide features stay in the parts and the order that their windows have, and only the
    forecasts are shuffled. A customer has at most a row a month on either side."""
    wide = bt_wide.withColumnsRenamed({CUST: "_cust", "PREDICTION_DATE": "_month"}).hint("merge")
    same = (F.col(CUST) == F.col("_cust")) & (F.datediff(F.col(MONTH), F.col("_month")) == 0)
    df = features.join(wide, same, "inner").drop("_cust", "_month")
    order = [CUST, MONTH, *[c for c in features.columns if c not in (CUST, MONTH)], *[c for c in bt_wide.columns if c not in (CUST, "PREDICTION_DATE")]]
    return df.select(
        *order,
        *[(F.col(f"period_{h}_upper_bound") - F.col(f"period_{h}_lower_bound")).alias(f"period_{h}_uncertainty") for h in range(1, 7)],
    )


def horizon_models(train: DataFrame, variables: Sequence[str] = VARIABLES, seed: int = 42,
                   max_iter: int = 2500, max_depth: int = 4, validation_pct: int = 10) -> list[PipelineModel]:
    """M7: one gradient-boosted regressor per horizon (target CCH_shift_h);
    rows with a null target are dropped for that horizon. Boosting ends before
    ``max_iter`` rounds when the error on the validation rows (a hash split by
    customer and month) no longer falls by a hundredth. The features are assembled and
    written once: the six fits read vectors, so none of them plans the wide columns."""
    bucket = F.pmod(F.xxhash64(F.col(CUST), F.col(MONTH), F.lit(seed + 1)), F.lit(100))
    targets = [f"CCH_shift_{h}" for h in range(1, 7)]
    data = _assemble(clean_numeric(train, variables), variables).select("features", (bucket < validation_pct).alias("_validation"), *targets)
    data = stage(data, "training_vectors")
    models = []
    for h, target in enumerate(targets, 1):
        d = data.filter(F.col(target).isNotNull()).select("features", "_validation", F.col(target).cast("double").alias("label"))
        gbt = GBTRegressor(featuresCol="features", labelCol="label", predictionCol=f"pred{h}",
                           maxIter=max_iter, maxDepth=max_depth, seed=seed, validationIndicatorCol="_validation")
        models.append(assembled(gbt.fit(d), variables))
    return models


def horizon_mse(models: Sequence[PipelineModel], test: DataFrame, variables: Sequence[str] = VARIABLES) -> DataFrame:
    """M8: mean squared error per horizon on the held-out rows, and the rounds used."""
    data = clean_numeric(test, variables)
    rows = []
    for h, m in enumerate(models, 1):
        target = f"CCH_shift_{h}"
        d = data.filter(F.col(target).isNotNull()).withColumn("label", F.col(target).cast("double"))
        pred = m.transform(d)
        rows.append(pred.select(
            F.lit(h).alias("horizon"),
            F.avg((F.col(f"pred{h}") - F.col("label")) ** 2).alias("mse"),
            F.count(F.lit(1)).alias("n"),
            F.lit(boosting_rounds(m)).alias("rounds"),
        ))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def predict_horizons(models: Sequence[PipelineModel], scoring: DataFrame, variables: Sequence[str] = VARIABLES) -> DataFrame:
    """M9: pred1..6 from the six regressors (predictor='gbt')."""
    df = clean_numeric(scoring, variables)
    for m in models:
        df = m.transform(df).drop("features")
    return df


def boosting_rounds(model: PipelineModel) -> int:
    """Rounds that the boosting kept: trees up to the best validation error."""
    return model.stages[-1].getNumTrees


_REGISTRY = "as_of date, horizon int, rounds int, variables array<string>, mse double, n bigint"


def save_models(spark: SparkSession, models: Sequence[PipelineModel], path: str, as_of: dt.date, mse: DataFrame,
                variables: Sequence[str] = VARIABLES) -> DataFrame:
    """The fitted regressors of one run under ``path``, a folder that all executors
    share: a folder per horizon, then the registry's rows (features, rounds used, hold-out
    error), which mark the run as complete. A run with the same date replaces it."""
    root = f"{path}/{as_of:%Y-%m-%d}"
    for h, m in enumerate(models, 1):
        m.write().overwrite().save(f"{root}/horizon_{h}")
    rows = spark.createDataFrame([(as_of, h, boosting_rounds(m), list(variables)) for h, m in enumerate(models, 1)],
                                 "as_of date, horizon int, rounds int, variables array<string>")
    rows = rows.join(F.broadcast(mse.select("horizon", "mse", "n")), "horizon", "left").select("as_of", "horizon", "rounds", "variables", "mse", "n")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{root}/registry")
    return spark.read.schema(_REGISTRY).parquet(f"{root}/registry")


def load_models(spark: SparkSession, path: str, as_of: dt.date, variables: Sequence[str] = VARIABLES) -> list[PipelineModel]:
    """A saved run's regressors, for a later job. The registry must be there and name
    the same features in the same order."""
    root = f"{path}/{as_of:%Y-%m-%d}"
    entries = spark.read.schema(_REGISTRY).parquet(f"{root}/registry").orderBy("horizon").collect()
    for e in entries:
        if e.variables != list(variables):
            raise ValueError(f"{root}: horizon {e.horizon} was fitted on other features")
    return [PipelineModel.load(f"{root}/horizon_{e.horizon}") for e in entries]


def _assemble(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep").transform(df)


def assembled(model, cols: Sequence[str]) -> PipelineModel:
    """A fitted model behind the assembler of its features."""
    return PipelineModel([VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep"), model])


def purchase_logit(snap: DataFrame, features: Sequence[str] = PURCHASE_FEATURES, seed: int = 42):
    """Logistic regression of the purchase label; returns the fitted
    model and the hold-out classification report (per class precision,
    recall, F1, support)."""
    data = _assemble(clean_numeric(snap, features), features).withColumn("label", F.col("purchase").cast("double"))
    train, test = hash_split(data, ["SNAPSHOT", "CUSTOMER_NUMBER"], 20, seed)
    model = LogisticRegression(featuresCol="features", labelCol="label", maxIter=100).fit(train)
    pred = model.transform(test)
    return model, classification_report(pred)


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                          classes: Sequence[float] = (0.0, 1.0)) -> DataFrame:
    """Precision / recall / F1 / support per class, then accuracy, macro and
    weighted averages: each row is counted once per class of the (binary)
    label domain, then one aggregate."""
    e = pred.select(label, prediction, F.explode(F.array(*[F.lit(float(c)) for c in classes])).alias("cls"))
    agg = e.groupBy("cls").agg(
        F.sum(F.when((F.col(label) == F.col("cls")) & (F.col(prediction) == F.col("cls")), 1).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col(prediction) == F.col("cls"), 1).otherwise(0)).alias("pp"),
        F.sum(F.when(F.col(label) == F.col("cls"), 1).otherwise(0)).alias("support"),
    )
    p = F.coalesce(F.try_divide(F.col("tp"), F.col("pp")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    per = agg.select(F.format_string("%.1f", "cls").alias("class"), p.alias("precision"), r.alias("recall"), f1.alias("f1"), "tp", "support")
    rows = F.sum("support")
    mean = lambda c: F.avg(c).alias(c)
    weighted = lambda c: F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("support")), rows), F.lit(0.0)).alias(c)
    right = F.coalesce(F.try_divide(F.sum("tp"), rows), F.lit(0.0))
    total = rows.alias("support")
    scores = ["precision", "recall", "f1"]
    return (
        per.drop("tp")
        .unionByName(per.agg(F.lit("accuracy").alias("class"), *[right.alias(c) for c in scores], total))
        .unionByName(per.agg(F.lit("macro avg").alias("class"), *map(mean, scores), total))
        .unionByName(per.agg(F.lit("weighted avg").alias("class"), *map(weighted, scores), total))
        .withColumn("support", F.col("support").cast("bigint"))
    )


def ols_pvalues(snap: DataFrame, features: Sequence[str] = PURCHASE_FEATURES) -> tuple[DataFrame, DataFrame]:
    """OLS of purchase on the features with intercept: coefficient, std
    error, t and two-sided p per term; plus fitted values and residuals.

    One aggregate gives the cross products (a matrix as large as the number of
    terms, whatever the rows); the coefficients are its pseudo-inverse times
    X'y, so equal or dependent features share their effect in the least-norm
    solution and have standard errors too. t has n - rank degrees of freedom.
    """
    spark = snap.sparkSession
    names = [*features, "const"]
    data = clean_numeric(snap, features).withColumn("label", F.col("purchase").cast("double"))
    # columns are scaled by their root mean square first: the rank is judged on one scale
    terms = {f: F.col(f) for f in features} | {"const": F.lit(1.0)}
    rms = data.agg(*[F.sqrt(F.avg(x * x)).alias(n) for n, x in terms.items()]).first()
    scale = [float(rms[n] or 0.0) or 1.0 for n in names]
    z = [x / s for x, s in zip(terms.values(), scale)]
    cross = data.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("label") * F.col("label")).alias("yy"),
        *[F.sum(z[i] * z[j]).alias(f"x{i}_{j}") for i in range(len(z)) for j in range(i, len(z))],
        *[F.sum(z[i] * F.col("label")).alias(f"y{i}") for i in range(len(z))],
    ).first()
    k, n = len(names), cross["n"]
    xx = np.array([[float(cross[f"x{min(i, j)}_{max(i, j)}"] or 0.0) for j in range(k)] for i in range(k)])
    xy = np.array([float(cross[f"y{i}"] or 0.0) for i in range(k)])
    inverse = np.linalg.pinv(xx, rcond=RANK_TOLERANCE, hermitian=True)
    rank = int(np.linalg.matrix_rank(xx, tol=RANK_TOLERANCE * max(np.abs(np.linalg.eigvalsh(xx)).max(), 1e-300), hermitian=True))
    coef = inverse @ xy
    rss = max(float(cross["yy"] or 0.0) - float(coef @ xy), 0.0)
    free = n - rank
    se = np.sqrt(np.clip(np.diag(inverse), 0, None) * rss / free) if free > 0 else np.full(k, np.nan)
    table = []
    for name, c, e, s in zip(names, coef, se, scale):
        c, e = c / s, e / s
        t = float(c / e) if e > 0 else None
        table.append((name, float(c), None if math.isnan(e) else float(e), t, None if t is None else student_t_two_sided(t, free)))
    fitted_col = F.lit(0.0)
    for name, c, s in zip(names, coef, scale):
        fitted_col = fitted_col + F.lit(float(c / s)) * terms[name]
    fitted = data.select("SNAPSHOT", "CUSTOMER_NUMBER", fitted_col.alias("fitted"), (F.col("label") - fitted_col).alias("resid"))
    return spark.createDataFrame(table, "variable string, coef double, std_err double, t double, p_value double"), fitted


def student_t_two_sided(t: float, df: int) -> float:
    """P(|T| >= |t|) for Student's t: the regularised incomplete beta function
    I_x(df / 2, 1 / 2) at x = df / (df + t^2), by its continued fraction."""
    x = df / (df + t * t)
    a, b = df / 2.0, 0.5
    if x >= 1.0:
        return 1.0
    if x <= 0.0:
        return 0.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_fraction(b, a, 1.0 - x)
    return _beta_fraction(a, b, x)


def _beta_fraction(a: float, b: float, x: float) -> float:
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 0.0
    value = 1.0
    for m in range(400):
        if m == 0:
            step = 1.0
        elif m % 2 == 0:
            k = m // 2
            step = k * (b - k) * x / ((a + 2 * k - 1) * (a + 2 * k))
        else:
            k = (m - 1) // 2
            step = -(a + k) * (a + b + k) * x / ((a + 2 * k) * (a + 2 * k + 1))
        d = 1.0 + step * d
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        c = 1.0 + step / (c if abs(c) > 1e-300 else 1e-300)
        value *= c * d
        if m and abs(1.0 - c * d) < 1e-15:
            break
    return front * (value - 1.0)


def residual_quantiles(fitted: DataFrame, probs: Sequence[float] | None = None) -> DataFrame:
    """Q-Q data: exact quantiles of the standardised residuals against
    the standard normal quantiles at the same probabilities."""
    probs = list(probs or [i / 100 for i in range(1, 100)])
    spark = fitted.sparkSession
    m = fitted.select(F.avg("resid")).scalar()
    sd = fitted.select(F.stddev_samp("resid")).scalar()
    q = exact_quantiles(fitted, [], (F.col("resid") - m) / sd, probs).select(F.posexplode("q").alias("i", "sample_q"))
    nd = statistics.NormalDist()
    theo = spark.createDataFrame([(i, p, nd.inv_cdf(p)) for i, p in enumerate(probs)], "i int, p double, normal_q double")
    return theo.join(q, "i").select("p", "normal_q", "sample_q")


def forest_importance(snap: DataFrame, features: Sequence[str] = PURCHASE_FEATURES, seed: int = 42,
                      num_trees: int = 100) -> tuple[object, DataFrame]:
    """M15 + O5: random-forest importances, selected when >= their mean."""
    spark = snap.sparkSession
    data = _assemble(clean_numeric(snap, features), features).withColumn("label", F.col("purchase").cast("double"))
    train, _ = hash_split(data, ["SNAPSHOT", "CUSTOMER_NUMBER"], 20, seed)
    model = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=num_trees, seed=seed).fit(train)
    imp = model.featureImportances.toArray().tolist()
    mean = sum(imp) / len(imp)
    table = spark.createDataFrame(
        [(f, float(v), v >= mean) for f, v in zip(features, imp)], "variable string, importance double, selected boolean"
    )
    return model, table


def permutation_importance(model, snap: DataFrame, features: Sequence[str] = PURCHASE_FEATURES,
                           seed: int = 42, blocks: int = 512) -> DataFrame:
    """Accuracy drop when one feature is permuted across the test rows.

    Rows are spread over a fixed number of hash blocks (a parameter, the same
    for any number of rows). Within a block, feature j's values are
    re-dealt by a seeded hash order: the row ranked r by key receives the
    value ranked r by the feature's hash. All features' permuted values come
    from one exploded table and one join, and every permuted copy plus the
    original is scored in one ``transform`` -- no global sort, no loop of jobs.
    """
    data = clean_numeric(snap, features).withColumn("label", F.col("purchase").cast("double"))
    _, test = hash_split(data, ["SNAPSHOT", "CUSTOMER_NUMBER"], 20, seed)
    key = [F.col("SNAPSHOT"), F.col("CUSTOMER_NUMBER")]
    test = test.withColumn("_blk", F.pmod(F.xxhash64(*key), F.lit(blocks))).withColumn("_k", F.xxhash64(*key))
    blk = Window.partitionBy("_blk")
    ranked = test.select(
        "*",
        F.row_number().over(blk.orderBy("_k")).alias("_rn"),
        *[F.row_number().over(blk.orderBy(F.xxhash64(*key, F.lit(seed + j)), "_k")).alias(f"_r{j}") for j in range(len(features))],
    )
    dealt = ranked.select(
        "_blk",
        F.explode(F.array(*[
            F.struct(F.lit(j).alias("_j"), F.col(f"_r{j}").alias("_rn"), F.col(f).cast("double").alias("_v"))
            for j, f in enumerate(features)
        ])).alias("e"),
    ).select("_blk", "e._j", "e._rn", "e._v")
    base = ranked.select("_blk", "_rn", "label", *features)
    permuted = base.join(dealt, ["_blk", "_rn"]).select(
        "label",
        F.element_at(F.array(*[F.lit(f) for f in features]), F.col("_j") + 1).alias("perm"),
        *[F.when(F.col("_j") == j, F.col("_v")).otherwise(F.col(f)).alias(f) for j, f in enumerate(features)],
    )
    allc = base.select("label", F.lit("(none)").alias("perm"), *features).unionByName(permuted)
    scored = model.transform(_assemble(allc, features))
    acc = scored.groupBy("perm").agg(F.avg(F.when(F.col("prediction") == F.col("label"), 1.0).otherwise(0.0)).alias("accuracy"))
    base_acc = acc.filter(F.col("perm") == "(none)").select(F.max("accuracy")).scalar()
    return acc.filter(F.col("perm") != "(none)").select(
        F.col("perm").alias("variable"), "accuracy", (base_acc - F.col("accuracy")).alias("importance")
    )


def fold_moments(df: DataFrame, cols: Sequence[str], fold: Column, folds: int) -> np.ndarray:
    """Z'Z of Z = (1, cols) for each fold, shape (folds, k, k): one pass, each
    task adds up its rows' matrix; what reaches the driver is folds x k x k
    numbers, whatever the rows."""
    k = len(cols) + 1

    def sums(batches):
        total = np.zeros((folds, k, k))
        for rec in batches:
            at = rec.column(0).to_numpy()
            z = np.column_stack([np.ones(rec.num_rows), *(rec.column(i).to_numpy() for i in range(1, k))])
            for f in range(folds):
                part = z[at == f]
                total[f] += part.T @ part
        yield pa.record_batch([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "v"])

    rows = df.select(fold.cast("int"), *[F.col(c).cast("double") for c in cols]).mapInArrow(sums, "at long, v double")
    out = np.zeros(folds * k * k)
    for r in rows.groupBy("at").agg(F.sum("v").alias("v")).collect():
        out[r["at"]] = r["v"]
    return out.reshape(folds, k, k)


def _centred(m: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(n, means, centred cross products) of a moment matrix; the target is its last column."""
    n = max(m[0, 0], 1.0)
    mean = m[0, 1:] / n
    return n, mean, m[1:, 1:] - n * np.outer(mean, mean)


def lasso_path(m: np.ndarray, alphas: np.ndarray, sweeps: int = 1000, tol: float = 1e-4) -> np.ndarray:
    """Coefficients at each penalty (largest first), by coordinate descent on
    the cross products: least |y - Xb - c|^2 / (2 n) + alpha |b|_1."""
    n, _, s = _centred(m)
    q, r, yy = s[:-1, :-1] / n, s[:-1, -1] / n, s[-1, -1] / n
    diag = np.diag(q).copy()
    b, out = np.zeros(len(r)), []
    for alpha in alphas:
        grad = r - q @ b
        for _ in range(sweeps):
            largest = 0.0
            for j in np.flatnonzero(diag > 0):
                old = b[j]
                rho = grad[j] + diag[j] * old
                new = np.sign(rho) * max(abs(rho) - alpha, 0.0) / diag[j]
                if new != old:
                    grad -= q[:, j] * (new - old)
                    b[j] = new
                    largest = max(largest, abs(new - old) * np.sqrt(diag[j]))
            if largest <= tol * np.sqrt(max(yy, 1e-300)):
                break
        out.append(b.copy())
    return np.array(out)


def lasso_select(train: DataFrame, target: str = "CCH_shift_6", n_alphas: int = 100, eps: float = 1e-3,
                 folds: int = 5, holdout_pct: int = 15, seed: int = 42) -> DataFrame:
    """M6 + O4: L1 regression on the rows outside a 15 % hash hold-out; the
    penalty is the one of a path of ``n_alphas`` (down to ``eps`` of the
    smallest penalty that selects nothing) with the least mean squared error
    over ``folds`` hash folds. Features with a non-zero coefficient are
    selected (the reference computes and discards this list)."""
    spark = train.sparkSession
    num = [f.name for f in train.schema.fields
           if f.dataType.typeName() in ("double", "long", "integer") and f.name not in LASSO_EXCLUDE]
    keys = [CUST, MONTH]
    data, _ = hash_split(train.filter(F.col(target).isNotNull()), keys, holdout_pct, seed)
    data = clean_numeric(data, num).withColumn("_label", F.col(target).cast("double"))
    fold = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed + 2)), F.lit(folds))
    moments = fold_moments(data, [*num, "_label"], fold, folds)
    whole = moments.sum(axis=0)
    n, _, s = _centred(whole)
    top = np.abs(s[:-1, -1]).max() / n
    alphas = top * np.logspace(0, np.log10(eps), n_alphas) if top > 0 else np.array([1.0])
    error = np.zeros(len(alphas))
    for m in moments:
        fit = whole - m
        _, mf, _ = _centred(fit)
        for i, b in enumerate(lasso_path(fit, alphas)):
            # squared error on the fold, from its moments: residual = (y - b x) - intercept
            w = np.concatenate([[-(mf[-1] - b @ mf[:-1])], -b, [1.0]])
            error[i] += w @ m @ w / max(m[0, 0], 1.0) / folds
    best = lasso_path(whole, alphas[: int(error.argmin()) + 1])[-1]
    return spark.createDataFrame([(c, float(v), bool(v != 0.0)) for c, v in zip(num, best)],
                                 "variable string, coefficient double, selected boolean")
