"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over
the whole fixture tables. Parameters mirror FIXTURES.md (as_of 2001-08-01)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from churnlens.operators import rollup
from churnlens.plans.oracle import AS_OF, FORECAST_AT, HIST_END, HIST_START  # noqa: F401
from churnlens.plans.output import finalize, round_half_away
from churnlens.sources import fixtures as fx
from churnlens.sources.snapshots import SnapshotTable
from churnlens.sources.stage import new_path, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _codes():
    mats = list(zip(fx.FIXTURE_MATERIAL_GROUPS, [n for _, n in rollup.MATERIAL_GROUP_COLUMNS]))
    prods = list(zip(fx.FIXTURE_PRODUCT_HIERARCHIES, [n for _, n in rollup.PRODUCT_HIERARCHY_COLUMNS]))
    return mats, prods


def rollup_frame(spark: SparkSession, sf_dir: str, keys: str = "customer") -> DataFrame:
    mats, prods = _codes()
    return rollup.monthly_rollup(fx.ledger(spark, sf_dir), HIST_START, HIST_END, keys, mats, prods)


@query
def monthly_rollup(spark, sf_dir):
    return finalize(rollup_frame(spark, sf_dir, "customer"))


@query
def monthly_rollup_shipto(spark, sf_dir):
    return finalize(rollup_frame(spark, sf_dir, "shipto"))


@query
def material_set(spark, sf_dir):
    mats, prods = _codes()
    return finalize(rollup.material_set(fx.ledger(spark, sf_dir), HIST_START, None, mats, prods))


# --------------------------------------------------------------------------
# Panel and window features
# --------------------------------------------------------------------------
from churnlens.operators import panel as pnl  # noqa: E402

K = [pnl.CUST, pnl.MONTH]


def panel_frame(spark, sf_dir):
    # the ledger rollup is read by the grid bounds, the grid and the facts:
    # write it once to the checkpoint folder
    return bounded_panel(spark, sf_dir)[0]


def bounded_panel(spark, sf_dir):
    monthly = stage(rollup_frame(spark, sf_dir), "monthly")
    bounds = pnl.month_bounds(monthly)
    return pnl.dense_panel(monthly, bounds, pnl.panel_parts(monthly, bounds)), bounds


def features_frame(spark, sf_dir):
    panel, bounds = bounded_panel(spark, sf_dir)
    return pnl.panel_features(panel, pnl.calendar_of(spark, bounds))


@query
def dense_panel(spark, sf_dir):
    return finalize(panel_frame(spark, sf_dir), 6)


@query
def holiday_months(spark, sf_dir):
    return finalize(features_frame(spark, sf_dir).select(pnl.MONTH, "Holidays", "Smoothed_Holidays").distinct(), 6)


@query
def holiday_months_in_lieu(spark, sf_dir):
    """X12 with a caller's holiday table: the calendar and its days in lieu."""
    from churnlens.functions import holidays as hol

    panel = panel_frame(spark, sf_dir)
    table = hol.with_days_in_lieu(hol.holiday_calendar(panel.select(F.year(pnl.MONTH).alias("year")).distinct()))
    features = pnl.panel_features(panel, holidays=stage(table, "holidays"))
    return finalize(features.select(pnl.MONTH, "Holidays", "Smoothed_Holidays").distinct(), 6)


@query
def panel_lags(spark, sf_dir):
    cols = [f"{c}_lag_{i}" for c in pnl.LAG_COLUMNS for i in range(1, 7)]
    panel, bounds = bounded_panel(spark, sf_dir)
    df = pnl.window_features(panel, pnl.calendar_of(spark, bounds))
    # a lag of a rounded value is the lag rounded: a value is rounded once, not for each of its lags
    rounded = finalize(df.select(*K, "_i", *pnl.LAG_COLUMNS), 6)
    return finalize(pnl.create_lags(rounded).select(*K, *cols))


@query
def panel_leads(spark, sf_dir):
    cols = [f"{c}_shift_{i}" for c in ("CCH", "Smoothed_Holidays") for i in range(1, 7)]
    return finalize(features_frame(spark, sf_dir).select(*K, *cols), 6)


@query
def rolling_means(spark, sf_dir):
    return finalize(features_frame(spark, sf_dir).select(*K, "ROLL_MEAN_3", "ROLL_MEAN_6"), 6)


@query
def rolling_var(spark, sf_dir):
    return finalize(features_frame(spark, sf_dir).select(*K, "cv2", "cv2_sales"), 4)


@query
def gauss_period(spark, sf_dir):
    df = pnl.period_diff_bucket(features_frame(spark, sf_dir))
    return finalize(df.select(*K, "period", "period_diff", "miss_period"), 6)


@query
def gauss_period_latest(spark, sf_dir):
    """W6 at the latest month of the window."""
    panel, bounds = bounded_panel(spark, sf_dir)
    df = pnl.period_diff_bucket(pnl.panel_features(panel, pnl.calendar_of(spark, bounds), tap="latest"))
    return finalize(df.select(*K, "period", "period_diff", "miss_period"), 6)


@query
def less12(spark, sf_dir):
    return finalize(features_frame(spark, sf_dir).select(*K, "less12"))


@query
def kalman_level(spark, sf_dir):
    return finalize(features_frame(spark, sf_dir).select(*K, "KS_filtered", "KSD"), 6)


# --------------------------------------------------------------------------
# Forecast, trend fit, seasonal comparison, risk score
# --------------------------------------------------------------------------
from churnlens.operators import forecast as fc  # noqa: E402
from churnlens.operators import score as sc  # noqa: E402
from churnlens.plans.risk_run import risk_run, with_models  # noqa: E402

FIT_COLS = sc.FIT_COLS


def run_frame(spark, sf_dir):
    mats, prods = _codes()
    return risk_run(fx.ledger(spark, sf_dir), AS_OF, 24, True, mats, prods)


def forecast_long_frame(spark, sf_dir):
    return fc.forecast_long(panel_frame(spark, sf_dir), FORECAST_AT)


@query
def forecast_quantiles(spark, sf_dir):
    return finalize(forecast_long_frame(spark, sf_dir), 6)


@query
def forecast_wide(spark, sf_dir):
    return finalize(fc.forecast_wide(forecast_long_frame(spark, sf_dir), FORECAST_AT), 6)


@query
def backtest_error(spark, sf_dir):
    panel, bounds = bounded_panel(spark, sf_dir)
    bt = fc.backtest(panel, fc.month_anchors(panel, bounds=bounds))
    return finalize(fc.backtest_error(bt), 6)


@query
def trend_fit(spark, sf_dir):
    return finalize(run_frame(spark, sf_dir).fit.select(*FIT_COLS), 6)


@query
def trend_fit9(spark, sf_dir):
    fit = sc.trend_fit9(run_frame(spark, sf_dir).fit)
    return finalize(fit.select(pnl.CUST, "slope9", "percent_decline9", "max_cch9", "p_value9", "cross_zero9", "drop9"), 6)


@query
def score_scaffold(spark, sf_dir):
    return finalize(run_frame(spark, sf_dir).scaffold, 6)


@query
def seasonal_compare(spark, sf_dir):
    return finalize(run_frame(spark, sf_dir).seasonal, 6)


SEASONAL_STATS = [pnl.CUST, "diff_phase", "amplitude", "period_after", "period_before", "mean_before", "mean_after"]


@query
def seasonal_stats(spark, sf_dir):
    """X6 without its arrays: periods, amplitude and means."""
    return finalize(run_frame(spark, sf_dir).seasonal.select(*SEASONAL_STATS), 6)


@query
def seasonal_stats_trimmed(spark, sf_dir):
    """X7 without its arrays."""
    from churnlens.operators import seasonal as ss

    rows = ss.seasonal_compare(run_frame(spark, sf_dir).scaffold, trim_leading_zeros=True)
    return finalize(rows.select(*SEASONAL_STATS), 6)


@query
def mean_shift(spark, sf_dir):
    r = run_frame(spark, sf_dir)
    return finalize(r.inputs.select(pnl.CUST, "mean_before", "mean_after", "magnitute_drop"), 6)


@query
def risk_score(spark, sf_dir):
    return finalize(run_frame(spark, sf_dir).scores)


@query
def risk_list(spark, sf_dir):
    return finalize(sc.risk_list(run_frame(spark, sf_dir).scores))


@query
def opportunity_list(spark, sf_dir):
    return finalize(sc.opportunity_list(run_frame(spark, sf_dir).scores))


# --------------------------------------------------------------------------
# Next-best-action snapshots
# --------------------------------------------------------------------------
import datetime as _dt  # noqa: E402

from churnlens.operators import nba  # noqa: E402

NBA_ANCHORS = [_dt.date(2001, 8, 1), _dt.date(2001, 7, 1), _dt.date(2001, 6, 1), _dt.date(2001, 5, 1)]
NBA_CODES = nba.DeliveryCodes(**fx.FIXTURE_DELIVERY_CODES)


def nba_inputs(spark, sf_dir):
    return (
        fx.ledger(spark, sf_dir),
        fx.deliveries(spark, sf_dir),
        fx.delivery_items(spark, sf_dir),
        NBA_ANCHORS,
    )


@query
def nba_mapping(spark, sf_dir):
    tx, dl, _, a = nba_inputs(spark, sf_dir)
    return finalize(nba.mapping(tx, dl, a, shipto_col="KNDNR"))


@query
def nba_customer(spark, sf_dir):
    tx, dl, _, a = nba_inputs(spark, sf_dir)
    return finalize(nba.customer_table(tx, nba.mapping(tx, dl, a, shipto_col="KNDNR"), a), 6)


@query
def nba_delivery_profile(spark, sf_dir):
    _, dl, _, a = nba_inputs(spark, sf_dir)
    return finalize(nba.delivery_profile(dl, a, codes=NBA_CODES), 6)


@query
def nba_items(spark, sf_dir):
    _, _, it, a = nba_inputs(spark, sf_dir)
    return finalize(nba.items_profile(nba.near_items(it, a), a), 6)


@query
def nba_new_items(spark, sf_dir):
    _, _, it, a = nba_inputs(spark, sf_dir)
    return finalize(nba.new_items(it, a), 6)


def snapshot_frame(spark, sf_dir):
    tx, dl, it, a = nba_inputs(spark, sf_dir)
    return nba.nba_snapshot(tx, dl, it, a, codes=NBA_CODES, shipto_col="KNDNR")


@query
def nba_snapshot(spark, sf_dir):
    return finalize(snapshot_frame(spark, sf_dir), 6)


@query
def nba_snapshot_table(spark, sf_dir):
    """The partitioned table, one anchor written first and the rest by a later run,
    read back."""
    tx, dl, it, anchors = nba_inputs(spark, sf_dir)
    built = []

    def build(a):
        built.append(finalize(nba.nba_snapshot(tx, dl, it, a, codes=NBA_CODES, shipto_col="KNDNR"), 6))
        return built[-1]

    table = SnapshotTable(spark, new_path(spark, "snapshots"))
    table.write_missing(anchors[-1:], build)
    table.write_missing(anchors, build)
    return table.read(built[-1].schema)


@query
def nba_snapshot_dedup(spark, sf_dir):
    """Every customer's, ship-to's and delivery's value once, with shared ship-tos."""
    tx, dl, it, a = nba_inputs(spark, sf_dir)
    return finalize(nba.nba_snapshot(tx, dl, it, a, codes=NBA_CODES, dedup=True), 6)


# J1, J4 with ship-tos that customers share: the ledger's own ship-to column
@query
def nba_mapping_shared(spark, sf_dir):
    tx, dl, _, a = nba_inputs(spark, sf_dir)
    return finalize(nba.mapping(tx, dl, a))


@query
def nba_customer_shared(spark, sf_dir):
    tx, dl, _, a = nba_inputs(spark, sf_dir)
    return finalize(nba.customer_table(tx, nba.mapping(tx, dl, a), a), 6)


@query
def nba_snapshot_shared(spark, sf_dir):
    tx, dl, it, a = nba_inputs(spark, sf_dir)
    return finalize(nba.nba_snapshot(tx, dl, it, a, codes=NBA_CODES), 6)


# --------------------------------------------------------------------------
# CRM feed
# --------------------------------------------------------------------------
from churnlens.operators import crm  # noqa: E402


@query
def crm_feed(spark, sf_dir):
    return finalize(crm.crm_feed(fx.crm_tables(spark, sf_dir)))


@query
def crm_feedback_text(spark, sf_dir):
    t = fx.crm_tables(spark, sf_dir)
    return crm.listagg_sorted(t["feedback"], "NEW_COMPLAINT", "NEW_BRIEFDESCRIPTION", "Feedback")


@query
def latest_child(spark, sf_dir):
    t = fx.crm_tables(spark, sf_dir)
    return finalize(crm.latest_child(t["account"]).select("PARENTACCOUNTID", "ACCOUNTID", "NEW_JDECODE", "NEW_EFFTECTTIME"))


# --------------------------------------------------------------------------
# Dashboards, labels, present value, profiles
# --------------------------------------------------------------------------
from pyspark.sql import functions as F  # noqa: E402

from churnlens.operators import boards, profile  # noqa: E402
from churnlens.operators.ml import PURCHASE_FEATURES  # noqa: E402

PROFILE_COLS = [*PURCHASE_FEATURES, "NEW_MATNR"]
# The variables of the class plots.
VIOLIN_COLS = ["NEW_MATNR", "CCH", "PRODUCT_SALES", "CNTD_DANGEROUS", "T_1_ENTRIES"]


def status_frame(spark, sf_dir):
    """The dashboards' table and the scores it rests on: the risk run's own."""
    r = run_frame(spark, sf_dir)
    yes, no = fx.action_lists(spark, sf_dir)
    labelled = boards.action_labels(r.panel.select(pnl.CUST).distinct(), yes, no)
    return boards.status_table(r.features, boards.status_of(r.scores, labelled)), r.scores


@query
def status_countd(spark, sf_dir):
    return finalize(boards.status_countd(status_frame(spark, sf_dir)[0]))


@query
def status_avg(spark, sf_dir):
    return finalize(boards.status_avg(status_frame(spark, sf_dir)[0], AS_OF), 6)


@query
def status_rental_avg(spark, sf_dir):
    return finalize(boards.status_rental_avg(status_frame(spark, sf_dir)[0]), 6)


@query
def status_sales_pct(spark, sf_dir):
    return finalize(boards.status_sales_pct(status_frame(spark, sf_dir)[0], AS_OF), 6)


@query
def status_median_pct(spark, sf_dir):
    return finalize(boards.status_median_pct(status_frame(spark, sf_dir)[0], AS_OF), 6)


@query
def status_growth_offset(spark, sf_dir):
    """W13 with the base that the sheet codes as -2."""
    return finalize(boards.status_growth(status_frame(spark, sf_dir)[0], offset=-2), 6)


@query
def status_median_growth(spark, sf_dir):
    return finalize(boards.status_median_growth(status_frame(spark, sf_dir)[0], AS_OF), 6)


@query
def status_blend(spark, sf_dir):
    table, scores = status_frame(spark, sf_dir)
    return finalize(boards.status_blend(table, scores, AS_OF, score_col="risk_score"), 6)


@query
def status_growth(spark, sf_dir):
    return finalize(boards.status_growth(status_frame(spark, sf_dir)[0]), 6)


def csv_folder(spark, name):
    from churnlens.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv/{name}-{uuid.uuid4().hex}"


def written_lists(spark, sf_dir):
    """The two result lists, written as CSV and read back."""
    from churnlens.sources import io

    scores = run_frame(spark, sf_dir).scores
    lists = {"risk": sc.risk_list(scores), "opportunity": sc.opportunity_list(scores)}
    out = None
    for name, df in lists.items():
        path = csv_folder(spark, name)
        io.write_csv(df.select(pnl.CUST, "risk_score"), path)
        back = spark.read.schema(f"{pnl.CUST} string, risk_score double").option("header", True).csv(path)
        back = back.select(F.lit(name).alias("list"), pnl.CUST, F.col("risk_score").cast("double"))
        out = back if out is None else out.unionByName(back)
    return out


@query
def result_lists(spark, sf_dir):
    return finalize(written_lists(spark, sf_dir), 6)


@query
def list_counts(spark, sf_dir):
    """How many customers each result list has."""
    return finalize(written_lists(spark, sf_dir).groupBy("list").agg(F.count(F.lit(1)).alias("customers")))


@query
def action_list_csv(spark, sf_dir):
    """The action list as the CSV that the labelling reads."""
    from churnlens.sources import io

    yes, _ = fx.action_lists(spark, sf_dir)
    path = csv_folder(spark, "actions")
    io.write_csv(yes, path)
    return finalize(io.read_action_list(spark, path))


@query
def status_csv(spark, sf_dir):
    """The dashboards' table through its CSV with the declared schema."""
    from churnlens.sources import io

    table, _ = status_frame(spark, sf_dir)
    panel = ["CCH", "PRODUCT_SALES", "RENTAL_SALES", "DELIVERY", "Holidays"]
    names = [f.name for f in io.status_schema(panel)]
    path = csv_folder(spark, "status")
    io.write_csv(table.select(*names), path)
    back = io.read_status_csv(spark, path, panel)
    return finalize(back.groupBy("RISK_STATUS").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("POSTING_DATE").alias("months"),
        *[F.sum(c).alias(f"sum_{c.lower()}") for c in panel], F.sum("RISK_UNCHECK").alias("uncheck_rows")), 3)


@query
def score_bins(spark, sf_dir):
    return finalize(boards.score_bins(run_frame(spark, sf_dir).scores))


@query
def rental_type(spark, sf_dir):
    return finalize(boards.rental_type(panel_frame(spark, sf_dir)))


@query
def miss_period_bucket(spark, sf_dir):
    df = pnl.period_diff_bucket(features_frame(spark, sf_dir))
    return finalize(df.groupBy("miss_period").agg(F.count(F.lit(1)).alias("rows")))


@query
def action_labels(spark, sf_dir):
    yes, no = fx.action_lists(spark, sf_dir)
    return finalize(boards.action_labels(panel_frame(spark, sf_dir), yes, no), 6)


@query
def customer_pv(spark, sf_dir):
    df = finalize(boards.pv_table(panel_frame(spark, sf_dir), AS_OF), 6)
    return df.withColumn("pv", round_half_away(F.col("pv"), 2))


@query
def histogram(spark, sf_dir):
    return finalize(profile.histogram(run_frame(spark, sf_dir).fit, "percent_decline"), 6)


@query
def class_quantiles(spark, sf_dir):
    snap = nba.purchase_label(snapshot_frame(spark, sf_dir))
    return finalize(profile.class_quantiles(snap, "purchase", VIOLIN_COLS), 6)


def profile_summary(spark, sf_dir):
    return finalize(profile.profile(snapshot_frame(spark, sf_dir), PROFILE_COLS), 6)


QUERIES["profile"] = profile_summary


@query
def seasonal_compare_trimmed(spark, sf_dir):
    """The older comparison: leading zeros trimmed, full cross-correlation."""
    from churnlens.operators import seasonal as ss

    return finalize(ss.seasonal_compare(run_frame(spark, sf_dir).scaffold, trim_leading_zeros=True), 6)


# --------------------------------------------------------------------------
# Spark ML and attribution (rows-only checks: fitted models)
# --------------------------------------------------------------------------
from churnlens.operators import explain as ex  # noqa: E402
from churnlens.operators import ml  # noqa: E402


def training_frame(spark, sf_dir):
    r = run_frame(spark, sf_dir)
    bt = fc.backtest(r.panel, fc.month_anchors(r.panel, bounds=r.bounds))
    train = stage(ml.training_set(r.features, fc.backtest_wide(bt)), "training_set")
    return r, train


def models_frame(spark, sf_dir):
    r, train = training_frame(spark, sf_dir)
    tr, te = ml.hash_split(train, [pnl.CUST, pnl.MONTH], 25)
    models = ml.horizon_models(tr)
    return r, train, te, models


@query
def horizon_models(spark, sf_dir):
    r, _, _, models = models_frame(spark, sf_dir)
    scoring = r.scoring.filter(F.col("PREDICTION_DATE") == F.lit(FORECAST_AT)).drop(*sc.PREDS)
    out = ml.predict_horizons(models, scoring)
    return finalize(out.select(pnl.CUST, *sc.PREDS), 6)


@query
def risk_score_gbt(spark, sf_dir):
    """M9: the risk run scored by the fitted regressors."""
    r, _, _, models = models_frame(spark, sf_dir)
    return finalize(with_models(r, models, FORECAST_AT).scores.select(pnl.CUST, "risk_score", "risk_value"))


@query
def risk_score_saved(spark, sf_dir):
    """The risk run scored by regressors that were saved and loaded again."""
    r, _, te, models = models_frame(spark, sf_dir)
    path = new_path(spark, "models")
    ml.save_models(spark, models, path, FORECAST_AT, ml.horizon_mse(models, te))
    loaded = ml.load_models(spark, path, FORECAST_AT)
    return finalize(with_models(r, loaded, FORECAST_AT).scores.select(pnl.CUST, "risk_score", "risk_value"))


@query
def model_registry(spark, sf_dir):
    """The registry's rows of one run: rounds used, features, hold-out error."""
    _, _, te, models = models_frame(spark, sf_dir)
    saved = ml.save_models(spark, models, new_path(spark, "models"), FORECAST_AT, ml.horizon_mse(models, te))
    return finalize(saved.select("as_of", "horizon", "rounds", F.size("variables").alias("n_variables"), "mse", "n"), 6)


@query
def horizon_mse(spark, sf_dir):
    _, _, te, models = models_frame(spark, sf_dir)
    return finalize(ml.horizon_mse(models, te), 6)


def purchase_snapshot(spark, sf_dir):
    # every fit, split and count reads it: write the snapshot once
    return stage(nba.purchase_label(snapshot_frame(spark, sf_dir)), "purchase")


@query
def purchase_logit(spark, sf_dir):
    _, report = ml.purchase_logit(purchase_snapshot(spark, sf_dir))
    return finalize(report, 6)


@query
def ols_pvalues(spark, sf_dir):
    table, _ = ml.ols_pvalues(purchase_snapshot(spark, sf_dir))
    return finalize(table, 6)


@query
def residual_quantiles(spark, sf_dir):
    _, fitted = ml.ols_pvalues(purchase_snapshot(spark, sf_dir))
    return finalize(ml.residual_quantiles(fitted), 6)


@query
def forest_importance(spark, sf_dir):
    _, table = ml.forest_importance(purchase_snapshot(spark, sf_dir))
    return finalize(table.orderBy(F.col("importance").desc()), 6)


@query
def forest_attribution(spark, sf_dir):
    """What each feature adds to the purchase forest's probability, over all rows."""
    from pyspark.ml.functions import vector_to_array

    snap = purchase_snapshot(spark, sf_dir)
    model, _ = ml.forest_importance(snap)
    forest = ml.assembled(model, ml.PURCHASE_FEATURES)
    table = ex.feature_attribution(forest, snap, ml.PURCHASE_FEATURES, vector_to_array("probability")[1])
    return finalize(table, 6)


@query
def permutation_importance(spark, sf_dir):
    snap = purchase_snapshot(spark, sf_dir)
    model, _ = ml.forest_importance(snap)
    return finalize(ml.permutation_importance(model, snap), 6)


@query
def lasso_select(spark, sf_dir):
    _, train = training_frame(spark, sf_dir)
    return finalize(ml.lasso_select(train), 6)


@query
def driver_names(spark, sf_dir):
    r = run_frame(spark, sf_dir)
    scoring = r.scoring.filter(F.col("PREDICTION_DATE") == F.lit(FORECAST_AT))
    means = scoring.agg(*[F.avg(F.col(v).cast("double")).alias(v) for v in ml.VARIABLES])
    long = means.select(F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).alias("mean_value"))
                                             for v in ml.VARIABLES])).alias("e")).select("e.*")
    return finalize(long.join(F.broadcast(ex.driver_table(spark)), "variable"), 6)


def explain_frame(spark, sf_dir):
    r, train, _, models = models_frame(spark, sf_dir)
    r = with_models(r, models, FORECAST_AT)  # explain the model that made the scores
    # the explained customers and the background, read on both sides of a join: written
    # once, so that the attribution's plan doesn't hold the run's twice
    risk = stage(sc.risk_list(r.scores), "risk")
    means = stage(ex.background_means(train), "background")
    return r, risk, models[2], means, ex.driver_table(spark)


@query
def explain_top3(spark, sf_dir):
    r, risk, model, means, drivers = explain_frame(spark, sf_dir)
    return finalize(ex.explain_risk(model, r.fit, risk, means, drivers))


@query
def driver_global(spark, sf_dir):
    r, risk, model, means, drivers = explain_frame(spark, sf_dir)
    rows = r.fit.join(risk.select(pnl.CUST).hint("merge"), pnl.CUST, "left_semi").filter(F.col("max_cch") >= 0)
    return finalize(ex.driver_global(ex.occlusion(model, rows, means), drivers), 6)
