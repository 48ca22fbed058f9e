"""The monthly risk run (E1) as one lazy Spark plan:
ledger -> rollup -> dense panel -> features -> forecast -> trend fit ->
seasonal comparison -> risk score -> risk / opportunity lists."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions.dates import risk_window
from churnlens.operators import forecast as fc
from churnlens.operators import ml
from churnlens.operators import panel as pnl
from churnlens.operators import rollup
from churnlens.operators import score as sc
from churnlens.operators import seasonal as ss
from churnlens.sources.stage import stage


@dataclass
class RiskRun:
    monthly: DataFrame
    panel: DataFrame
    features: DataFrame
    forecast_long: DataFrame
    forecast_wide: DataFrame
    scoring: DataFrame
    fit: DataFrame
    scaffold: DataFrame
    seasonal: DataFrame
    inputs: DataFrame
    scores: DataFrame
    bounds: tuple[dt.date, dt.date] | None = None  # first and last month, if staged

    @property
    def last_month(self) -> dt.date | None:
        return self.bounds[1] if self.bounds else None


def risk_run(
    tx: DataFrame,
    as_of: dt.date,
    months: int = 24,
    materialize: bool = True,
    material_codes=rollup.MATERIAL_GROUP_COLUMNS,
    product_codes=rollup.PRODUCT_HIERARCHY_COLUMNS,
) -> RiskRun:
    start, end, anchor = risk_window(as_of, months)
    monthly = rollup.monthly_rollup(tx, start, end, "customer", material_codes, product_codes)
    if materialize:
        # the one pass over the ledger; everything after reads customer-months
        monthly = stage(monthly, "monthly")
    bounds = pnl.month_bounds(monthly) if materialize else None
    panel = pnl.dense_panel(monthly, bounds, pnl.panel_parts(monthly, bounds) if materialize else None)
    holidays = pnl.calendar_of(tx.sparkSession, bounds)
    features = pnl.period_diff_bucket(pnl.panel_features(panel, holidays))
    last = bounds and bounds[1]
    latest = pnl.period_diff_bucket(pnl.panel_features(panel, holidays, last=last)) if last else features
    # the forecast and the scaffold need only CCH: they read the dense panel,
    # so the window features are computed once, for the scoring rows
    long = fc.forecast_long(panel, anchor)
    wide = fc.forecast_wide(long, anchor)
    fit = sc.trend_fit(sc.scoring_frame(latest, wide, anchor, last))
    if materialize:
        # one row per forecast customer, read by the scaffold, the score,
        # the lists and the attribution: write once
        fit = stage(fit, "fit")
    # the scoring frame is in it: models score it without another pass over the feature chain
    scoring = fit.drop(*sc.TREND)
    scaffold = sc.score_scaffold(fit, panel)
    seasonal = ss.seasonal_compare(scaffold)
    inputs = sc.score_inputs(fit, seasonal)
    scores = sc.risk_score(inputs, report_month=anchor)
    return RiskRun(monthly, panel, features, long, wide, scoring, fit, scaffold, seasonal, inputs, scores, bounds)


def with_models(run: RiskRun, models: Sequence[PipelineModel], anchor: dt.date, materialize: bool = True) -> RiskRun:
    """M9: the run's trend, comparison and scores from the predictions of the
    six fitted regressors in place of the forecast means. Rollup, panel,
    features, forecast and scoring frame are the run's own and aren't made again."""
    scoring = run.scoring.filter(F.col("PREDICTION_DATE") == F.lit(anchor)).drop(*sc.PREDS)
    predictions = ml.predict_horizons(models, scoring).select(sc.CUST, *sc.PREDS)
    fit = sc.trend_fit(scoring.join(predictions.hint("merge"), sc.CUST))
    if materialize:
        fit = stage(fit, "fit")
    scaffold = sc.score_scaffold(fit, run.panel)
    seasonal = ss.seasonal_compare(scaffold)
    inputs = sc.score_inputs(fit, seasonal)
    scores = sc.risk_score(inputs, report_month=anchor)
    return replace(run, fit=fit, scaffold=scaffold, seasonal=seasonal, inputs=inputs, scores=scores)
