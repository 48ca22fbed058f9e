"""What the risk run holds at once: no table that grows passes the driver, and the panel's
parts follow its rows."""

import datetime as dt

from churnlens.operators import boards, rollup, score
from churnlens.operators import panel as pnl
from churnlens.sources import fixtures as fx

from conftest import SF_SMALL

BOUNDS = (dt.date(2001, 1, 1), dt.date(2001, 5, 1))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def monthly(spark, rows):
    """Rollup rows (customer, month, value) with every measure at the value."""
    df = spark.createDataFrame(rows, "CUSTOMER_NUMBER string, POSTING_DATE string, v double")
    return df.select("CUSTOMER_NUMBER", "POSTING_DATE", *[df["v"].alias(c) for c in pnl.PANEL_SUMS])


ROWS = [("a", "2001-02", 1.0), ("a", "2001-02", 2.0), ("a", "2001-04", None), ("b", "2001-01", 5.0), ("b", "2001-05", 7.0),
        ("c", None, 9.0), (None, "2001-03", 11.0), ("d", "2002-01", 13.0), ("d", "2001-03", 4.0)]


def test_dense_panel_of_odd_rows(spark):
    """Every customer has every month once; a row without customer, without month or beyond
    the bounds gives no value."""
    want = {(c, m): 0.0 for c in ("a", "b", "c", "d", None) for m in range(1, 6)}
    want |= {("a", 2): 3.0, ("b", 1): 5.0, ("b", 5): 7.0, ("d", 3): 4.0}
    for parts in (None, 3):
        panel = pnl.dense_panel(monthly(spark, ROWS), BOUNDS, parts)
        got = panel.select(pnl.CUST, pnl.MONTH, "CCH", "PROD_8LRGLG_SALE").collect()
        assert len(got) == len(want)
        assert {(r[0], r[1].month): r[2] for r in got} == {(r[0], r[1].month): r[3] for r in got} == want


def test_panel_without_bounds(spark):
    panel = pnl.dense_panel(monthly(spark, ROWS[:5]))
    assert panel.count() == 2 * 5
    assert pnl.dense_panel(monthly(spark, ROWS[:5]).limit(0)).count() == 0


def test_parts_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(pnl, "ROWS_PER_TASK", 10)
    few = monthly(spark, [(f"c{i}", "2001-01", 1.0) for i in range(4)])
    many = monthly(spark, [(f"c{i}", "2001-01", 1.0) for i in range(40)])
    assert pnl.panel_parts(few, BOUNDS) == 2
    assert 18 <= pnl.panel_parts(many, BOUNDS) <= 22
    assert pnl.panel_parts(few.limit(0), None) == 1
    features = pnl.panel_features(pnl.dense_panel(many, BOUNDS, 20))
    assert features.rdd.getNumPartitions() == 20


def test_nothing_that_grows_is_broadcast(spark):
    tx = fx.ledger(spark, SF_SMALL)
    for df in (tx, fx.deliveries(spark, SF_SMALL), fx.delivery_items(spark, SF_SMALL)):
        assert "Broadcast" not in plan(df)
    rows = rollup.monthly_rollup(tx, None, None)
    assert "Broadcast" not in plan(rows)
    panel = pnl.dense_panel(rows, BOUNDS, 2)
    assert "Broadcast" not in plan(panel)
    scores = spark.createDataFrame([("a", 70.0)], f"{pnl.CUST} string, risk_score double")
    actions = boards.action_labels(panel.select(pnl.CUST).distinct(), *fx.action_lists(spark, SF_SMALL))
    assert "Broadcast" not in plan(boards.status_table(panel, boards.status_of(scores, actions)))
    wide = spark.createDataFrame([("a", dt.date(2001, 1, 1), 1.0)], f"{pnl.CUST} string, PREDICTION_DATE date, period_1_sample_mean double")
    for h in range(2, 7):
        wide = wide.withColumn(f"period_{h}_sample_mean", wide["period_1_sample_mean"])
    assert "Broadcast" not in plan(score.scoring_frame(panel, wide, dt.date(2001, 1, 1), BOUNDS[1]))


def test_training_set_keeps_the_features_where_they_are(spark):
    """The wide features join the forecasts by customer, without a shuffle of their own."""
    from churnlens.operators import forecast as fc
    from churnlens.operators import ml

    months = [f"2001-{m:02d}" for m in range(1, 6)]
    panel = pnl.dense_panel(monthly(spark, [(c, m, float(i + 1)) for c in "ab" for i, m in enumerate(months)]), BOUNDS, 3)
    features = pnl.panel_features(panel)
    bt = fc.backtest(panel, spark.sql("SELECT explode(array(DATE'2001-03-01', DATE'2001-04-01')) AS anchor"))
    wide = fc.backtest_wide(bt)
    got = ml.training_set(features, wide)
    assert not [x for x in plan(got).split("\n") if "Exchange" in x and "POSTING_DATE" in x and "anchor" not in x]
    want = features.join(wide.withColumnRenamed("PREDICTION_DATE", pnl.MONTH), [pnl.CUST, pnl.MONTH])
    rows = got.select(*want.columns)
    assert rows.count() == want.count() == 4
    assert got.columns[: len(want.columns)] == want.columns
    assert rows.exceptAll(want).count() == want.exceptAll(rows).count() == 0


def test_models_score_the_frame_that_the_run_wrote(spark):
    """The run's models read its scoring frame; the feature chain isn't made again for them."""
    from pyspark.sql import functions as F

    from churnlens.plans.risk_run import risk_run, with_models

    class Plus:
        def __init__(self, h):
            self.h = h

        def transform(self, df):
            return df.withColumn(f"pred{self.h}", F.col("CCH") + self.h).withColumn("features", F.lit(0))

    as_of, anchor = dt.date(2001, 8, 1), dt.date(2001, 7, 1)
    columns = {"MANDT": "'3'", "BUKRS": "'AU1'", "LAND1": "'AU'", "PALEDGER": "2", "AUART": "'0CRO'", "VVQ01_ME": "'CDA'",
               "BUDAT": "m", "WADAT": "m", "FADAT": "m", "KNDNR": "c", "VVQ13": "CAST(q AS DECIMAL(18,4))"}
    rows = [(c, dt.date(2000 + (m > 12), (m - 1) % 12 + 1, 5), float(m + len(c))) for c in ("a", "bb") for m in range(1, 20)]
    base = spark.createDataFrame([*rows, ("c", dt.date(2001, 7, 9), 4.0)], "c string, m date, q double")
    shape = fx.ledger(spark, SF_SMALL).schema
    tx = base.selectExpr(*[f"CAST({columns.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in shape])
    run = risk_run(tx, as_of, 24)
    want = score.scoring_frame(run.features, run.forecast_wide, anchor, run.last_month)
    assert run.scoring.columns == want.columns
    assert run.scoring.count() == want.count() == 2
    assert run.scoring.exceptAll(want).count() == 0
    scored = with_models(run, [Plus(h) for h in range(1, 7)], anchor, materialize=False)
    assert "Window" not in plan(scored.fit)
    assert {tuple(r) for r in scored.fit.selectExpr("pred1 - CCH", "pred6 - CCH").collect()} == {(1.0, 6.0)}
    assert with_models(run, [Plus(h) for h in range(1, 7)], as_of, materialize=False).fit.count() == 0


def test_fits_read_vectors_that_were_written_once(spark, monkeypatch):
    """The six regressors plan no wide column: the features are assembled before them."""
    from churnlens.operators import ml

    fitted, written = [], []

    class Regressor:
        def __init__(self, **params):
            self.params = params

        def fit(self, d):
            fitted.append((self.params["predictionCol"], d))
            return self.params["predictionCol"]

    monkeypatch.setattr(ml, "GBTRegressor", Regressor)
    monkeypatch.setattr(ml, "assembled", lambda model, variables: (model, list(variables)))
    monkeypatch.setattr(ml, "stage", lambda df, name, f=ml.stage: written.append(name) or f(df, name))
    train = spark.range(50).selectExpr("cast(id as string) CUSTOMER_SHIPTO", "date'2001-01-01' POSTING_DATE", "id x", "if(id = 3, double('nan'), null) y",
                                       *[f"if(id < {h}, null, id + {h}) CCH_shift_{h}" for h in range(1, 7)])
    models = ml.horizon_models(train, ["x", "y"])
    assert models == [(f"pred{h}", ["x", "y"]) for h in range(1, 7)] and written == ["training_vectors"]
    for h, (_, d) in enumerate(fitted, 1):
        assert d.columns == ["features", "_validation", "label"] and "UDF" not in plan(d)
        rows = d.collect()
        assert {(r.features[0], r.features[1], r.label) for r in rows} == {(float(i), 0.0, float(i + h)) for i in range(h, 50)}
        assert {r._validation for r in rows} == {True, False}


def test_explained_customers_are_read_not_made_again(spark, monkeypatch):
    """The risk list and the background of the attribution are written before the plan that
    uses them twice."""
    from churnlens.plans import queries as q

    names = []
    monkeypatch.setattr(q, "stage", lambda df, name: names.append(name) or df)
    run = type("Run", (), {"scores": spark.createDataFrame([("a", 70.0), ("b", 10.0)], "CUSTOMER_SHIPTO string, risk_score double")})
    monkeypatch.setattr(q, "models_frame", lambda *a: (None, spark.range(1), None, [0, 1, 2]))
    monkeypatch.setattr(q, "with_models", lambda *a: run)
    monkeypatch.setattr(q.ex, "background_means", lambda train: train)
    r, risk, model, means, drivers = q.explain_frame(spark, "")
    assert (r, model, names) == (run, 2, ["risk", "background"])
    assert [x.CUSTOMER_SHIPTO for x in risk.collect()] == ["a"]


def test_last_month_needs_no_earlier_lags(spark):
    """The scoring rows are the last month's of the whole feature chain; lags are made for the
    months they look back to."""
    from pyspark.sql import functions as F

    bounds = (dt.date(2000, 1, 1), dt.date(2001, 8, 1))
    months = [f"{2000 + m // 12}-{m % 12 + 1:02d}" for m in range(20)]
    rows = [(c, m, float((i * k) % 7 + i / 3)) for k, c in enumerate(("a", "b", "c"), 1) for i, m in enumerate(months) if (i + k) % k == 0]
    panel = pnl.dense_panel(monthly(spark, [*rows, ("d", None, 1.0), (None, "2001-08", 2.0)]), bounds, 2)
    holidays = pnl.calendar_of(spark, bounds)
    whole = pnl.period_diff_bucket(pnl.panel_features(panel))
    short = pnl.period_diff_bucket(pnl.panel_features(panel, holidays, last=bounds[1]))
    assert short.columns == whole.columns and short.schema == whole.schema
    assert short.count() == 5 * (pnl.N_BACK + 1)
    at = F.col(pnl.MONTH) == F.lit(bounds[1])
    got, want = ({r[pnl.CUST]: r for r in df.filter(at).collect()} for df in (short, whole))
    assert len(got) == 5 and got == want and {r.less12 for r in got.values()} == {1}


def test_known_bounds_give_the_holidays(spark):
    """The years between the bounds: the panel isn't made to list them."""
    panel = pnl.dense_panel(monthly(spark, [("a", "1999-11", 1.0), ("a", "2001-02", 2.0)]), (dt.date(1999, 11, 1), dt.date(2001, 2, 1)), 1)
    calendar = pnl.calendar_of(spark, (dt.date(1999, 11, 1), dt.date(2001, 2, 1)))
    assert "_span" not in plan(calendar)
    assert pnl.calendar_of(spark, None) is None
    got, want = (pnl.add_holidays(panel, h).select(pnl.MONTH, "Holidays").collect() for h in (calendar, None))
    assert sorted(got) == sorted(want) and len(got) == 16 and sum(r.Holidays for r in got) > 0


def test_panel_lags_rounds_a_value_once(spark, monkeypatch):
    """No lag is rounded; the results are those of rounding each."""
    from churnlens.plans import queries as q
    from churnlens.plans.output import finalize

    rows = [("a", f"2001-{m:02d}", m / 7) for m in range(1, 6)] + [("b", "2001-03", -2 / 3), (None, "2001-02", 1e-7)]
    panel = pnl.dense_panel(monthly(spark, rows), BOUNDS, 1)
    monkeypatch.setattr(q, "bounded_panel", lambda *a: (panel, BOUNDS))
    got = q.panel_lags(spark, "")
    names = [f"{c}_lag_{i}" for c in pnl.LAG_COLUMNS for i in range(1, 7)]
    want = finalize(pnl.panel_features(panel).select(pnl.CUST, pnl.MONTH, *names), 6)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert plan(got).split("Window", 1)[0].count("round(") == 0
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
