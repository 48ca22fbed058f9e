"""DuckDB oracle SQL for the registered queries.

Each statement reads the driver's pre-registered views (lineitem, orders,
...) through the same crosswalk expressions the Spark side uses, then
states the query in plain SQL. Aggregated decimals are cast to DOUBLE and
small integers to BIGINT, as ``plans.output.finalize`` does on the Spark side.
"""

from __future__ import annotations

import datetime as dt

from churnlens.functions.dates import add_months
from churnlens.operators.rollup import MATERIAL_GROUP_COLUMNS, PRODUCT_HIERARCHY_COLUMNS
from churnlens.sources import fixtures as fx

AS_OF = dt.date(2001, 8, 1)
HIST_START = add_months(AS_OF, -24)
HIST_END = AS_OF
FORECAST_AT = add_months(AS_OF, -1)


def d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


SALES_SQL = (
    "(coalesce(VVR98,0)+coalesce(VVR99,0)+coalesce(VVR95,0)+coalesce(VVRR2,0)"
    "+coalesce(VVR03,0)+coalesce(VVR94,0)+coalesce(VVR88,0)+coalesce(VVRR1,0))"
    "-(coalesce(VVR93,0)+coalesce(VVR92,0)+coalesce(VVR89,0)+coalesce(VVR70,0))"
)
DED_SQL = "(coalesce(VVR93,0)+coalesce(VVR92,0)+coalesce(VVR89,0)+coalesce(VVR70,0))"


def base_cte(start: dt.date | None = HIST_START, end: dt.date | None = HIST_END) -> str:
    cond = "LAND1 = 'AU' AND PALEDGER = 2 AND AUART NOT LIKE '0CT%'"
    if start is not None:
        cond += f" AND BUDAT >= {d(start)}"
    if end is not None:
        cond += f" AND BUDAT < {d(end)}"
    return f"tx AS ({fx.LEDGER_SQL}),\nbase AS (SELECT *, {SALES_SQL} AS sales FROM tx WHERE {cond})"


def rollup_select(keys: str = "customer", detail: bool = False) -> str:
    mats = list(zip(fx.FIXTURE_MATERIAL_GROUPS, [n for _, n in MATERIAL_GROUP_COLUMNS]))
    prods = list(zip(fx.FIXTURE_PRODUCT_HIERARCHIES, [n for _, n in PRODUCT_HIERARCHY_COLUMNS]))
    if keys == "customer":
        head = "'PEA' || MANDT || '.' || BUKRS || '.' || KNDNR AS CUSTOMER_NUMBER"
        if not detail:
            head += ", '0' AS SHIP_TO"
        group = "KNDNR, MANDT, BUKRS, strftime(BUDAT, '%Y-%m')"
    else:
        head = "KNDNR AS CUSTOMER_NUMBER, KUNWE AS SHIP_TO"
        group = "KNDNR, KUNWE, strftime(BUDAT, '%Y-%m')"
    cols = [
        head,
        "count(DISTINCT ARTNR) AS CNTD_MATERIAL",
        "count(DISTINCT MATKL) AS MATERIAL_GROUP",
        "max(WWI06) AS INDUSTRY",
        "max(WWI04) AS INDUSTRY_SUBLEVEL",
        "max(VKORG) AS PLANT",
        "max(PERDE) AS POSTING_PERIOD",
    ]
    if detail:
        cols.append("max(USNAM) AS USERNAME")
    cols += [
        "CAST(max(BUDAT) - min(BUDAT) AS BIGINT) AS DAY_BETWEEN_POSTING",
        "strftime(BUDAT, '%Y-%m') AS POSTING_DATE",
        "count(DISTINCT CASE WHEN VVQ01_ME IN ('CMO','CDA') THEN BUDAT END) AS CNTD_RENTAL_POSTING_DATE",
        "count(DISTINCT BUDAT) AS CNTD_POSTING_DATE",
        "count(*) AS CNT_ALL" if detail else "count(BUDAT) AS CNT_POSTING_DATE",
        "CAST(trunc(avg(FADAT - WADAT)) AS BIGINT) AS AVG_DOCUMENT_ISSUE_DIFF",
        "CAST(trunc(avg(FADAT - BUDAT)) AS BIGINT) AS AVG_POST_ISSUE_DIFF",
        f"count(DISTINCT RPOSN) AS {'CNTD_REFERENCE_ITEMS' if detail else 'REFERENCE_ITEMS'}",
        f"count(DISTINCT KAUFN) AS {'CNTD_ORDER_NO' if detail else 'ORDER_NO'}",
        "CAST(sum(CASE WHEN VVQ01_ME = 'CDA' THEN coalesce(VVQ13,0) ELSE 0 END) AS DOUBLE) AS CCH",
        "CAST(sum(CASE WHEN VVQ01_ME <> 'CMO' AND VVQ01_ME <> 'CDA' THEN coalesce(VVQ13,0) ELSE 0 END) AS DOUBLE) AS SALE_QTY",
        "CAST(sum(CASE WHEN VVQ01_ME IN ('CMO','CDA') THEN coalesce(VVQ01,0) END) AS DOUBLE) AS RENTAL_BILLED_QTY",
        "CAST(sum(CASE WHEN VVQ01_ME <> 'CMO' AND VVQ01_ME <> 'CDA' THEN sales END) AS DOUBLE) AS PRODUCT_SALES",
        "CAST(sum(CASE WHEN VVQ01_ME IN ('CMO','CDA') THEN sales END) AS DOUBLE) AS RENTAL_SALES",
        "CAST(sum(CASE WHEN VVQ01_ME <> 'CMO' AND VVQ01_ME <> 'CDA' THEN VVR13 END) AS DOUBLE) AS DELIVERY",
        "count(CASE WHEN WWRCP LIKE 'D' THEN 1 END) AS DAILY_RENT",
        "count(CASE WHEN WWRCP = 'M' THEN 1 END) AS MONTHLY_RENT",
        "count(CASE WHEN WWRCP = 'Q' THEN 1 END) AS QUARTERLY_RENT",
        "count(CASE WHEN WWRCP = 'A' THEN 1 END) AS ANNUAL_RENT",
        "count(CASE WHEN WWRCP NOT IN ('A','D','M','Q') THEN 1 END) AS Other_Rent_Period",
        f"round(sum(CASE WHEN sales = 0 THEN 0.0 ELSE CAST({DED_SQL} AS DOUBLE) / CAST(sales AS DOUBLE) END), 3) AS DISCOUNT_RATIO",
    ]
    cols += [f"CAST(sum(CASE WHEN MATKL = '{c}' THEN sales END) AS DOUBLE) AS {n}" for c, n in mats]
    if keys == "customer":  # the ship-to form ends with the material groups
        cols += [f"CAST(sum(CASE WHEN PRODH = '{c}' THEN sales END) AS DOUBLE) AS {n}" for c, n in prods]
    return "SELECT " + ",\n  ".join(cols) + f"\nFROM base GROUP BY {group}"


def monthly_rollup_sql(keys: str = "customer") -> str:
    return f"WITH {base_cte()}\n{rollup_select(keys)}"


def material_set_sql() -> str:
    return (
        f"WITH {base_cte(HIST_START, None)},\n"
        f"main AS ({rollup_select('customer', detail=True)}),\n"
        "sets AS (SELECT 'PEA' || MANDT || '.' || BUKRS || '.' || KNDNR AS CUSTOMER_NUMBER,"
        " strftime(BUDAT, '%Y-%m') AS POSTING_DATE,"
        " string_agg(DISTINCT ARTNR, ', ' ORDER BY ARTNR) AS MATERIAL_SET"
        " FROM base GROUP BY ALL)\n"
        "SELECT main.*, sets.MATERIAL_SET FROM main LEFT JOIN sets USING (CUSTOMER_NUMBER, POSTING_DATE)"
    )


ORACLE: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql


register("monthly_rollup", monthly_rollup_sql("customer"))
register("monthly_rollup_shipto", monthly_rollup_sql("shipto"))
register("material_set", material_set_sql())


# --------------------------------------------------------------------------
# Panel and window features
# --------------------------------------------------------------------------
from churnlens.operators import panel as _panel  # noqa: E402

W_CUST = "(PARTITION BY CUSTOMER_SHIPTO ORDER BY POSTING_DATE)"


def panel_ctes() -> str:
    sums = _panel.PANEL_SUMS
    facts_cols = ", ".join(f"sum(coalesce(CAST({c} AS DOUBLE), 0.0)) AS {c}" for c in sums)
    fill_cols = ", ".join(f"coalesce(f.{c}, 0.0) AS {c}" for c in sums)
    return (
        f"{base_cte()},\nroll AS ({rollup_select('customer')}),\n"
        "facts AS (SELECT CAST(CUSTOMER_NUMBER AS VARCHAR) AS CUSTOMER_SHIPTO,"
        " CAST(strptime(POSTING_DATE, '%Y-%m') AS DATE) AS POSTING_DATE, "
        f"{facts_cols} FROM roll GROUP BY 1, 2),\n"
        "bounds AS (SELECT min(POSTING_DATE) AS lo, max(POSTING_DATE) AS hi FROM facts),\n"
        "months AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS POSTING_DATE FROM bounds),\n"
        "grid AS (SELECT c.CUSTOMER_SHIPTO, m.POSTING_DATE FROM (SELECT DISTINCT CUSTOMER_SHIPTO FROM facts) c CROSS JOIN months m),\n"
        f"panel AS (SELECT g.CUSTOMER_SHIPTO, g.POSTING_DATE, {fill_cols} FROM grid g LEFT JOIN facts f"
        " ON f.CUSTOMER_SHIPTO = g.CUSTOMER_SHIPTO AND f.POSTING_DATE = g.POSTING_DATE)"
    )


def easter_sql(y: str) -> str:
    a = f"({y} % 19)"
    b = f"({y} // 100)"
    c = f"({y} % 100)"
    dd = f"({b} // 4)"
    e = f"({b} % 4)"
    f = f"(({b} + 8) // 25)"
    g = f"(({b} - {f} + 1) // 3)"
    h = f"((19 * {a} + {b} - {dd} - {g} + 15) % 30)"
    i = f"({c} // 4)"
    k = f"({c} % 4)"
    ll = f"((32 + 2 * {e} + 2 * {i} - {h} - {k}) % 7)"
    m = f"(({a} + 11 * {h} + 22 * {ll}) // 451)"
    month = f"(({h} + {ll} - 7 * {m} + 114) // 31)"
    day = f"((({h} + {ll} - 7 * {m} + 114) % 31) + 1)"
    return f"make_date({y}, {month}, {day})"


# Month and day of the fixed-date holidays; the seven edge taps of a Gaussian
# of standard deviation 1.5, cut at four deviations, with mirrored edges.
_FIXED_DAYS = [(1, 1), (1, 26), (4, 25), (12, 25), (12, 26)]
_TAPS = [
    0.4789317857089249,
    0.3223087035023845,
    0.14533552302823932,
    0.04359175027030576,
    0.008625598774735838,
    0.0011174176467743013,
    8.922106863539231e-05,
]


def holiday_ctes() -> str:
    fixed = " UNION ALL ".join(f"SELECT make_date(y, {m}, {dd}) AS hdate FROM years" for m, dd in _FIXED_DAYS)
    return (
        "years AS (SELECT DISTINCT CAST(year(POSTING_DATE) AS INTEGER) AS y FROM panel),\n"
        f"cal AS ({fixed} UNION ALL SELECT CAST({easter_sql('y')} - INTERVAL 2 DAY AS DATE) FROM years"
        f" UNION ALL SELECT CAST({easter_sql('y')} + INTERVAL 1 DAY AS DATE) FROM years),\n"
        "hol AS (SELECT date_trunc('month', hdate)::DATE AS POSTING_DATE, count(DISTINCT hdate) AS Holidays FROM cal GROUP BY 1)"
    )


def kalman_ctes(q: float = 0.01, r: float = 1.0) -> str:
    nxt = f"((1.0 - f.pm / (f.pm + {r})) * f.pm + {q})"
    return (
        "kin AS (SELECT CUSTOMER_SHIPTO AS c, POSTING_DATE AS m, CCH AS y,"
        f" row_number() OVER {W_CUST} AS i, count(*) OVER (PARTITION BY CUSTOMER_SHIPTO) AS n FROM panel),\n"
        "fwd AS (SELECT c, i, n, y, CAST(1.0 AS DOUBLE) AS pm, y AS m FROM kin WHERE i = 1"
        f" UNION ALL SELECT k.c, k.i, k.n, k.y, {nxt} AS pm,"
        f" f.m + ({nxt} / ({nxt} + {r})) * (k.y - f.m) AS m"
        " FROM fwd f JOIN kin k ON k.c = f.c AND k.i = f.i + 1),\n"
        "bwd AS (SELECT c, i, m AS s FROM fwd WHERE i = n"
        f" UNION ALL SELECT f.c, f.i, f.m + (((1.0 - f.pm / (f.pm + {r})) * f.pm) / f2.pm) * (b.s - f.m)"
        " FROM bwd b JOIN fwd f ON f.c = b.c AND f.i = b.i - 1 JOIN fwd f2 ON f2.c = b.c AND f2.i = b.i),\n"
        "ks AS (SELECT kin.c AS CUSTOMER_SHIPTO, kin.m AS POSTING_DATE, bwd.s AS KS_filtered"
        " FROM kin JOIN bwd ON bwd.c = kin.c AND bwd.i = kin.i)"
    )


def lieu_ctes() -> str:
    """The calendar with a day in lieu of each weekend holiday, one after another: the first
    working day after the holiday and after the day before it in lieu."""
    return (
        holiday_ctes().split(",\nhol AS")[0] + ",\n"
        "hd AS (SELECT DISTINCT hdate FROM cal),\n"
        "free AS (SELECT day FROM (SELECT CAST(unnest(generate_series(min(hdate)::TIMESTAMP, max(hdate) + INTERVAL 60 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM hd)"
        " WHERE isodow(day) < 6 AND day NOT IN (SELECT hdate FROM hd)),\n"
        "lost AS (SELECT hdate, row_number() OVER (ORDER BY hdate) AS i FROM hd WHERE isodow(hdate) >= 6),\n"
        "lieu AS (SELECT CAST(0 AS BIGINT) AS i, DATE '1900-01-01' AS day UNION ALL"
        " SELECT lost.i, min(free.day) FROM lieu JOIN lost ON lost.i = lieu.i + 1 JOIN free ON free.day > lost.hdate AND free.day > lieu.day GROUP BY lost.i),\n"
        "hol AS (SELECT date_trunc('month', hdate)::DATE AS POSTING_DATE, count(*) AS Holidays"
        " FROM (SELECT hdate FROM hd UNION SELECT day FROM lieu WHERE i > 0) GROUP BY 1)"
    )


def features_ctes(holidays: str | None = None, tap: str = "oldest") -> str:
    period = " + ".join(f"lag(CCH, {11 - j if tap == 'oldest' else j}) OVER w * {x!r}" for j, x in enumerate(_TAPS))
    lags = ", ".join(
        f"lag({c}, {i}) OVER w AS {c}_lag_{i}" for c in _panel.LAG_COLUMNS for i in range(1, 7)
    )
    leads = ", ".join(
        f"lead({c}, {i}) OVER w AS {c}_shift_{i}" for c in ("CCH", "Smoothed_Holidays") for i in range(1, 7)
    )
    return (
        f"WITH RECURSIVE {panel_ctes()},\n{holidays or holiday_ctes()},\n{kalman_ctes()},\n"
        "ph AS (SELECT p.*, CAST(coalesce(hol.Holidays, 0) AS BIGINT) AS Holidays, ks.KS_filtered,"
        f" row_number() OVER {W_CUST} AS _i"
        " FROM panel p LEFT JOIN hol USING (POSTING_DATE) LEFT JOIN ks USING (CUSTOMER_SHIPTO, POSTING_DATE)),\n"
        "f1 AS (SELECT *, KS_filtered - lag(KS_filtered, 1) OVER w AS KSD0,"
        " CASE WHEN _i >= 12 THEN var_samp(CCH) OVER w12 END AS cv20,"
        " CASE WHEN _i >= 12 THEN var_samp(SALE_QTY) OVER w12 END AS cv2_sales0,"
        f" CASE WHEN _i >= 12 THEN {period} END AS period0,"
        " avg(Holidays) OVER w12 AS Smoothed_Holidays"
        " FROM ph WINDOW w AS " + W_CUST + ", w12 AS (PARTITION BY CUSTOMER_SHIPTO ORDER BY POSTING_DATE"
        " ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)),\n"
        "f2 AS (SELECT * EXCLUDE (KSD0, cv20, cv2_sales0, period0), coalesce(KSD0, 0.0) AS KSD,"
        " coalesce(cv20, 0.0) AS cv2, coalesce(cv2_sales0, 0.0) AS cv2_sales, coalesce(period0, 0.0) AS period FROM f1),\n"
        f"feat AS (SELECT * EXCLUDE (_i), {lags},"
        " CASE WHEN _i >= 3 THEN avg(CCH) OVER (PARTITION BY CUSTOMER_SHIPTO ORDER BY POSTING_DATE ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) END AS ROLL_MEAN_3,"
        " CASE WHEN _i >= 6 THEN avg(CCH) OVER (PARTITION BY CUSTOMER_SHIPTO ORDER BY POSTING_DATE ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) END AS ROLL_MEAN_6,"
        f" {leads}, CAST(lag(POSTING_DATE, 12) OVER w IS NOT NULL AS INTEGER) AS less12"
        " FROM f2 WINDOW w AS " + W_CUST + ")"
    )


def _r(c: str, digits: int = 6) -> str:
    return f"round({c}, {digits}) AS {c}"


register(
    "dense_panel",
    f"WITH {panel_ctes()}\nSELECT CUSTOMER_SHIPTO, POSTING_DATE, "
    + ", ".join(_r(c) for c in _panel.PANEL_SUMS)
    + " FROM panel",
)
register(
    "holiday_months",
    f"{features_ctes()}\nSELECT DISTINCT POSTING_DATE, Holidays, round(Smoothed_Holidays, 6) AS Smoothed_Holidays FROM feat",
)
register(
    "holiday_months_in_lieu",
    f"{features_ctes(lieu_ctes())}\nSELECT DISTINCT POSTING_DATE, Holidays, round(Smoothed_Holidays, 6) AS Smoothed_Holidays FROM feat",
)
register(
    "panel_lags",
    f"{features_ctes()}\nSELECT CUSTOMER_SHIPTO, POSTING_DATE, "
    + ", ".join(_r(f"{c}_lag_{i}") for c in _panel.LAG_COLUMNS for i in range(1, 7))
    + " FROM feat",
)
register(
    "panel_leads",
    f"{features_ctes()}\nSELECT CUSTOMER_SHIPTO, POSTING_DATE, "
    + ", ".join(_r(f"{c}_shift_{i}") for c in ("CCH", "Smoothed_Holidays") for i in range(1, 7))
    + " FROM feat",
)
register(
    "rolling_means",
    f"{features_ctes()}\nSELECT CUSTOMER_SHIPTO, POSTING_DATE, {_r('ROLL_MEAN_3')}, {_r('ROLL_MEAN_6')} FROM feat",
)
register(
    "rolling_var",
    f"{features_ctes()}\nSELECT CUSTOMER_SHIPTO, POSTING_DATE, {_r('cv2', 4)}, {_r('cv2_sales', 4)} FROM feat",
)
register(
    "gauss_period",
    f"{features_ctes()},\npd AS (SELECT CUSTOMER_SHIPTO, POSTING_DATE, period,"
    " coalesce(period - lag(period, 1) OVER w, 0.0) AS period_diff FROM feat WINDOW w AS " + W_CUST + ")\n"
    "SELECT CUSTOMER_SHIPTO, POSTING_DATE, round(period, 6) AS period, round(period_diff, 6) AS period_diff,"
    " CAST(CASE WHEN period_diff <= -3 THEN -3 WHEN period_diff <= -2 THEN -2 WHEN period_diff <= -1 THEN -1"
    " WHEN period_diff <= 0.5 THEN 0 WHEN period_diff <= 1.5 THEN 1 WHEN period_diff <= 2.5 THEN 2"
    " WHEN period_diff > 2.5 THEN 3 ELSE 0 END AS BIGINT) AS miss_period FROM pd",
)
register(
    "gauss_period_latest",
    f"{features_ctes(tap='latest')},\npd AS (SELECT CUSTOMER_SHIPTO, POSTING_DATE, period,"
    " coalesce(period - lag(period, 1) OVER w, 0.0) AS period_diff FROM feat WINDOW w AS " + W_CUST + ")\n"
    "SELECT CUSTOMER_SHIPTO, POSTING_DATE, round(period, 6) AS period, round(period_diff, 6) AS period_diff,"
    " CAST(CASE WHEN period_diff <= -3 THEN -3 WHEN period_diff <= -2 THEN -2 WHEN period_diff <= -1 THEN -1"
    " WHEN period_diff <= 0.5 THEN 0 WHEN period_diff <= 1.5 THEN 1 WHEN period_diff <= 2.5 THEN 2"
    " WHEN period_diff > 2.5 THEN 3 ELSE 0 END AS BIGINT) AS miss_period FROM pd",
)
register(
    "less12",
    f"{features_ctes()}\nSELECT CUSTOMER_SHIPTO, POSTING_DATE, CAST(less12 AS BIGINT) AS less12 FROM feat",
)
register(
    "kalman_level",
    f"{features_ctes()}\nSELECT CUSTOMER_SHIPTO, POSTING_DATE, {_r('KS_filtered')}, {_r('KSD')} FROM feat",
)


# --------------------------------------------------------------------------
# Forecast, trend fit, scaffold, backtest
# --------------------------------------------------------------------------
import math as _math  # noqa: E402


def sample_ctes(src: str, keys: str, anchor: str, horizon: int = 6, min_nonzero: int = 3) -> str:
    """Samples y_T + y_{t+h} - y_t of history rows (month <= anchor)."""
    leads = ", ".join(f"lead(CCH, {h}) OVER w AS l{h}" for h in range(1, horizon + 1))
    acts = ", ".join(
        f"max(CASE WHEN POSTING_DATE = CAST({anchor} + INTERVAL {h} MONTH AS DATE) THEN CCH END) OVER p AS a{h}"
        for h in range(1, horizon + 1)
    )
    smp = " UNION ALL ".join(
        f"SELECT {keys}, _anchor, {h} AS h, CASE WHEN CAST(POSTING_DATE + INTERVAL {h} MONTH AS DATE) <= _anchor"
        f" THEN yT + l{h} - CCH END AS sample, a{h} AS actual FROM s WHERE POSTING_DATE <= _anchor AND nz >= {min_nonzero}"
        for h in range(1, horizon + 1)
    )
    return (
        f"s AS (SELECT {keys}, POSTING_DATE, CCH, {anchor} AS _anchor,"
        f" max(CASE WHEN POSTING_DATE = {anchor} THEN CCH END) OVER p AS yT,"
        f" count(CASE WHEN POSTING_DATE <= {anchor} AND CCH <> 0 THEN 1 END) OVER p AS nz, {leads}, {acts}"
        f" FROM {src} WINDOW p AS (PARTITION BY {keys}), w AS (PARTITION BY {keys} ORDER BY POSTING_DATE)),\n"
        f"smp AS ({smp}),\n"
        f"lng AS (SELECT {keys}, _anchor AS anchor, 'period_' || CAST(h AS VARCHAR) AS PERIOD, avg(sample) AS sample_mean,"
        " quantile_cont(sample, 0.25) AS lower_bound, quantile_cont(sample, 0.75) AS upper_bound, max(actual) AS actual"
        f" FROM smp GROUP BY {keys}, _anchor, h HAVING count(sample) > 0)"
    )


def forecast_ctes() -> str:
    stats = ("sample_mean", "lower_bound", "upper_bound")
    piv = ", ".join(
        f"max(CASE WHEN PERIOD = 'period_{h}' THEN {s} END) AS period_{h}_{s}" for h in range(1, 7) for s in stats
    )
    unc = ", ".join(f"period_{h}_upper_bound - period_{h}_lower_bound AS period_{h}_uncertainty" for h in range(1, 7))
    return (
        f"{features_ctes()},\n"
        f"hist AS (SELECT CUSTOMER_SHIPTO, POSTING_DATE, CCH FROM feat WHERE POSTING_DATE <= {d(FORECAST_AT)}),\n"
        f"{sample_ctes('hist', 'CUSTOMER_SHIPTO', d(FORECAST_AT))},\n"
        f"wide0 AS (SELECT CUSTOMER_SHIPTO, {piv} FROM lng GROUP BY CUSTOMER_SHIPTO),\n"
        f"wide AS (SELECT *, {unc}, {d(FORECAST_AT)} AS PREDICTION_DATE FROM wide0)"
    )


def linregress_sql(points: list[str]) -> dict[str, str]:
    n = len(points)
    xbar = (n - 1) / 2.0
    sxx = n * (n * n - 1) / 12.0
    ybar = f"(({' + '.join(points)}) / {float(n)!r})"
    sxy = " + ".join(f"{p} * {float(i - xbar)!r}" for i, p in enumerate(points))
    syy = " + ".join(f"({p} - {ybar}) * ({p} - {ybar})" for p in points)
    slope = f"(({sxy}) / {sxx!r})"
    intercept = f"({ybar} - {slope} * {xbar!r})"
    r0 = f"(CASE WHEN ({syy}) = 0 THEN 0.0 ELSE ({sxy}) / sqrt({sxx!r} * ({syy})) END)"
    r = f"least(greatest({r0}, -1.0), 1.0)"
    nu = n - 2
    t = f"({r} * sqrt({float(nu)!r} / ((1.0 - {r}) * (1.0 + {r}))))"
    theta = f"atan(abs({t}) / {_math.sqrt(nu)!r})"
    terms, coef = [], 1.0
    for k in range((nu - 1) // 2):
        if k > 0:
            coef *= (2 * k) / (2 * k + 1)
        terms.append(f"{coef!r} * pow(cos({theta}), {2 * k + 1})")
    inner = f"({theta} + sin({theta}) * ({' + '.join(terms)}))" if terms else theta
    p = f"(CASE WHEN abs({r}) >= 1.0 THEN 0.0 ELSE 1.0 - {2.0 / _math.pi!r} * {inner} END)"
    return {"slope": slope, "intercept": intercept, "p": p}


def fit_ctes() -> str:
    preds = ", ".join(f"period_{h}_sample_mean AS pred{h}" for h in range(1, 7))
    lr = linregress_sql(["CCH_lag_1", "CCH", "pred1", "pred2", "pred3"])
    return (
        f"{forecast_ctes()},\n"
        f"sf AS (SELECT f.*, w.* EXCLUDE (CUSTOMER_SHIPTO), {preds} FROM wide w JOIN feat f ON f.CUSTOMER_SHIPTO = w.CUSTOMER_SHIPTO"
        " WHERE f.POSTING_DATE = (SELECT max(POSTING_DATE) FROM feat)),\n"
        "fit AS (SELECT CUSTOMER_SHIPTO, POSTING_DATE, CCH, CCH_lag_1, CCH_lag_2,"
        f" {lr['slope']} AS slope,"
        f" CASE WHEN greatest(CCH_lag_1, CCH) <> 0 THEN {lr['slope']} / greatest(CCH_lag_1, CCH) ELSE 0.0 END AS percent_decline,"
        f" greatest(CCH_lag_1, CCH) AS max_cch, {lr['p']} AS p_value,"
        f" CASE WHEN {lr['slope']} < 0 THEN abs({lr['intercept']} / {lr['slope']}) END AS cross_zero,"
        " CCH_lag_1 - CCH AS drop, pred1, pred2, pred3, pred4, pred5, pred6 FROM sf),\n"
        "scaffold AS (SELECT CUSTOMER_SHIPTO, POSTING_DATE, a.CCH, m.value, coalesce(m.value, a.CCH) AS predicted"
        " FROM (SELECT CUSTOMER_SHIPTO, POSTING_DATE, CCH FROM feat) a FULL OUTER JOIN ("
        + " UNION ALL ".join(
            f"SELECT CUSTOMER_SHIPTO, CAST(POSTING_DATE + INTERVAL {h} MONTH AS DATE) AS POSTING_DATE, pred{h} AS value FROM fit"
            for h in range(1, 7)
        )
        + ") m USING (CUSTOMER_SHIPTO, POSTING_DATE))"
    )


def _round_all(cols: list[str], digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)


_STATS = [f"period_{h}_{s}" for h in range(1, 7) for s in ("sample_mean", "lower_bound", "upper_bound")]
register(
    "forecast_quantiles",
    f"{forecast_ctes()}\nSELECT CUSTOMER_SHIPTO, PERIOD, {_round_all(['sample_mean', 'lower_bound', 'upper_bound'])} FROM lng",
)
register(
    "forecast_wide",
    f"{forecast_ctes()}\nSELECT CUSTOMER_SHIPTO, "
    + _round_all(_STATS + [f"period_{h}_uncertainty" for h in range(1, 7)])
    + ", PREDICTION_DATE FROM wide",
)
register(
    "trend_fit",
    f"{fit_ctes()}\nSELECT CUSTOMER_SHIPTO, POSTING_DATE, "
    + _round_all(["CCH", "CCH_lag_1", "CCH_lag_2", "slope", "percent_decline", "max_cch", "p_value", "cross_zero", "drop"]
                 + [f"pred{h}" for h in range(1, 7)])
    + " FROM fit",
)
_lr9 = linregress_sql(["CCH_lag_2", "CCH_lag_1", "CCH"] + [f"pred{h}" for h in range(1, 7)])
register(
    "trend_fit9",
    f"{fit_ctes()},\nf9 AS (SELECT CUSTOMER_SHIPTO, {_lr9['slope']} AS slope9,"
    f" CASE WHEN greatest(CCH_lag_2, CCH_lag_1, CCH) <> 0 THEN {_lr9['slope']} / greatest(CCH_lag_2, CCH_lag_1, CCH) END AS percent_decline9,"
    f" greatest(CCH_lag_2, CCH_lag_1, CCH) AS max_cch9, {_lr9['p']} AS p_value9,"
    f" CASE WHEN {_lr9['slope']} < 0 THEN abs({_lr9['intercept']} / {_lr9['slope']}) END AS cross_zero9,"
    " CCH_lag_1 - CCH AS drop9 FROM fit)\n"
    "SELECT CUSTOMER_SHIPTO, " + _round_all(["slope9", "percent_decline9", "max_cch9", "p_value9", "cross_zero9", "drop9"]) + " FROM f9",
)
register(
    "score_scaffold",
    f"{fit_ctes()}\nSELECT CUSTOMER_SHIPTO, POSTING_DATE, " + _round_all(["CCH", "value", "predicted"]) + " FROM scaffold",
)
register(
    "mean_shift",
    f"{fit_ctes()},\n"
    "ser AS (SELECT CUSTOMER_SHIPTO, predicted AS v, row_number() OVER (PARTITION BY CUSTOMER_SHIPTO ORDER BY POSTING_DATE) AS i,"
    " count(*) OVER (PARTITION BY CUSTOMER_SHIPTO) AS n FROM scaffold WHERE predicted IS NOT NULL),\n"
    "mb AS (SELECT CUSTOMER_SHIPTO,"
    " avg(CASE WHEN (n > 24 AND i > n - 24 AND i <= n - 12) OR (n <= 24 AND i <= n // 2) THEN v END) AS mean_before,"
    " avg(CASE WHEN (n > 24 AND i > n - 12) OR (n <= 24 AND i > n // 2) THEN v END) AS mean_after FROM ser GROUP BY 1),\n"
    "ms AS (SELECT fit.CUSTOMER_SHIPTO, mb.mean_before, mb.mean_after FROM fit LEFT JOIN mb USING (CUSTOMER_SHIPTO))\n"
    "SELECT CUSTOMER_SHIPTO, round(coalesce(mean_before, 0), 6) AS mean_before, round(coalesce(mean_after, 0), 6) AS mean_after,"
    " round(CASE WHEN mean_before IS NULL OR mean_after IS NULL THEN 0.0"
    " WHEN mean_before = 0 AND mean_after <> mean_before THEN -100.0 WHEN mean_before = 0 THEN 0.0"
    " ELSE (mean_after - mean_before) / mean_before END, 6) AS magnitute_drop FROM ms",
)
register(
    "backtest_error",
    f"{features_ctes()},\n"
    "anchors AS (SELECT CAST(unnest(generate_series(min(POSTING_DATE) + INTERVAL 6 MONTH,"
    " max(POSTING_DATE) - INTERVAL 4 MONTH, INTERVAL 1 MONTH)) AS DATE) AS anchor FROM feat),\n"
    "rows AS (SELECT f.CUSTOMER_SHIPTO, a.anchor AS _a, f.POSTING_DATE, f.CCH FROM feat f JOIN anchors a"
    " ON f.POSTING_DATE <= CAST(a.anchor + INTERVAL 6 MONTH AS DATE)),\n"
    f"{sample_ctes('rows', 'CUSTOMER_SHIPTO, _a', '_a')}\n"
    "SELECT anchor, PERIOD, count(*) AS n, round(avg(abs(actual - sample_mean)), 6) AS mae,"
    " round(sqrt(avg((actual - sample_mean) * (actual - sample_mean))), 6) AS rmse,"
    " round(avg(CASE WHEN actual >= lower_bound AND actual <= upper_bound THEN 1.0 ELSE 0.0 END), 6) AS coverage"
    " FROM lng WHERE actual IS NOT NULL GROUP BY anchor, PERIOD",
)


# --------------------------------------------------------------------------
# Next-best-action snapshots
# --------------------------------------------------------------------------
_NBA_ANCHORS = [dt.date(2001, 8, 1), dt.date(2001, 7, 1), dt.date(2001, 6, 1), dt.date(2001, 5, 1)]
_C = fx.FIXTURE_DELIVERY_CODES


def T_(i: int, a: str = "a.SNAPSHOT") -> str:
    return f"CAST({a} - INTERVAL {i} MONTH AS DATE)"


def _in(col: str, vals) -> str:
    return f"{col} IN (" + ", ".join(f"'{v}'" for v in vals) + ")"


def nba_ctes() -> str:
    anchors = ", ".join(f"({d(x)})" for x in _NBA_ANCHORS)
    offs = list(range(7, 13))
    cust = ", ".join(
        [f"sum(CASE WHEN VVQ01_ME = 'CDA' THEN coalesce(VVQ13, 0) ELSE 0 END) AS CCH"]
        + [f"sum(CASE WHEN VVQ01_ME = 'CDA' AND date_trunc('month', BUDAT) = {T_(k)} THEN coalesce(VVQ13, 0) ELSE 0 END) AS T_{i}_CCH"
           for i, k in enumerate(offs, 1)]
        + [f"sum(CASE WHEN VVQ01_ME <> 'CMO' AND VVQ01_ME <> 'CDA' THEN {SALES_SQL} END) AS PRODUCT_SALES"]
        + [f"sum(CASE WHEN VVQ01_ME <> 'CMO' AND VVQ01_ME <> 'CDA' AND date_trunc('month', BUDAT) = {T_(k)} THEN {SALES_SQL} END) AS T_{i}_PRODUCT_SALES"
           for i, k in enumerate(offs, 1)]
    )
    prof = ", ".join(
        ["CAST(trunc(avg(gap)) AS BIGINT) AS AVG_TIME_DELIVERY"]
        + [f"CAST(trunc(avg(DISTINCT CASE WHEN date_trunc('month', LDDAT) = {T_(k, 'SNAPSHOT')} THEN gap END)) AS BIGINT) AS T_{i}_TIME_DELIVERY"
           for i, k in enumerate(offs, 1)]
        + ["count(DISTINCT ROUTE) AS CNTD_ROUTE"]
        + [f"count(DISTINCT CASE WHEN {_in(col, _C[key])} THEN VBELN END) AS {name}" for col, key, name in [
            ("TRAGR", "dangerous", "CNTD_DANGEROUS"), ("TRAGR", "general", "CNTD_GENERAL"), ("TRAGR", "air", "CNTD_AIR"),
            ("TRAGR", "sea", "CNTD_SEA"), ("TRAGR", "waterway", "CNTD_WATERWAY"), ("LFART", "debit", "CNTD_DEBIT_ITEMS"),
            ("LFART", "consignment", "CNTD_CONSIGNMENT"), ("LFART", "standard", "CNTD_STANDARD"),
            ("LFART", "thirdparty", "CNTD_THIRDPARTY")]]
        + [f"count(DISTINCT CASE WHEN KDGRP = '{_C['kdgrp_d0']}' THEN VBELN END) AS CNTD_D0_KDGRP",
           "count(DISTINCT CASE WHEN KDGRP IS NULL THEN VBELN END) AS CNTD_NULL_KDGRP",
           f"count(DISTINCT CASE WHEN KDGRP = '{_C['kdgrp_gf']}' THEN VBELN END) AS CNTD_GF_KDGRP"]
    )
    return (
        f"tx AS ({fx.LEDGER_SQL}),\ndl AS ({fx.DELIVERY_SQL}),\nit AS ({fx.ITEM_SQL}),\n"
        f"anchors AS (SELECT * FROM (VALUES {anchors}) t(SNAPSHOT)),\n"
        "mapping AS (SELECT a.SNAPSHOT, t.KNDNR, t.KNDNR AS KUNWE, d.VBELN, d.KUNNR FROM tx t"
        f" JOIN anchors a ON t.BUDAT >= {T_(6)} AND t.BUDAT < {T_(0)}"
        f" JOIN dl d ON d.KUNNR = t.KNDNR AND d.LDDAT >= {T_(6)} AND d.LDDAT < {T_(0)}"
        " WHERE t.LAND1 = 'AU' GROUP BY ALL),\n"
        f"cust AS (SELECT a.SNAPSHOT, t.KNDNR, {cust} FROM tx t JOIN anchors a ON t.BUDAT >= {T_(18)} AND t.BUDAT < {T_(12)}"
        " WHERE t.LAND1 = 'AU' AND EXISTS (SELECT 1 FROM mapping m WHERE m.SNAPSHOT = a.SNAPSHOT AND m.KNDNR = t.KNDNR)"
        " GROUP BY a.SNAPSHOT, t.KNDNR),\n"
        "dlw AS (SELECT a.SNAPSHOT, d.*, coalesce(CAST(d.LDDAT - lag(d.LDDAT) OVER (PARTITION BY a.SNAPSHOT, d.KUNNR"
        f" ORDER BY d.LDDAT, d.VBELN) AS BIGINT), 0) AS gap FROM dl d JOIN anchors a ON d.LDDAT >= {T_(18)} AND d.LDDAT < {T_(6)}),\n"
        f"prof AS (SELECT SNAPSHOT, KUNNR, {prof} FROM dlw GROUP BY SNAPSHOT, KUNNR),\n"
        "itm AS (SELECT a.SNAPSHOT, CAST(date_trunc('month', i.ERDAT) AS DATE) AS mth, i.* FROM it i JOIN anchors a"
        f" ON i.ERDAT >= {T_(18)} AND i.ERDAT < {T_(6)}),\n"
        "im AS (SELECT SNAPSHOT, VBELN, mth, sum(LGMNG) AS mth_stock_diff, max(LGMNG) AS mth_max_stock_diff,"
        " min(LGMNG) AS mth_min_stock_diff,"
        " count(DISTINCT CASE WHEN MVGR1 IS NULL THEN VGBEL END) AS CNTD_NULL_DIFOT,"
        " count(DISTINCT CASE WHEN MVGR1 IS NOT NULL THEN VGBEL END) AS CNTD_DIFOT,"
        " count(DISTINCT CASE WHEN MVGR1 = 'Z08' THEN VGBEL END) AS CNTD_Z08DIFOT,"
        " count(DISTINCT CASE WHEN MVGR1 = 'Z01' THEN VGBEL END) AS CNTD_Z01DIFOT,"
        " count(DISTINCT CASE WHEN MVGR1 = 'P07' THEN VGBEL END) AS CNTD_P07DIFOT,"
        " count(DISTINCT ERDAT) AS CNTD_MTH_DATES, count(DISTINCT VGBEL) AS CNTD_MTH_ENTRIES,"
        " sum(CASE WHEN GEWEI = 'KG' THEN BRGEW END) AS SUM_MTH_VOL_KG,"
        " sum(CASE WHEN MEINS = 'CYL' THEN LFIMG END) AS SUM_MTH_LFIMG_CYL,"
        " sum(CASE WHEN VOLEH = 'M3' THEN VOLUM END) AS SUM_MTH_VOLUM_M3,"
        " count(DISTINCT MATNR) AS CNTD_MATNR, count(DISTINCT MATKL) AS CNTD_MATKL, count(DISTINCT VBELN) AS CNTD_SHIPTO"
        " FROM itm GROUP BY SNAPSHOT, VBELN, mth),\n"
        "items AS (SELECT SNAPSHOT, VBELN, avg(mth_stock_diff) AS AVG_STOCK_DIFF, max(mth_max_stock_diff) AS MAX_STOCK_DIFF,"
        " min(mth_min_stock_diff) AS MIN_STOCK_DIFF, sum(CNTD_NULL_DIFOT) AS SUM_NULL_DIFOT, sum(CNTD_DIFOT) AS SUM_DIFOT,"
        " sum(CNTD_Z08DIFOT) AS SUM_Z08DIFOT, CAST(trunc(avg(CNTD_NULL_DIFOT)) AS BIGINT) AS AVG_NULL_DIFOT,"
        " CAST(trunc(avg(CNTD_DIFOT)) AS BIGINT) AS AVG_DIFOT, CAST(trunc(avg(CNTD_Z08DIFOT)) AS BIGINT) AS AVG_Z08DIFOT,"
        " CAST(trunc(avg(CNTD_Z01DIFOT)) AS BIGINT) AS AVG_Z01DIFOT, CAST(trunc(avg(CNTD_P07DIFOT)) AS BIGINT) AS AVG_P07DIFOT,"
        " CAST(trunc(avg(CNTD_MTH_DATES)) AS BIGINT) AS AVG_MTH_DATES, CAST(trunc(avg(CNTD_MTH_ENTRIES)) AS BIGINT) AS AVG_MTH_ENTRIES,"
        " sum(coalesce(SUM_MTH_VOL_KG, 0)) AS SUM_MTH_VOL_KG, sum(coalesce(SUM_MTH_LFIMG_CYL, 0)) AS SUM_MTH_LFIMG_CYL,"
        " sum(coalesce(SUM_MTH_VOLUM_M3, 0)) AS SUM_MTH_VOLUM_M3, sum(coalesce(CNTD_MATNR, 0)) AS CNTD_MATNR,"
        " sum(coalesce(CNTD_MATKL, 0)) AS CNTD_MATKL, CAST(trunc(avg(coalesce(CNTD_MATNR, 0))) AS BIGINT) AS AVG_MATNR,"
        " CAST(trunc(avg(coalesce(CNTD_MATKL, 0))) AS BIGINT) AS AVG_MATKL, sum(coalesce(CNTD_SHIPTO, 0)) AS CNTD_SHIPTO, "
        + ", ".join(f"sum(CASE WHEN mth = {T_(k, 'SNAPSHOT')} THEN CNTD_MTH_ENTRIES ELSE 0 END) AS T_{i}_ENTRIES" for i, k in enumerate(offs, 1))
        + " FROM im GROUP BY SNAPSHOT, VBELN),\n"
        "newi AS (SELECT a.SNAPSHOT, p.VBELN, count(DISTINCT p.MATNR) AS NEW_MATNR, count(DISTINCT p.MATKL) AS NEW_MATKL,"
        f" count(DISTINCT p.VGBEL) AS NEW_ENTRIES FROM it p JOIN anchors a ON p.ERDAT >= {T_(6)} AND p.ERDAT < {T_(0)}"
        f" WHERE NOT EXISTS (SELECT 1 FROM it o WHERE o.ERDAT >= {T_(18)} AND o.ERDAT < {T_(6)}"
        " AND o.VBELN = p.VBELN AND o.MATNR = p.MATNR AND o.MATKL = p.MATKL AND o.VGBEL = p.VGBEL)"
        " GROUP BY a.SNAPSHOT, p.VBELN)"
    )


def _cast_cols(cols: list[str], bigints: set[str]) -> str:
    return ", ".join(
        f"CAST({c} AS BIGINT) AS {c}" if c in bigints else f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in cols
    )


_OFF = range(1, 7)
_CUST_COLS = ["CCH"] + [f"T_{i}_CCH" for i in _OFF] + ["PRODUCT_SALES"] + [f"T_{i}_PRODUCT_SALES" for i in _OFF]
register("nba_mapping", f"WITH {nba_ctes()}\nSELECT SNAPSHOT, KNDNR, KUNWE, VBELN, KUNNR FROM mapping")
register("nba_customer", f"WITH {nba_ctes()}\nSELECT SNAPSHOT, KNDNR, {_cast_cols(_CUST_COLS, set())} FROM cust")
_PROF_COLS = (["AVG_TIME_DELIVERY"] + [f"T_{i}_TIME_DELIVERY" for i in _OFF] + ["CNTD_ROUTE", "CNTD_DANGEROUS", "CNTD_GENERAL",
              "CNTD_AIR", "CNTD_SEA", "CNTD_WATERWAY", "CNTD_DEBIT_ITEMS", "CNTD_CONSIGNMENT", "CNTD_STANDARD",
              "CNTD_THIRDPARTY", "CNTD_D0_KDGRP", "CNTD_NULL_KDGRP", "CNTD_GF_KDGRP"])
register("nba_delivery_profile", f"WITH {nba_ctes()}\nSELECT SNAPSHOT, KUNNR, {_cast_cols(_PROF_COLS, set(_PROF_COLS))} FROM prof")
_ITEM_DOUBLE = ["AVG_STOCK_DIFF", "MAX_STOCK_DIFF", "MIN_STOCK_DIFF", "SUM_MTH_VOL_KG", "SUM_MTH_LFIMG_CYL", "SUM_MTH_VOLUM_M3"]
_ITEM_INT = (["SUM_NULL_DIFOT", "SUM_DIFOT", "SUM_Z08DIFOT", "AVG_NULL_DIFOT", "AVG_DIFOT", "AVG_Z08DIFOT", "AVG_Z01DIFOT",
              "AVG_P07DIFOT", "AVG_MTH_DATES", "AVG_MTH_ENTRIES", "CNTD_MATNR", "CNTD_MATKL", "AVG_MATNR", "AVG_MATKL",
              "CNTD_SHIPTO"] + [f"T_{i}_ENTRIES" for i in _OFF])
register("nba_items", f"WITH {nba_ctes()}\nSELECT SNAPSHOT, VBELN, {_cast_cols(_ITEM_DOUBLE + _ITEM_INT, set(_ITEM_INT))} FROM items")
register("nba_new_items", f"WITH {nba_ctes()}\nSELECT SNAPSHOT, VBELN, NEW_MATNR, NEW_MATKL, NEW_ENTRIES FROM newi")

_SNAP_SUM = (["CCH"] + [f"T_{i}_CCH" for i in _OFF] + ["PRODUCT_SALES"] + [f"T_{i}_PRODUCT_SALES" for i in _OFF])
_SNAP_AVG = ["CCH"] + [f"T_{i}_CCH" for i in _OFF] + [f"T_{i}_PRODUCT_SALES" for i in _OFF]
_SNAP_CNT = ["NEW_MATNR", "NEW_MATKL", "NEW_ENTRIES", "CNTD_DANGEROUS", "CNTD_GENERAL", "CNTD_AIR", "CNTD_SEA",
             "CNTD_WATERWAY", "CNTD_DEBIT_ITEMS", "CNTD_CONSIGNMENT", "CNTD_STANDARD", "CNTD_THIRDPARTY",
             "CNTD_D0_KDGRP", "CNTD_NULL_KDGRP", "CNTD_GF_KDGRP"]


def nba_snapshot_sql() -> str:
    cols = [f"round(CAST(sum(c.{x}) AS DOUBLE), 6) AS {x}" for x in _SNAP_SUM]
    cols += [f"round(CAST(avg(c.{x}) AS DOUBLE), 6) AS AVG_{x}" for x in _SNAP_AVG]
    cols += [f"CAST(sum({x}) AS BIGINT) AS {x}" for x in _SNAP_CNT]
    cols += [
        "CAST(trunc(avg(p.AVG_TIME_DELIVERY)) AS BIGINT) AS TIME_DELIVERY",
        "CAST(sum(coalesce(i.CNTD_MATNR, 0)) AS BIGINT) AS CNTD_MATNR",
        "CAST(sum(coalesce(i.CNTD_MATKL, 0)) AS BIGINT) AS CNTD_MATKL",
        "CAST(trunc(avg(coalesce(i.CNTD_MATNR, 0))) AS BIGINT) AS AVG_MATNR",
        "CAST(trunc(avg(coalesce(i.CNTD_MATKL, 0))) AS BIGINT) AS AVG_MATKL",
        "CAST(sum(coalesce(i.CNTD_SHIPTO, 0)) AS BIGINT) AS CNTD_SHIPTO",
    ]
    cols += [f"CAST(sum(coalesce(i.T_{k}_ENTRIES, 0)) AS BIGINT) AS T_{k}_ENTRIES" for k in _OFF]
    return (
        f"WITH {nba_ctes()}\nSELECT m.SNAPSHOT, m.KNDNR AS CUSTOMER_NUMBER, " + ", ".join(cols)
        + " FROM mapping m LEFT JOIN newi n ON n.SNAPSHOT = m.SNAPSHOT AND n.VBELN = m.VBELN"
        " JOIN prof p ON p.SNAPSHOT = m.SNAPSHOT AND p.KUNNR = m.KUNNR"
        " JOIN cust c ON c.SNAPSHOT = m.SNAPSHOT AND c.KNDNR = m.KNDNR"
        " JOIN items i ON i.SNAPSHOT = m.SNAPSHOT AND i.VBELN = m.VBELN"
        " GROUP BY m.SNAPSHOT, m.KNDNR"
    )


register("nba_snapshot", nba_snapshot_sql())
register("nba_snapshot_table", nba_snapshot_sql())


def shared_shiptos(sql: str) -> str:
    """The mapping by the ledger's own ship-to, which customers share."""
    return sql.replace("t.KNDNR AS KUNWE", "t.KUNWE").replace("d.KUNNR = t.KNDNR", "d.KUNNR = t.KUNWE")


for _name in ("nba_mapping", "nba_customer", "nba_snapshot"):
    register(f"{_name}_shared", shared_shiptos(ORACLE[_name]))


def nba_dedup_sql() -> str:
    """Each grain by itself: customers, (customer, ship-to) pairs, deliveries."""
    profile = [x for x in _SNAP_CNT if not x.startswith("NEW_")]
    cust = [f"round(CAST(max(c.{x}) AS DOUBLE), 6) AS {x}" for x in _SNAP_SUM]
    cust += [f"round(CAST(max(c.{x}) AS DOUBLE), 6) AS AVG_{x}" for x in _SNAP_AVG]
    per_pair = [f"CAST(sum(p.{x}) AS BIGINT) AS {x}" for x in profile] + ["CAST(trunc(avg(p.AVG_TIME_DELIVERY)) AS BIGINT) AS TIME_DELIVERY"]
    per_row = [f"CAST(sum(n.{x}) AS BIGINT) AS {x}" for x in ("NEW_MATNR", "NEW_MATKL", "NEW_ENTRIES")]
    per_row += [f"CAST(sum(coalesce(i.{x}, 0)) AS BIGINT) AS {x}" for x in ["CNTD_MATNR", "CNTD_MATKL", "CNTD_SHIPTO"] + [f"T_{k}_ENTRIES" for k in _OFF]]
    per_row += [f"CAST(trunc(avg(coalesce(i.CNTD_{x}, 0))) AS BIGINT) AS AVG_{x}" for x in ("MATNR", "MATKL")]
    key = "SNAPSHOT, CUSTOMER_NUMBER"
    return shared_shiptos(
        f"WITH {nba_ctes()},\n"
        "live AS (SELECT m.SNAPSHOT, m.KNDNR AS CUSTOMER_NUMBER, m.KUNNR, m.VBELN FROM mapping m"
        " JOIN prof p ON p.SNAPSHOT = m.SNAPSHOT AND p.KUNNR = m.KUNNR JOIN cust c ON c.SNAPSHOT = m.SNAPSHOT AND c.KNDNR = m.KNDNR"
        " JOIN items i ON i.SNAPSHOT = m.SNAPSHOT AND i.VBELN = m.VBELN),\n"
        f"byc AS (SELECT {key}, {', '.join(cust)} FROM (SELECT DISTINCT {key} FROM live) l"
        " JOIN cust c USING (SNAPSHOT) WHERE c.KNDNR = l.CUSTOMER_NUMBER GROUP BY ALL),\n"
        f"byp AS (SELECT {key}, {', '.join(per_pair)} FROM (SELECT DISTINCT {key}, KUNNR FROM live) l JOIN prof p USING (SNAPSHOT, KUNNR) GROUP BY {key}),\n"
        f"byr AS (SELECT {key}, {', '.join(per_row)} FROM live l JOIN items i USING (SNAPSHOT, VBELN) LEFT JOIN newi n USING (SNAPSHOT, VBELN) GROUP BY {key})\n"
        f"SELECT * FROM byc JOIN byp USING ({key}) JOIN byr USING ({key})"
    )


register("nba_snapshot_dedup", nba_dedup_sql())


# --------------------------------------------------------------------------
# CRM feed
# --------------------------------------------------------------------------
def crm_ctes() -> str:
    views = ",\n".join(f"{k} AS ({v})" for k, v in fx.CRM_SQL_VIEWS.items())
    return (
        f"{views},\n"
        "fb AS (SELECT NEW_COMPLAINT, string_agg('-' || coalesce(NEW_BRIEFDESCRIPTION, ''), chr(10)"
        " ORDER BY NEW_BRIEFDESCRIPTION NULLS LAST) AS Feedback FROM feedback GROUP BY NEW_COMPLAINT),\n"
        "cs AS (SELECT NEW_COMPLAINT, string_agg('-' || coalesce(NEW_BRIEFDESCRIPTION, ''), chr(10)"
        " ORDER BY NEW_BRIEFDESCRIPTION NULLS LAST) AS CorrectiveActionPlan FROM solution GROUP BY NEW_COMPLAINT),\n"
        "latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY PARENTACCOUNTID"
        " ORDER BY NEW_EFFTECTTIME DESC NULLS FIRST, ACCOUNTID) AS rn FROM account"
        " WHERE ACCOUNTID IS NOT NULL AND NEW_JDECODE IS NOT NULL) WHERE rn = 1)"
    )


_VOC = ("voc.NEW_CONTRACTOR AS CustomerContactPerson, voc.NEW_CONTRACTPHONE AS CustomerContactPhone,"
        " CAST(voc.NEW_FEEDBACKSCORE AS VARCHAR) AS Feedback, CAST(voc.NEW_HANDLERECORD AS VARCHAR) AS CorrectiveActionPlan,"
        " CAST(NULL AS VARCHAR) AS Judge, 'VOC' AS Type")
_VOC_WHERE = "voc.NEW_VISITRESULT = 20 AND voc.NEW_CUSTOMER IS NOT NULL"
register(
    "crm_feed",
    f"WITH {crm_ctes()}\n"
    "SELECT c.NEW_COMPLAINTID AS Id, CAST(c.CREATEDON AS TIMESTAMP) AS CreatedOn, c.NEW_PAYER AS PayerAccountId,"
    " co.NEW_CODE AS SalesOrg, a.NEW_JDECODE AS PayerId, a.NAME AS Payer, su.SYSTEMUSERID AS SalesUserSystemId,"
    " c.NEW_CONTACT AS CustomerContactPerson, c.NEW_CONTACT_PHONE AS CustomerContactPhone, fb.Feedback,"
    " cs.CorrectiveActionPlan, j.VALUE AS Judge, '投诉' AS Type"
    " FROM complaint c JOIN account a ON c.NEW_PAYER = a.ACCOUNTID JOIN systemuser su ON su.SYSTEMUSERID = a.OWNERID"
    " JOIN company co ON a.NEW_COMPANYID = co.NEW_COMPANYID"
    " JOIN (SELECT * FROM datadict WHERE upper(TABLENAME) = 'NEW_COMPLAINT' AND FIELDNAME = 'new_judge') j ON j.CODE = c.NEW_JUDGE"
    " JOIN fb ON c.NEW_COMPLAINTID = fb.NEW_COMPLAINT JOIN cs ON c.NEW_COMPLAINTID = cs.NEW_COMPLAINT\n"
    "UNION ALL\n"
    "SELECT voc.NEW_CUSTOMERVISITID, CAST(voc.CREATEDON AS TIMESTAMP), voc.NEW_CUSTOMER, co.NEW_CODE, a.NEW_JDECODE, a.NAME,"
    f" su.SYSTEMUSERID, {_VOC} FROM visit voc JOIN account a ON voc.NEW_CUSTOMER = a.ACCOUNTID"
    " JOIN company co ON a.NEW_COMPANYID = co.NEW_COMPANYID JOIN systemuser su ON su.SYSTEMUSERID = a.OWNERID"
    f" WHERE {_VOC_WHERE} AND a.NEW_LEVELTYPE = 20\n"
    "UNION ALL\n"
    "SELECT voc.NEW_CUSTOMERVISITID, CAST(voc.CREATEDON AS TIMESTAMP), pa.ACCOUNTID, co.NEW_CODE, pa.NEW_JDECODE, pa.NAME,"
    f" su.SYSTEMUSERID, {_VOC} FROM visit voc JOIN account sh ON voc.NEW_CUSTOMER = sh.ACCOUNTID"
    " JOIN account pa ON sh.PARENTACCOUNTID = pa.ACCOUNTID"
    " JOIN company co ON pa.NEW_COMPANYID = co.NEW_COMPANYID JOIN systemuser su ON su.SYSTEMUSERID = pa.OWNERID"
    f" WHERE {_VOC_WHERE} AND sh.NEW_LEVELTYPE = 30\n"
    "UNION ALL\n"
    "SELECT voc.NEW_CUSTOMERVISITID, CAST(voc.CREATEDON AS TIMESTAMP), pa.ACCOUNTID, co.NEW_CODE, pa.NEW_JDECODE, pa.NAME,"
    f" su.SYSTEMUSERID, {_VOC} FROM visit voc JOIN account cu ON voc.NEW_CUSTOMER = cu.ACCOUNTID"
    " JOIN latest pa ON pa.PARENTACCOUNTID = cu.ACCOUNTID"
    " JOIN company co ON pa.NEW_COMPANYID = co.NEW_COMPANYID JOIN systemuser su ON su.SYSTEMUSERID = pa.OWNERID"
    f" WHERE {_VOC_WHERE} AND cu.NEW_LEVELTYPE = 10",
)
register("crm_feedback_text", f"WITH {crm_ctes()}\nSELECT NEW_COMPLAINT, Feedback FROM fb")
register(
    "latest_child",
    f"WITH {crm_ctes()}\nSELECT PARENTACCOUNTID, ACCOUNTID, NEW_JDECODE, NEW_EFFTECTTIME FROM latest",
)


# --------------------------------------------------------------------------
# Dashboards, labels, present value, profiles
# --------------------------------------------------------------------------
register(
    "rental_type",
    f"WITH {panel_ctes()}\nSELECT CASE WHEN DAILY_RENT > 0 THEN 'Daily' WHEN MONTHLY_RENT > 0 THEN 'Monthly' ELSE 'Others' END"
    " AS rental_type, count(*) AS rows FROM panel GROUP BY 1",
)
register(
    "miss_period_bucket",
    ORACLE["gauss_period"].replace(
        "SELECT CUSTOMER_SHIPTO, POSTING_DATE, round(period, 6) AS period, round(period_diff, 6) AS period_diff,",
        "SELECT",
    ).replace("AS miss_period FROM pd", "AS miss_period, count(*) AS rows FROM pd GROUP BY 1"),
)
register(
    "action_labels",
    f"WITH {panel_ctes()},\nyes AS ({fx.ACTION_YES_SQL}),\nno AS ({fx.ACTION_NO_SQL}),\n"
    "lab AS (SELECT panel.*, CASE WHEN CUSTOMER_SHIPTO IN (SELECT SAPCustomerNumber__c FROM no) THEN 0"
    " WHEN CUSTOMER_SHIPTO IN (SELECT SAPCustomerNumber__c FROM yes) THEN 1 END AS action FROM panel)\n"
    "SELECT * REPLACE (CAST(action AS BIGINT) AS action), FROM lab WHERE action IS NOT NULL",
)
register(
    "customer_pv",
    f"WITH {panel_ctes()},\n"
    "r AS (SELECT CUSTOMER_SHIPTO,"
    f" sum(CASE WHEN POSTING_DATE >= CAST({d(AS_OF)} - INTERVAL 12 MONTH AS DATE) AND POSTING_DATE < {d(AS_OF)}"
    " THEN PRODUCT_SALES + RENTAL_SALES ELSE 0.0 END) AS revenue_0,"
    f" sum(CASE WHEN POSTING_DATE >= CAST({d(AS_OF)} - INTERVAL 24 MONTH AS DATE)"
    f" AND POSTING_DATE < CAST({d(AS_OF)} - INTERVAL 12 MONTH AS DATE)"
    " THEN PRODUCT_SALES + RENTAL_SALES ELSE 0.0 END) AS revenue_prev FROM panel GROUP BY 1),\n"
    "g AS (SELECT *, coalesce(CASE WHEN revenue_prev = 0 THEN NULL ELSE (revenue_0 - revenue_prev) / revenue_prev END, 0.0)"
    " AS growth_rate FROM r),\n"
    "q AS (SELECT *, greatest(least(growth_rate, 1.5), -0.7) AS gc FROM g),\n"
    "q2 AS (SELECT *, CASE WHEN gc >= 0 THEN 1.0 + gc ELSE (1.0 + gc) * 0.9 END AS qq FROM q)\n"
    "SELECT CUSTOMER_SHIPTO, round(revenue_0, 6) AS revenue_0, round(revenue_prev, 6) AS revenue_prev,"
    " round(growth_rate, 6) AS growth_rate,"
    " round(list_reduce(list_transform(range(1, 13), lambda t: revenue_0 * pow(qq, t) / pow(1.1, t)),"
    " lambda a, b: a + b, 0.0), 2) AS pv FROM q2",
)
register(
    "histogram",
    f"{fit_ctes()},\nb AS (SELECT min(percent_decline) AS lo0, max(percent_decline) AS hi0 FROM fit),\n"
    "b2 AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM b),\n"
    "h AS (SELECT CAST(least(floor((percent_decline - lo) / ((hi - lo) / 10)), 9) AS BIGINT) AS bin, count(*) AS count"
    " FROM fit, b2 WHERE percent_decline IS NOT NULL GROUP BY 1)\n"
    "SELECT bin, round(lo + bin * ((hi - lo) / 10), 6) AS bin_lo, round(lo + (bin + 1) * ((hi - lo) / 10), 6) AS bin_hi, count FROM h, b2",
)


def _snap_cte() -> str:
    return nba_snapshot_sql().replace(f"WITH {nba_ctes()}\n", f"WITH {nba_ctes()},\nsnap AS (", 1) + ")"


_VIOLIN = ["NEW_MATNR", "CCH", "PRODUCT_SALES", "CNTD_DANGEROUS", "T_1_ENTRIES"]
register(
    "class_quantiles",
    f"{_snap_cte()},\nlab AS (SELECT *, CASE WHEN NEW_MATNR > 0 THEN 1 ELSE 0 END AS purchase FROM snap),\n"
    "lng AS (" + " UNION ALL ".join(f"SELECT purchase, '{c}' AS variable, CAST({c} AS DOUBLE) AS v FROM lab" for c in _VIOLIN) + ")\n"
    "SELECT CAST(purchase AS BIGINT) AS purchase, variable, count(v) AS n, round(avg(v), 6) AS mean,"
    + ", ".join(f"round(quantile_cont(v, {q}), 6) AS {n}" for q, n in [(0.0, "p0"), (0.25, "p25"), (0.5, "p50"), (0.75, "p75"), (1.0, "p100")])
    + " FROM lng GROUP BY purchase, variable",
)
_PROFILE = ["CCH", "AVG_CCH", "PRODUCT_SALES", "CNTD_DANGEROUS", "CNTD_SEA", "CNTD_WATERWAY", "CNTD_DEBIT_ITEMS",
            "CNTD_MATNR", "CNTD_MATKL", "CNTD_STANDARD", "T_1_ENTRIES", "T_2_ENTRIES", "T_3_ENTRIES", "NEW_MATNR"]
register(
    "profile",
    f"{_snap_cte()}\n"
    + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count(CAST({c} AS DOUBLE)) AS count, count(*) - count({c}) AS nulls,"
        f" round(avg(CAST({c} AS DOUBLE)), 6) AS mean, round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS stddev,"
        f" round(min(CAST({c} AS DOUBLE)), 6) AS min, round(median(CAST({c} AS DOUBLE)), 6) AS median,"
        f" round(max(CAST({c} AS DOUBLE)), 6) AS max FROM snap"
        for c in _PROFILE
    ),
)


# --------------------------------------------------------------------------
# Driver names (attribution vocabulary) with the scoring frame's means
# --------------------------------------------------------------------------
from churnlens.operators.explain import DRIVER_RULES  # noqa: E402
from churnlens.operators.ml import VARIABLES  # noqa: E402


def driver_sql(expr: str, passes: int = 2) -> str:
    for _ in range(passes):
        for pat, rep in DRIVER_RULES:
            expr = f"regexp_replace({expr}, '{pat}', '{rep}', 'g')"
    return expr


register(
    "driver_names",
    f"{fit_ctes()},\n"
    "dn AS (" + " UNION ALL ".join(f"SELECT '{v}' AS variable, avg(CAST({v} AS DOUBLE)) AS mean_value FROM sf" for v in VARIABLES) + ")\n"
    f"SELECT variable, round(mean_value, 6) AS mean_value, {driver_sql('variable')} AS driver FROM dn",
)


# --------------------------------------------------------------------------
# Risk score: seasonal comparison in relational SQL (positions, self joins)
# --------------------------------------------------------------------------
from churnlens.functions import ladders as _L  # noqa: E402


def _ladder_sql(x: str, steps, default, strict: bool = False, pick: int = 1) -> str:
    op = ">" if strict else ">="
    parts = []
    for st in steps:
        v = st[pick]
        lit = f"'{v}'" if isinstance(v, str) else repr(v)
        parts.append(f"WHEN {x} {op} {st[0]!r} THEN {lit}")
    dflt = f"'{default}'" if isinstance(default, str) else repr(default)
    return "(CASE " + " ".join(parts) + f" ELSE {dflt} END)"


def _int_text(x: str) -> str:
    return f"CAST(CAST(trunc({x}) AS DECIMAL(38,0)) AS VARCHAR)"


def risk_ctes(trimmed: bool = False) -> str:
    """``trimmed``: the series begin with their first value other than zero."""
    kept = (
        "pts AS (SELECT CUSTOMER_SHIPTO, POSTING_DATE, predicted FROM (SELECT *, max(CASE WHEN predicted <> 0 THEN 1 ELSE 0 END)"
        " OVER (PARTITION BY CUSTOMER_SHIPTO ORDER BY POSTING_DATE) AS seen FROM scaffold WHERE predicted IS NOT NULL) WHERE seen = 1),\n"
        if trimmed else "pts AS (SELECT CUSTOMER_SHIPTO, POSTING_DATE, predicted FROM scaffold WHERE predicted IS NOT NULL),\n"
    )
    return (
        f"{fit_ctes()},\n{kept}"
        "ser AS (SELECT CUSTOMER_SHIPTO AS c, predicted AS v, row_number() OVER (PARTITION BY CUSTOMER_SHIPTO ORDER BY POSTING_DATE) AS i,"
        " count(*) OVER (PARTITION BY CUSTOMER_SHIPTO) AS n FROM pts),\n"
        "mb AS (SELECT c AS CUSTOMER_SHIPTO,"
        " avg(CASE WHEN (n > 24 AND i > n - 24 AND i <= n - 12) OR (n <= 24 AND i <= n // 2) THEN v END) AS mean_before,"
        " avg(CASE WHEN (n > 24 AND i > n - 12) OR (n <= 24 AND i > n // 2) THEN v END) AS mean_after FROM ser GROUP BY 1),\n"
        "win AS (SELECT c, 'a' AS w, i - (n - 12) - 1 AS t, v AS x FROM ser WHERE n >= 18 AND i > n - 12"
        " UNION ALL SELECT c, 'b' AS w, i - (n - 18) - 1 AS t, v AS x FROM ser WHERE n >= 18 AND i > n - 18 AND i <= n - 6),\n"
        "wm AS (SELECT c, w, avg(x) AS m FROM win GROUP BY c, w),\n"
        "dev AS (SELECT win.c, win.w, win.t, win.x - wm.m AS d FROM win JOIN wm USING (c, w)),\n"
        "c0 AS (SELECT c, w, sum(d * d) AS c0 FROM dev GROUP BY c, w),\n"
        "ac AS (SELECT a.c, a.w, r.k, sum(a.d * b.d) AS s FROM dev a CROSS JOIN range(1, 7) r(k)"
        " JOIN dev b ON b.c = a.c AND b.w = a.w AND b.t = a.t + r.k GROUP BY a.c, a.w, r.k),\n"
        "acf AS (SELECT ac.c, ac.w, ac.k, CASE WHEN c0.c0 = 0 THEN NULL ELSE ac.s / c0.c0 END AS r FROM ac JOIN c0 USING (c, w)),\n"
        "bp AS (SELECT c, w, k AS p FROM (SELECT *, row_number() OVER (PARTITION BY c, w ORDER BY r DESC NULLS LAST, k) AS rn"
        " FROM acf) WHERE rn = 1),\n"
        "tr AS (SELECT a.c, a.w, a.t, sum(b.x * CASE WHEN bp.p % 2 = 0 AND abs(b.t - a.t) = bp.p // 2 THEN 0.5 ELSE 1.0 END)"
        " / bp.p AS trend FROM win a JOIN bp ON bp.c = a.c AND bp.w = a.w JOIN win b ON b.c = a.c AND b.w = a.w"
        " AND b.t BETWEEN a.t - bp.p // 2 AND a.t + bp.p // 2"
        " WHERE a.t >= bp.p // 2 AND a.t <= 11 - bp.p // 2 GROUP BY a.c, a.w, a.t, bp.p),\n"
        "phs AS (SELECT win.c, win.w, win.t % bp.p AS q, avg(win.x - tr.trend) AS pa FROM win JOIN bp USING (c, w)"
        " JOIN tr USING (c, w, t) GROUP BY 1, 2, 3),\n"
        "phc AS (SELECT c, w, q, pa - avg(pa) OVER (PARTITION BY c, w) AS s FROM phs),\n"
        "seas AS (SELECT win.c, win.w, win.t, phc.s FROM win JOIN bp USING (c, w) JOIN phc ON phc.c = win.c AND phc.w = win.w"
        " AND phc.q = win.t % bp.p),\n"
        "sc AS (SELECT a.c AS CUSTOMER_SHIPTO, a.p AS period_after, b.p AS period_before,"
        " (SELECT max(s) FROM seas WHERE seas.c = b.c AND seas.w = 'b') AS amplitude"
        " FROM bp a JOIN bp b ON a.c = b.c AND a.w = 'a' AND b.w = 'b'),\n"
        "inp AS (SELECT fit.*, coalesce(CASE WHEN abs(sc.amplitude) > 0.025 THEN CAST(sc.period_before - sc.period_after - 1 AS DOUBLE) END, 0.0)"
        " AS miss_period, CASE WHEN mb.mean_before IS NULL OR mb.mean_after IS NULL THEN 0.0"
        " WHEN mb.mean_before = 0 AND mb.mean_after <> mb.mean_before THEN -100.0 WHEN mb.mean_before = 0 THEN 0.0"
        " ELSE (mb.mean_after - mb.mean_before) / mb.mean_before END AS magnitute_drop"
        " FROM fit LEFT JOIN sc USING (CUSTOMER_SHIPTO) LEFT JOIN mb USING (CUSTOMER_SHIPTO)),\n"
        "inp0 AS (SELECT CUSTOMER_SHIPTO, coalesce(CCH, 0) AS CCH, coalesce(CCH_lag_1, 0) AS CCH_lag_1,"
        " coalesce(percent_decline, 0) AS percent_decline, coalesce(max_cch, 0) AS max_cch,"
        " coalesce(cross_zero, 0) AS cross_zero, miss_period, magnitute_drop FROM inp),\n"
        "lad AS (SELECT *, "
        f"{_ladder_sql('percent_decline', _L.SLOPE_STEPS, _L.SLOPE_ELSE[0])} AS slope_score, "
        f"{_ladder_sql('percent_decline', _L.SLOPE_STEPS, _L.SLOPE_ELSE[1], pick=2)} AS slope_t, "
        f"{_ladder_sql('magnitute_drop', _L.MAGNITUDE_STEPS, _L.MAGNITUDE_ELSE)} AS mag, "
        f"{_ladder_sql('miss_period', _L.PERIOD_STEPS, _L.PERIOD_ELSE[0])} AS period, "
        f"{_ladder_sql('miss_period', _L.PERIOD_STEPS, _L.PERIOD_ELSE[1], pick=2)} AS period_t, "
        f"{_ladder_sql('max_cch', _L.SIZE_STEPS, _L.SIZE_ELSE, strict=True)} AS size FROM inp0),\n"
        "scores AS (SELECT CUSTOMER_SHIPTO,"
        f" round_even((size * (slope_score + {_L.MAGNITUDE_WEIGHT!r} * mag + period) / {_L.SCORE_NORMALISER!r} + 100) / 2, 0) AS risk_score,"
        f" '{FORECAST_AT.strftime('%Y%m')}' || ': Current CCH:' || {_int_text('CCH')} || ', Last mth CCH:' || {_int_text('CCH_lag_1')}"
        f" || ', 6 mth CCH likely ' || slope_t || ' within ' || {_int_text('abs(percent_decline) * 100')} || '%.'"
        f" || CASE WHEN cross_zero > 0 THEN ' Churn likely in ' || {_int_text('cross_zero')} || ' mth. ' ELSE '' END"
        " || ' ' || CASE WHEN period <> 0 THEN period_t || ' pred purch of ' || CAST(abs(period) AS VARCHAR) || ' mth.' ELSE '' END"
        " AS risk_value FROM lad)"
    )


_SEASONAL = (
    "SELECT CUSTOMER_SHIPTO, CAST(period_after - period_before AS BIGINT) AS diff_phase, round(amplitude, 6) AS amplitude,"
    " CAST(period_after AS BIGINT) AS period_after, CAST(period_before AS BIGINT) AS period_before,"
    " round(mean_before, 6) AS mean_before, round(mean_after, 6) AS mean_after"
    " FROM (SELECT DISTINCT CUSTOMER_SHIPTO FROM scaffold WHERE predicted IS NOT NULL) LEFT JOIN sc USING (CUSTOMER_SHIPTO) LEFT JOIN mb USING (CUSTOMER_SHIPTO)"
)
register("seasonal_stats", f"{risk_ctes()}\n{_SEASONAL}")
register("seasonal_stats_trimmed", f"{risk_ctes(True)}\n{_SEASONAL}")
register("risk_score", f"{risk_ctes()}\nSELECT CUSTOMER_SHIPTO, risk_score, risk_value FROM scores")
register("risk_list", f"{risk_ctes()}\nSELECT CUSTOMER_SHIPTO, risk_score, risk_value FROM scores WHERE risk_score > 65")
register("opportunity_list", f"{risk_ctes()}\nSELECT CUSTOMER_SHIPTO, risk_score, risk_value FROM scores WHERE risk_score < 45")
register(
    "score_bins",
    f"{risk_ctes()}\nSELECT CAST(floor(risk_score / 10) * 10 AS BIGINT) AS score_bin, count(*) AS customers FROM scores GROUP BY 1",
)


# --------------------------------------------------------------------------
# The seven dashboard sheets, each with its own period and calculation
# --------------------------------------------------------------------------
def status_ctes(months: int | None) -> str:
    """``sheet``: rows of the status table without growth, of the last months (all: None)."""
    period = "" if months is None else (
        f" AND POSTING_DATE IS NOT NULL AND POSTING_DATE >= CAST({d(AS_OF)} - INTERVAL {months - 1} MONTH AS DATE)")
    return (
        f"{risk_ctes()},\n"
        f"yes AS ({fx.ACTION_YES_SQL}),\nno AS ({fx.ACTION_NO_SQL}),\n"
        "act AS (SELECT DISTINCT c.CUSTOMER_SHIPTO, CASE WHEN c.CUSTOMER_SHIPTO IN (SELECT SAPCustomerNumber__c FROM no) THEN 0"
        " WHEN c.CUSTOMER_SHIPTO IN (SELECT SAPCustomerNumber__c FROM yes) THEN 1 END AS action"
        " FROM (SELECT DISTINCT CUSTOMER_SHIPTO FROM feat) c),\n"
        "scored AS (SELECT scores.CUSTOMER_SHIPTO, risk_score AS s, act.action FROM scores LEFT JOIN act USING (CUSTOMER_SHIPTO)),\n"
        "status AS (SELECT CUSTOMER_SHIPTO, CASE WHEN s > 65 AND action = 1 THEN 'risk_check' WHEN s > 65 THEN 'risk_uncheck'"
        " WHEN s < 45 THEN 'growth' END AS RISK_STATUS FROM scored),\n"
        "board AS (SELECT feat.*, status.RISK_STATUS FROM feat LEFT JOIN status USING (CUSTOMER_SHIPTO)),\n"
        f"sheet AS (SELECT * FROM board WHERE RISK_STATUS IS DISTINCT FROM 'growth'{period})"
    )


def by_month(what: str) -> str:
    return f"SELECT CAST(date_trunc('month', POSTING_DATE) AS DATE) AS POSTING_DATE, RISK_STATUS, {what} FROM sheet GROUP BY 1, 2"


def from_first(value: str) -> str:
    return (f"first_value({value}) OVER (PARTITION BY RISK_STATUS ORDER BY POSTING_DATE"
            " ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)")


def pct_diff(value: str) -> str:
    base = from_first(value)
    return f"round(CASE WHEN {base} = 0 THEN NULL ELSE ({value} - {base}) / abs({base}) END, 6) AS pct_diff"


def compounded(value: str) -> str:
    k = "row_number() OVER (PARTITION BY RISK_STATUS ORDER BY POSTING_DATE)"
    ratio = f"({value} / nullif({from_first(value)}, 0))"
    return f"round(CASE WHEN {k} > 1 AND {ratio} > 0 THEN pow({ratio}, 1.0 / ({k} - 1)) - 1 END, 6) AS compound_growth"


register("status_countd", f"{status_ctes(None)}\nSELECT RISK_STATUS, count(DISTINCT CUSTOMER_SHIPTO) AS customers FROM sheet GROUP BY RISK_STATUS")
register("status_growth", f"{status_ctes(None)},\ng AS ({by_month('avg(CCH) AS a')})\n"
         f"SELECT POSTING_DATE, RISK_STATUS, round(a, 6) AS avg_cch, {compounded('a')} FROM g")
register("status_growth_offset", f"{status_ctes(None)},\ng AS ({by_month('avg(CCH) AS a')})\n"
         "SELECT POSTING_DATE, RISK_STATUS, round(a, 6) AS avg_cch, round(CASE WHEN b <> 0 AND a / b > 0 THEN sqrt(a / b) - 1 END, 6) AS compound_growth"
         " FROM (SELECT *, lag(a, 2) OVER (PARTITION BY RISK_STATUS ORDER BY POSTING_DATE) AS b FROM g)")
register("status_median_growth", f"{status_ctes(12)},\ng AS ({by_month('median(CCH) AS m')})\n"
         f"SELECT POSTING_DATE, RISK_STATUS, round(m, 6) AS median_cch, {compounded('m')} FROM g")
register("status_sales_pct", f"{status_ctes(12)},\ng AS ({by_month('avg(PRODUCT_SALES) AS a, avg(Holidays) AS h')})\n"
         f"SELECT POSTING_DATE, RISK_STATUS, round(a, 6) AS avg_product_sales, round(h, 6) AS avg_holidays, {pct_diff('a')} FROM g")
register("status_avg", f"{status_ctes(12)}\n" + by_month(
    "round(avg(PRODUCT_SALES), 6) AS avg_product_sales, round(avg(CCH), 6) AS avg_cch, round(avg(DELIVERY), 6) AS avg_delivery"))
register("status_rental_avg", f"{status_ctes(None)}\n" + by_month("round(avg(RENTAL_SALES), 6) AS avg_rental_sales"))
register("status_median_pct", f"{status_ctes(16)},\ng AS ({by_month('median(CCH) AS m')})\n"
         f"SELECT POSTING_DATE, RISK_STATUS, round(m, 6) AS median_cch, {pct_diff('m')} FROM g")
register("status_blend", f"{status_ctes(16)},\ng AS ({by_month('median(CCH) AS m')}),\n"
         "second AS (SELECT POSTING_DATE, avg(s) AS avg_score FROM board JOIN scored USING (CUSTOMER_SHIPTO)"
         f" WHERE POSTING_DATE >= CAST({d(AS_OF)} - INTERVAL 15 MONTH AS DATE) GROUP BY 1),\n"
         f"pm AS (SELECT POSTING_DATE, RISK_STATUS, round(m, 6) AS median_cch, {pct_diff('m')} FROM g)\n"
         "SELECT pm.*, round(avg_score, 6) AS avg_score FROM pm LEFT JOIN second USING (POSTING_DATE)")
LISTS = (f"{risk_ctes()},\nlists AS (SELECT 'risk' AS list, CUSTOMER_SHIPTO, risk_score FROM scores WHERE risk_score > 65"
         " UNION ALL SELECT 'opportunity', CUSTOMER_SHIPTO, risk_score FROM scores WHERE risk_score < 45)")
register("result_lists", f"{LISTS}\nSELECT list, CUSTOMER_SHIPTO, CAST(risk_score AS DOUBLE) AS risk_score FROM lists")
register("list_counts", f"{LISTS}\nSELECT list, count(*) AS customers FROM lists GROUP BY list")
register("action_list_csv", fx.ACTION_YES_SQL)
register("status_csv", f"{status_ctes(None)}\nSELECT RISK_STATUS, count(*) AS rows, count(DISTINCT POSTING_DATE) AS months,"
         " round(sum(CCH), 3) AS sum_cch, round(sum(PRODUCT_SALES), 3) AS sum_product_sales, round(sum(RENTAL_SALES), 3) AS sum_rental_sales,"
         " round(sum(DELIVERY), 3) AS sum_delivery, round(sum(Holidays), 3) AS sum_holidays,"
         " CAST(sum(CASE WHEN RISK_STATUS = 'risk_uncheck' THEN 1 ELSE 0 END) AS BIGINT) AS uncheck_rows FROM board GROUP BY RISK_STATUS")
