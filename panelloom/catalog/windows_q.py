"""Window operators over the panel."""

from pyspark.sql import functions as F

from panelloom.catalog import fixtures as X
from panelloom.catalog.registry import query, r, rounded, rs
from panelloom.operators import windows as W
from panelloom.session import stage

W_SQL = "PARTITION BY Ticker ORDER BY Date"
FEATURES = ["MonthlyReturn", "ShortTermBeta", "Variance", "MonthlyExcessReturn"]

# the full grid in SQL: every month x every entity, absent cells included
GRID = [
    ("months", "SELECT DISTINCT Date FROM prices UNION SELECT Date FROM market"),
    ("grid", """SELECT m.Date, e.Ticker, p.Open, p.Close
        FROM months m CROSS JOIN (SELECT DISTINCT Ticker FROM prices) e
        LEFT JOIN prices p ON p.Date = m.Date AND p.Ticker = e.Ticker"""),
    ("returns", f"""SELECT Date, Ticker, Open, Close,
        Open / lag(Open) OVER ({W_SQL}) - 1 AS raw FROM grid"""),
    ("mk", """SELECT Date, coalesce(Open / lag(Open) OVER (ORDER BY Date) - 1, 0) AS m,
        Close / Open - 1 AS intra FROM market"""),
    ("stats", """SELECT x.Date, x.Ticker, coalesce(raw, 0) AS MonthlyReturn,
        CAST(raw IS NULL AS INTEGER) AS Return_IsMissing,
        CASE WHEN count(*) OVER w >= 6 THEN covar_samp(coalesce(raw, 0), m) OVER w / var_samp(m) OVER w END AS ShortTermBeta,
        CASE WHEN count(*) OVER w >= 6 THEN var_samp(coalesce(raw, 0)) OVER w END AS Variance,
        x.Close / x.Open - 1 - intra AS MonthlyExcessReturn
        FROM returns x JOIN mk ON mk.Date = x.Date
        WINDOW w AS (PARTITION BY x.Ticker ORDER BY x.Date ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"""),
]


def _returns(t):
    panel = stage(X.prices(t))
    return W.returns_and_betas(panel, X.market(t, panel))


@query("rolling_var_cov_beta", needs=["market"], extra=GRID, sql=f"""
    SELECT p.Ticker, p.Date, {rs(['ShortTermBeta', 'Variance'])}
    FROM prices p JOIN stats USING (Ticker, Date)""")
def rolling_var_cov_beta(t):
    return rounded(_returns(t).select("Ticker", "Date", "ShortTermBeta", "Variance"),
                   "ShortTermBeta", "Variance")


@query("open_returns", needs=["market"], extra=GRID, sql=f"""
    SELECT p.Ticker, p.Date, {r('MonthlyReturn', 'MonthlyReturn')}, Return_IsMissing
    FROM prices p JOIN stats USING (Ticker, Date)""")
def open_returns(t):
    return rounded(_returns(t).select("Ticker", "Date", "MonthlyReturn", "Return_IsMissing"),
                   "MonthlyReturn")


@query("excess_return", needs=["market"], extra=GRID, sql=f"""
    SELECT p.Ticker, p.Date, {r('MonthlyExcessReturn', 'MonthlyExcessReturn')}
    FROM prices p JOIN stats USING (Ticker, Date)""")
def excess_return(t):
    return rounded(_returns(t).select("Ticker", "Date", "MonthlyExcessReturn"), "MonthlyExcessReturn")


@query("ffill_limit", needs=["statements"], sql=f"""
    SELECT Ticker, q AS Date,
      {r('coalesce(TotalDebt, lag(TotalDebt, 1) OVER w, lag(TotalDebt, 2) OVER w)', 'TotalDebt')},
      {r('coalesce(EBITDA, lag(EBITDA, 1) OVER w, lag(EBITDA, 2) OVER w)', 'EBITDA')}
    FROM statements WINDOW w AS (PARTITION BY Ticker ORDER BY q)""")
def ffill_limit(t):
    df = X.statements(t).select("Ticker", F.col("q").alias("Date"), "TotalDebt", "EBITDA")
    return rounded(W.ffill_limit(df, ["TotalDebt", "EBITDA"], 2), "TotalDebt", "EBITDA")


_FILLED = ("filled", """
    SELECT Ticker, q AS Date, BasicAverageShares, TotalRevenue,
      coalesce(FreeCashFlow, lag(FreeCashFlow, 1) OVER w, lag(FreeCashFlow, 2) OVER w) AS FreeCashFlow,
      coalesce(EBITDA, lag(EBITDA, 1) OVER w, lag(EBITDA, 2) OVER w) AS EBITDA
    FROM statements WINDOW w AS (PARTITION BY Ticker ORDER BY q)""")
_W4 = f"WINDOW w AS ({W_SQL} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"


@query("ttm_flow", needs=["statements"], extra=[_FILLED], sql=f"""
    SELECT Ticker, Date, {r('avg(TotalRevenue) OVER w * 4', 'TotalRevenue_TTM')},
      {r('avg(FreeCashFlow) OVER w * 4', 'FreeCashFlow_TTM')},
      {r('avg(EBITDA) OVER w * 4', 'EBITDA_TTM')} FROM filled {_W4}""")
def ttm_flow(t):
    cols = ["TotalRevenue", "FreeCashFlow", "EBITDA"]
    df = X.statements(t).select("Ticker", F.col("q").alias("Date"), *cols)
    return rounded(W.ttm_flows(df, cols), *[f"{c}_TTM" for c in cols])


@query("ttm_average", needs=["statements"], extra=[_FILLED], sql=f"""
    SELECT Ticker, Date, {r('avg(BasicAverageShares) OVER w', 'BasicAverageShares_TTM')}
    FROM filled {_W4}""")
def ttm_average(t):
    df = X.statements(t).select("Ticker", F.col("q").alias("Date"), "BasicAverageShares")
    return rounded(W.ttm_flows(df, ["BasicAverageShares"]), "BasicAverageShares_TTM")


_IMPUTED = ["TotalDebt", "DepreciationAndAmortization", "TotalAssets", "FreeCashFlow"]


def _impute_sql(c):
    skew = (f"CASE WHEN count({c}) OVER e < 3 THEN NULL WHEN var_pop({c}) OVER e = 0 THEN 0 "
            f"ELSE skewness({c}) OVER e END")
    return r(f"""coalesce({c}, CASE WHEN abs({skew}) < 3 THEN avg({c}) OVER w
        ELSE quantile_cont({c}, 0.5) OVER w END)""", c)


@query("rolling_impute", needs=["statements"], sql=f"""
    SELECT Ticker, q AS Date, {', '.join(_impute_sql(c) for c in _IMPUTED)} FROM statements
    WINDOW e AS (PARTITION BY Ticker),
           w AS (PARTITION BY Ticker ORDER BY q ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""")
def rolling_impute(t):
    df = X.statements(t).select("Ticker", F.col("q").alias("Date"), *_IMPUTED)
    return rounded(W.rolling_impute(df, _IMPUTED), *_IMPUTED)


@query("lag_value", needs=["prices"], sql=f"""
    SELECT Ticker, Date, {r('lag(Volume, 1) OVER (' + W_SQL + ')', 'Volume_Lag1')} FROM prices""")
def lag_value(t):
    return rounded(W.lag_value(X.prices(t).select("Ticker", "Date", "Volume"), ["Volume"]), "Volume_Lag1")


def _growth_sql(c, n, alias):
    prev = f"lag({c}, {n}) OVER ({W_SQL})"
    return r(f"""CASE WHEN {prev} = 0 THEN CASE WHEN {c} > 0 THEN 10.0e0 WHEN {c} < 0 THEN -10.0e0 END
        WHEN {c} IS NOT NULL AND {prev} IS NOT NULL
        THEN greatest(-10.0e0, least(10.0e0, ({c} - {prev}) / abs({prev}))) END""", alias)


@query("growth_rates", needs=["prices_gappy"], sql=f"""
    SELECT Ticker, Date, {_growth_sql('Open', 12, 'Open_YoY')}, {_growth_sql('Open', 3, 'Open_QoQ')},
      {_growth_sql('Volume', 12, 'Volume_YoY')}, {_growth_sql('Volume', 3, 'Volume_QoQ')}
    FROM prices_gappy""")
def growth_rates(t):
    names = ["Open_YoY", "Open_QoQ", "Volume_YoY", "Volume_QoQ"]
    df = W.growth_rates(X.prices_gappy(t), ["Open", "Volume"])
    return rounded(df.select("Ticker", "Date", *names), *names)


@query("keep_last", sql="""
    SELECT user_id, event_id, ts, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def keep_last(t):
    df = t.read("events").select("user_id", "event_id", "ts", "event_type", "value")
    return W.keep_last(df, ["user_id"], [F.desc("ts"), F.desc("event_id")])
