"""The domain's inputs derived from the star-schema test tables.

Every fixture exists twice: as a DataFrame and as the SQL text of the same definition, so
that the check queries are stated over the same inputs without sharing the engine's code.
A supplier plays the entity, its monthly line items the prices, its order quarters the
statements, users' sign-ups and purchases the period ends and publications.
"""

from pyspark.sql import functions as F

from panelloom import schema as S
from panelloom.session import stage

NULL_RULES = {
    "EBITDA": (3, 0), "TotalDebt": (3, 0), "CurrentDebt": (5, 0), "LongTermDebt": (4, 1),
    "DepreciationAndAmortization": (7, 0), "TotalAssets": (11, 0), "CurrentAssets": (7, 3),
    "CurrentLiabilities": (4, 0), "TotalNoncurrentLiabilities": (6, 1),
    "TotalLiabilities": (3, 1), "FinancingCashFlow": (2, 0), "FreeCashFlow": (3, 2),
}
STATEMENT_FORMULAS = {
    "TotalRevenue": "total_revenue",
    "GrossProfit": "total_revenue / 3e0",
    "OperatingIncome": "operating_income",
    "NetIncome": "net_income",
    "EBITDA": "operating_income + d_and_a",
    "BasicAverageShares": "basic_average_shares",
    "CashAndCashEquivalents": "total_assets / 19e0",
    "CurrentDebt": "current_debt",
    "LongTermDebt": "long_term_debt",
    "TotalDebt": "current_debt + long_term_debt",
    "StockholdersEquity": "total_assets / 97e0 + operating_income * 2e0",
    "TotalAssets": "total_assets",
    "CurrentAssets": "total_assets / 3.7e0",
    "CurrentLiabilities": "total_assets / 7e0",
    "TotalNoncurrentLiabilities": "total_assets / 5.3e0",
    "TotalLiabilities": "total_assets / 7e0 + total_assets / 5.3e0",
    "OperatingCashFlow": "net_income + d_and_a",
    "InvestingCashFlow": "total_assets / -47e0",
    "FinancingCashFlow": "net_income / 11e0",
    "FreeCashFlow": "net_income + d_and_a - total_revenue / 31e0",
    "CapitalExpenditure": "total_revenue / -31e0",
    "DepreciationAndAmortization": "d_and_a",
}


def _statement_expr(name):
    formula = STATEMENT_FORMULAS[name]
    if name not in NULL_RULES:
        return f"{formula} AS {name}"
    p, r = NULL_RULES[name]
    return f"CASE WHEN h % {p} <> {r} THEN {formula} END AS {name}"


STATEMENT_SELECT = ", ".join(_statement_expr(c) for c in STATEMENT_FORMULAS)


def _money(text, scale=4):
    """Exact sums: the addends become whole units, so the order of addition cannot matter."""
    unit = float(10 ** scale)
    return F.sum(F.rint(F.expr(text) * unit).cast("bigint")) / unit


class Tables:
    """The test tables of one folder, read on demand."""

    def __init__(self, spark, folder, landed=False):
        self.spark = spark
        self.folder = folder
        self.landed = {} if landed else None

    def land(self, name, build):
        """``build()``, written once and read back where the fixtures stand for landed files."""
        if self.landed is None:
            return build()
        if name not in self.landed:
            self.landed[name] = stage(build())
        return self.landed[name]

    def read(self, name):
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def landed(t: Tables):
    """``t`` with prices and statements written once, for queries that read one of them several times."""
    return t if t.landed is not None else Tables(t.spark, t.folder, landed=True)


def prices(t: Tables):
    return t.land("prices", lambda: _prices(t))


def _prices(t):
    order = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return (
        t.read("lineitem")
        .groupBy(F.col("l_suppkey").alias("k"), F.trunc("l_shipdate", "MM").alias("Date"))
        .agg(
            F.min_by(price, order).alias("Open"),
            F.max_by(price, order).alias("Close"),
            _money("l_quantity").alias("Volume"),
        )
        .select(entity("k"), "Date", "Open", "Close", "Volume")
    )


def entity(k):
    return F.concat(F.lit("S"), F.col(k).cast("string")).alias("Ticker")


def prices_gappy(t):
    k = F.substring("Ticker", 2, 20).cast("bigint")
    h = k * 31 + F.year("Date") * 4 + F.month("Date")
    return prices(t).withColumn("Open", F.when(h % 13 != 0, F.col("Open")))


def market(t, source=None):
    mean = {c: (_money(c, 8) / F.count(F.lit(1))).alias(c) for c in ("Open", "Close")}
    return (
        (prices(t) if source is None else source).groupBy("Date").agg(mean["Open"], mean["Close"])
        .select(F.lit("MKT").alias("Ticker"), "Date", "Open", "Close")
    )


def statements_base(t):
    return t.land("statements_base", lambda: _statements_base(t))


def _statements_base(t):
    line = t.read("lineitem").select(
        "l_orderkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_quantity")
    order = t.read("orders").select("o_orderkey", "o_orderdate")
    return (
        line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("l_suppkey").alias("k"),
                 F.to_date(F.date_trunc("quarter", "o_orderdate")).alias("q"))
        .agg(
            _money("l_extendedprice * (1 - l_discount)").alias("total_revenue"),
            _money("l_extendedprice * (0.05e0 - l_discount)").alias("operating_income"),
            _money("l_extendedprice * (0.04e0 - l_tax)").alias("net_income"),
            _money("l_quantity * 10").alias("d_and_a"),
            _money("l_extendedprice * l_tax").alias("current_debt"),
            _money("l_extendedprice * l_discount").alias("long_term_debt"),
            _money("l_extendedprice * 3").alias("total_assets"),
            F.count(F.lit(1)).cast("double").alias("basic_average_shares"),
        )
        .withColumn("h", F.expr("k * 31 + year(q) * 4 + quarter(q)"))
    )


def statements(t):
    """Quarterly statements with the nulls of NULL_RULES."""
    return statements_base(t).selectExpr(
        "k", "q", "h", "'S' || CAST(k AS STRING) AS Ticker",
        "date_sub(add_months(q, 3), 1) AS ReportDate",
        *[_statement_expr(c) for c in STATEMENT_FORMULAS])


def statements_a(t):
    return (
        statements(t).filter("q >= DATE'2000-01-01'")
        .selectExpr("Ticker", "trunc(add_months(date_add(ReportDate, 30), 1), 'MM') AS Date",
                    *STATEMENT_FORMULAS, f"'{S.PROVIDER_A}' AS FinancialsSource")
    )


def statements_b_raw(t):
    """Provider B before standardising: nullable publication date, negative D&A for some."""
    da = "CASE WHEN k % 5 = 0 THEN -DepreciationAndAmortization ELSE DepreciationAndAmortization END"
    cols = [c for c in STATEMENT_FORMULAS if c != "DepreciationAndAmortization"]
    return statements(t).filter("q < DATE'2001-01-01'").selectExpr(
        "k", "Ticker", "ReportDate",
        "CASE WHEN k % 11 <> 0 THEN date_add(ReportDate, CAST(k % 60 AS INT)) END AS PublishDate",
        *cols, f"{da} AS DepreciationAndAmortization")


def statements_b(t):
    """Provider B standardised; two quarters can fall on one month, the later one wins."""
    from panelloom.operators.windows import keep_last
    full = statements_b_raw(t).selectExpr(
        "Ticker", "ReportDate",
        "trunc(add_months(coalesce(PublishDate, ReportDate), 1), 'MM') AS Date",
        *STATEMENT_FORMULAS, f"'{S.PROVIDER_B}' AS FinancialsSource")
    return keep_last(full, ["Ticker", "Date"], [F.desc("ReportDate")]).drop("ReportDate")


def info(t):
    return (
        t.read("supplier")
        .join(t.read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr("'S' || CAST(s_suppkey AS STRING) AS Ticker",
                    "CASE WHEN s_suppkey % 19 <> 0 THEN r_name END AS Sector",
                    "n_name AS Industry")
    )


def constituents(t):
    return (
        t.read("supplier").filter("s_suppkey % 3 = 0")
        .selectExpr("'S' || CAST(s_suppkey AS STRING) AS Ticker",
                    "CASE WHEN s_suppkey % 21 = 0 THEN 'n/a' ELSE "
                    "CAST(date_add(DATE'1995-01-01', CAST(s_suppkey AS INT)) AS STRING) END AS DateAdded")
    )


def exclusions(t):
    return (t.read("supplier").filter("s_suppkey % 17 = 0")
            .selectExpr("'S' || CAST(s_suppkey AS STRING) AS Ticker"))


def periods(t):
    return (t.read("events").filter("event_type = 'signup'")
            .selectExpr("event_id", "user_id AS Entity", "ts AS PeriodEnd"))


def publications(t):
    return (t.read("events").filter("event_type = 'purchase'")
            .selectExpr("user_id AS Entity", "ts AS Published"))


def metrics_input(t):
    """Statements under their panel names (flows as ``_TTM``), sector and the month's opening price."""
    flows = set(S.FLOWS)
    cols = [f"{c} AS {c}_TTM" if c in flows else c for c in STATEMENT_FORMULAS]
    base = statements(t).selectExpr("Ticker", "q AS Date", *cols)
    return (
        base.join(prices(t).select("Ticker", "Date", "Open"), ["Ticker", "Date"], "left")
        .join(info(t), ["Ticker"], "left")
    )


def predictions_cls(t):
    return t.read("lineitem").selectExpr(
        "CAST(l_returnflag = 'R' AS INT) AS actual", "CAST(l_discount > 0.05e0 AS INT) AS predicted")


def predictions_reg(t):
    return (
        t.read("lineitem").select("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
        .join(t.read("part").select("p_partkey", "p_retailprice"), F.expr("l_partkey = p_partkey"))
        .selectExpr("'S' || CAST(l_suppkey AS STRING) AS Ticker",
                    "p_retailprice * l_quantity / 0.97e0 AS Predicted", "l_extendedprice / 0.97e0 AS Observed")
    )


# --- the same definitions as SQL --------------------------------------------------------

_NAMES = ", ".join(STATEMENT_FORMULAS)
_PANEL_NAMES = ", ".join(
    f"{c} AS {c}_TTM" if c in set(S.FLOWS) else c for c in STATEMENT_FORMULAS)
_NO_DA = ", ".join(c for c in STATEMENT_FORMULAS if c != "DepreciationAndAmortization")
_ROW = "row(l_shipdate, l_orderkey, l_linenumber, l_partkey)"


def _sum(text, scale=4):
    return f"CAST(sum(CAST({text} AS DECIMAL(18,{scale}))) AS DOUBLE)"


SQL = {
    "prices": ([], f"""
        SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS Ticker,
               CAST(date_trunc('month', l_shipdate) AS DATE) AS Date,
               min_by(l_extendedprice / l_quantity, {_ROW}) AS Open,
               max_by(l_extendedprice / l_quantity, {_ROW}) AS Close,
               {_sum('l_quantity')} AS Volume
        FROM lineitem GROUP BY 1, 2"""),
    "prices_gappy": (["prices"], """
        SELECT Ticker, Date,
               CASE WHEN (CAST(substr(Ticker, 2) AS BIGINT) * 31 + year(Date) * 4 + month(Date)) % 13 <> 0
                    THEN Open END AS Open, Close, Volume FROM prices"""),
    "market": (["prices"], f"""
        SELECT 'MKT' AS Ticker, Date, {_sum('Open', 8)} / count(*) AS Open,
               {_sum('Close', 8)} / count(*) AS Close
        FROM prices GROUP BY Date"""),
    "statements_base": ([], f"""
        SELECT *, k * 31 + year(q) * 4 + quarter(q) AS h FROM (
        SELECT l_suppkey AS k, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS q,
               {_sum('l_extendedprice * (1 - l_discount)')} AS total_revenue,
               {_sum('l_extendedprice * (0.05e0 - l_discount)')} AS operating_income,
               {_sum('l_extendedprice * (0.04e0 - l_tax)')} AS net_income,
               {_sum('l_quantity * 10')} AS d_and_a,
               {_sum('l_extendedprice * l_tax')} AS current_debt,
               {_sum('l_extendedprice * l_discount')} AS long_term_debt,
               {_sum('l_extendedprice * 3')} AS total_assets,
               CAST(count(*) AS DOUBLE) AS basic_average_shares
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2)"""),
    "statements": (["statements_base"], f"""
        SELECT k, q, h, 'S' || CAST(k AS VARCHAR) AS Ticker,
               CAST(q + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS ReportDate,
               {STATEMENT_SELECT} FROM statements_base"""),
    "statements_a": (["statements"], f"""
        SELECT Ticker,
               CAST(date_trunc('month', ReportDate + INTERVAL 30 DAY + INTERVAL 1 MONTH) AS DATE) AS Date,
               {_NAMES}, '{S.PROVIDER_A}' AS FinancialsSource
        FROM statements WHERE q >= DATE '2000-01-01'"""),
    "statements_b_raw": (["statements"], f"""
        SELECT k, Ticker, ReportDate,
               CASE WHEN k % 11 <> 0 THEN CAST(ReportDate + CAST(k % 60 AS INTEGER) AS DATE) END AS PublishDate,
               {_NO_DA},
               CASE WHEN k % 5 = 0 THEN -DepreciationAndAmortization
                    ELSE DepreciationAndAmortization END AS DepreciationAndAmortization
        FROM statements WHERE q < DATE '2001-01-01'"""),
    "statements_b": (["statements_b_raw"], f"""
        SELECT Ticker, Date, {_NAMES}, '{S.PROVIDER_B}' AS FinancialsSource FROM (
          SELECT *, CAST(date_trunc('month', coalesce(PublishDate, ReportDate) + INTERVAL 1 MONTH) AS DATE) AS Date
          FROM statements_b_raw)
        QUALIFY row_number() OVER (PARTITION BY Ticker, Date ORDER BY ReportDate DESC) = 1"""),
    "info": ([], """
        SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS Ticker,
               CASE WHEN s_suppkey % 19 <> 0 THEN r_name END AS Sector, n_name AS Industry
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey"""),
    "constituents": ([], """
        SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS Ticker,
               CASE WHEN s_suppkey % 21 = 0 THEN 'n/a'
                    ELSE CAST(DATE '1995-01-01' + CAST(s_suppkey AS INTEGER) AS VARCHAR) END AS DateAdded
        FROM supplier WHERE s_suppkey % 3 = 0"""),
    "exclusions": ([], """
        SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS Ticker FROM supplier WHERE s_suppkey % 17 = 0"""),
    "periods": ([], """
        SELECT event_id, user_id AS Entity, ts AS PeriodEnd FROM events WHERE event_type = 'signup'"""),
    "publications": ([], """
        SELECT user_id AS Entity, ts AS Published FROM events WHERE event_type = 'purchase'"""),
    "metrics_input": (["statements", "prices", "info"], f"""
        SELECT s.Ticker, s.q AS Date, {_PANEL_NAMES}, p.Open, i.Sector, i.Industry
        FROM statements s LEFT JOIN prices p ON p.Ticker = s.Ticker AND p.Date = s.q
        LEFT JOIN info i ON i.Ticker = s.Ticker"""),
    "predictions_cls": ([], """
        SELECT CAST(l_returnflag = 'R' AS INTEGER) AS actual,
               CAST(l_discount > 0.05e0 AS INTEGER) AS predicted FROM lineitem"""),
    "predictions_reg": ([], """
        SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS Ticker,
               p_retailprice * l_quantity / 0.97e0 AS Predicted, l_extendedprice / 0.97e0 AS Observed
        FROM lineitem JOIN part ON l_partkey = p_partkey"""),
}


def with_fixtures(body, *names, extra=()):
    """``body`` under a WITH clause holding the named fixtures, what they need, and ``extra`` pairs."""
    done = []

    def need(name):
        for dependency in SQL[name][0]:
            need(dependency)
        if name not in done:
            done.append(name)

    for name in names:
        need(name)
    parts = [(n, SQL[n][1]) for n in done] + list(extra)
    clause = ", ".join(f"{n} AS MATERIALIZED ({text})" for n, text in parts)
    return f"WITH {clause} {body}" if clause else body
