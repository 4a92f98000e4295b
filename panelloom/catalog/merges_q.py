"""Filters, reshaping, joins and set operations."""

from pyspark.sql import functions as F

from panelloom import schema as S
from panelloom.catalog import fixtures as X
from panelloom.catalog.registry import query, r, rounded, rs
from panelloom.operators import aggregates as A, filters as C, joins as J, reshape as R
from panelloom.session import scratch_path, stage
from panelloom.sources import readers, sinks

# --- filters --------------------------------------------------------------------------------


@query("drop_future_rows", needs=["prices"], sql="""
    SELECT Ticker, Date, Volume FROM prices WHERE Date <= DATE '1999-06-15'""")
def drop_future_rows(t):
    return C.drop_future_rows(X.prices(t), "1999-06-15").select("Ticker", "Date", "Volume")


@query("filter_universe", needs=["prices", "constituents"], sql="""
    SELECT Ticker, Date, Volume FROM prices WHERE Ticker IN (SELECT Ticker FROM constituents)""")
def filter_universe(t):
    return C.filter_universe(X.prices(t), X.constituents(t)).select("Ticker", "Date", "Volume")


@query("exclude_listed", needs=["prices", "exclusions"], sql="""
    SELECT Ticker, Date, Volume FROM prices WHERE Ticker NOT IN (SELECT Ticker FROM exclusions)""")
def exclude_listed(t):
    return C.exclude_listed(X.prices(t), X.exclusions(t)).select("Ticker", "Date", "Volume")


_SOME = ["TotalDebt", "EBITDA", "TotalAssets"]


@query("drop_rows_any_null", needs=["statements"], sql=f"""
    SELECT Ticker, q, {rs(_SOME)} FROM statements
    WHERE TotalDebt IS NOT NULL AND TotalAssets IS NOT NULL""")
def drop_rows_any_null(t):
    df = X.statements(t).select("Ticker", "q", *_SOME)
    return rounded(C.drop_rows_any_null(df, spared=["EBITDA"]), *_SOME)


@query("drop_rows_all_null", needs=["statements"], sql=f"""
    SELECT Ticker, q, {rs(_SOME)} FROM statements
    WHERE TotalDebt IS NOT NULL OR EBITDA IS NOT NULL""")
def drop_rows_all_null(t):
    df = X.statements(t).select("Ticker", "q", *_SOME)
    return rounded(C.drop_rows_all_null(df, ["TotalDebt", "EBITDA"]), *_SOME)


@query("split_latest_date", needs=["prices"], sql="""
    SELECT Ticker, Date, CASE WHEN Date = (SELECT max(Date) FROM prices) THEN 'live' ELSE 'train' END AS part
    FROM prices""")
def split_latest_date(t):
    train, live = C.split_latest_date(stage(X.prices(t).select("Ticker", "Date")))
    return train.withColumn("part", F.lit("train")).union(live.withColumn("part", F.lit("live")))


@query("anomaly_listing", needs=["metrics_input"], sql=f"""
    SELECT Ticker, Date, {r('EBITDA_TTM', 'EBITDA_TTM')} FROM metrics_input WHERE EBITDA_TTM < 0""")
def anomaly_listing(t):
    return rounded(C.anomaly_listing(X.metrics_input(t), "EBITDA_TTM < 0", ["Ticker", "Date", "EBITDA_TTM"]),
                   "EBITDA_TTM")


# --- reshape --------------------------------------------------------------------------------

_FLAGS = ("A", "N", "R")
_WIDE_SQL = ("flags", """SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS Date, l_returnflag AS Ticker,
    CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS Open, max(l_extendedprice) AS Close
    FROM lineitem GROUP BY 1, 2""")


def _flags(t):
    return t.read("lineitem").groupBy(
        F.trunc("l_shipdate", "MM").alias("Date"), F.col("l_returnflag").alias("Ticker")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,4)")).cast("double").alias("Open"),
        F.max("l_extendedprice").alias("Close"))


@query("wide_to_long", extra=[_WIDE_SQL], sql="""
    SELECT m.Date, e.Ticker, Open, Close FROM (SELECT DISTINCT Date FROM flags) m
    CROSS JOIN (SELECT DISTINCT Ticker FROM flags) e LEFT JOIN flags f ON f.Date = m.Date AND f.Ticker = e.Ticker""")
def wide_to_long(t):
    wide = _flags(t).groupBy("Date").agg(*[
        F.max(F.when(F.col("Ticker") == e, F.col(a))).alias(f"{a}|{e}") for a in ("Open", "Close") for e in _FLAGS])
    return R.wide_to_long(wide, ["Open", "Close"], _FLAGS)


@query("long_to_wide", extra=[_WIDE_SQL], sql="""
    SELECT Date, max(Open) FILTER (Ticker = 'A') AS A, max(Open) FILTER (Ticker = 'N') AS N,
      max(Open) FILTER (Ticker = 'R') AS R FROM flags GROUP BY Date""")
def long_to_wide(t):
    return R.long_to_wide(_flags(t), _FLAGS, "Open")


@query("dense_grid", needs=["prices", "market"], sql="""
    SELECT m.Date, e.Ticker, p.Volume FROM (SELECT Date FROM prices UNION SELECT Date FROM market) m
    CROSS JOIN (SELECT DISTINCT Ticker FROM prices) e
    LEFT JOIN prices p ON p.Date = m.Date AND p.Ticker = e.Ticker""")
def dense_grid(t):
    panel = stage(X.prices(t))
    return R.dense_grid(panel.select("Ticker", "Date", "Volume"), X.market(t, panel))


_ITEMS = [S.squeeze(c) for c in S.INCOME]


@query("transpose_statement", needs=["statements"], sql=f"""
    SELECT Ticker, q, {rs(_ITEMS)} FROM statements""")
def transpose_statement(t):
    names = list(X.STATEMENT_FORMULAS)
    long = X.statements(t).select("Ticker", "q", *names).unpivot(["Ticker", "q"], names, "Item", "Value")
    return rounded(R.transpose_statement(long, _ITEMS, ["Ticker", "q"]), *_ITEMS)


# --- joins ----------------------------------------------------------------------------------

_THREE = """FROM (SELECT * FROM statements WHERE EBITDA IS NOT NULL) a
    {0} JOIN (SELECT * FROM statements WHERE TotalAssets IS NOT NULL) b ON a.Ticker = b.Ticker AND a.ReportDate = b.ReportDate
    {0} JOIN (SELECT * FROM statements WHERE FreeCashFlow IS NOT NULL) c
      ON coalesce(a.Ticker, b.Ticker) = c.Ticker AND coalesce(a.ReportDate, b.ReportDate) = c.ReportDate"""
_THREE_COLS = f"{r('a.EBITDA', 'EBITDA')}, {r('b.TotalAssets', 'TotalAssets')}, {r('c.FreeCashFlow', 'FreeCashFlow')}"


def _three(t):
    figures = ("EBITDA", "TotalAssets", "FreeCashFlow")
    st = stage(X.statements(t).select("Ticker", "ReportDate", *figures))
    return [st.dropna(subset=[c]).select("Ticker", "ReportDate", c) for c in figures]


@query("outer_join_statements", needs=["statements"], sql=f"""
    SELECT coalesce(a.Ticker, b.Ticker, c.Ticker) AS Ticker, coalesce(a.ReportDate, b.ReportDate, c.ReportDate) AS ReportDate,
      {_THREE_COLS} {_THREE.format('FULL')}""")
def outer_join_statements(t):
    out = J.outer_join_statements(*_three(t), ["Ticker", "ReportDate"])
    return rounded(out, "EBITDA", "TotalAssets", "FreeCashFlow")


@query("left_join_statements", needs=["statements"], sql=f"""
    SELECT a.Ticker, a.ReportDate, {_THREE_COLS} {_THREE.format('LEFT')}""")
def left_join_statements(t):
    out = J.left_join_statements(*_three(t), ["Ticker", "ReportDate"])
    return rounded(out, "EBITDA", "TotalAssets", "FreeCashFlow")


_AB = ["TotalRevenue", "EBITDA", "TotalAssets", "TotalDebt", "DepreciationAndAmortization"]
MERGED = [("merged", f"""
    SELECT coalesce(a.Ticker, b.Ticker) AS Ticker, coalesce(a.Date, b.Date) AS Date,
      {', '.join(f'coalesce(a.{c}, b.{c}) AS {c}' for c in X.STATEMENT_FORMULAS)},
      CASE WHEN a.Ticker IS NOT NULL AND b.Ticker IS NOT NULL THEN '{S.BOTH_PROVIDERS}'
           ELSE coalesce(a.FinancialsSource, b.FinancialsSource) END AS FinancialsSource
    FROM statements_a a FULL JOIN statements_b b ON a.Ticker = b.Ticker AND a.Date = b.Date""")]


@query("coalesce_merge", needs=["statements_a", "statements_b"], extra=MERGED, sql=f"""
    SELECT Ticker, Date, {rs(_AB)}, FinancialsSource FROM merged""")
def coalesce_merge(t):
    t = X.landed(t)
    cols = ["Ticker", "Date", *_AB, "FinancialsSource"]
    out = J.coalesce_merge(X.statements_a(t).select(*cols), X.statements_b(t).select(*cols), order=["TotalRevenue"])
    return rounded(out, *_AB)


@query("join_prices_financials", needs=["prices", "statements_a"], sql=f"""
    SELECT p.Ticker, p.Date, p.Volume, {r('s.TotalRevenue', 'TotalRevenue')}
    FROM prices p LEFT JOIN statements_a s ON s.Ticker = p.Ticker AND s.Date = p.Date""")
def join_prices_financials(t):
    out = J.join_prices_financials(X.prices(t).select("Ticker", "Date", "Volume"),
                                   X.statements_a(t).select("Ticker", "Date", "TotalRevenue"))
    return rounded(out, "TotalRevenue")


@query("join_dimensions", needs=["prices", "info", "constituents"], sql="""
    SELECT p.Ticker, p.Date, p.Volume, Sector, Industry, DateAdded FROM prices p
    LEFT JOIN info USING (Ticker) LEFT JOIN constituents USING (Ticker)""")
def join_dimensions(t):
    return J.join_dimensions(X.prices(t).select("Ticker", "Date", "Volume"), X.info(t), X.constituents(t))


@query("new_rows_anti", needs=["statements_b", "prices_gappy"], sql="""
    SELECT Ticker, Date, FinancialsSource FROM statements_b b
    WHERE NOT EXISTS (SELECT 1 FROM prices_gappy p WHERE p.Open IS NOT NULL AND p.Ticker = b.Ticker AND p.Date = b.Date)""")
def new_rows_anti(t):
    stored = X.prices_gappy(t).dropna(subset=["Open"])
    return J.new_rows_anti(X.statements_b(t), stored).select("Ticker", "Date", "FinancialsSource")


@query("upsert_panel", needs=["prices", "prices_gappy"], sql=f"""
    SELECT coalesce(n.Ticker, p.Ticker) AS Ticker, coalesce(n.Date, p.Date) AS Date,
      {r('coalesce(n.Open, p.Open)', 'Open', 8)}, {r('coalesce(n.Close, p.Close)', 'Close', 8)},
      coalesce(n.Volume, p.Volume) AS Volume
    FROM (SELECT Ticker, CAST(Date + INTERVAL 1 MONTH AS DATE) AS Date, Open, Close * 2 AS Close, Volume FROM prices_gappy) n
    FULL JOIN prices p ON p.Ticker = n.Ticker AND p.Date = n.Date""")
def upsert_panel(t):
    t = X.landed(t)
    new = X.prices_gappy(t).withColumns({"Date": F.add_months("Date", 1), "Close": F.col("Close") * 2})
    return rounded(J.upsert_panel(new, X.prices(t)), "Open", "Close", places=8)


ASOF = [("hits", """
    SELECT p.event_id, p.Entity, p.PeriodEnd, min(q.Published) AS Published
    FROM periods p LEFT JOIN publications q ON q.Entity = p.Entity AND q.Published > p.PeriodEnd
      AND q.Published <= p.PeriodEnd + INTERVAL 2 DAY GROUP BY ALL""")]


@query("asof_forward", needs=["periods", "publications"], extra=ASOF, sql="""
    SELECT event_id, Entity, PeriodEnd, Published,
      coalesce(CAST(Published AS DATE), CAST(CAST(PeriodEnd AS DATE) + INTERVAL 30 DAY AS DATE)) AS PublicationDate FROM hits""")
def asof_forward(t):
    return J.asof_forward(X.periods(t), X.publications(t), "Entity", "PeriodEnd", "Published", ["event_id"], days=2)


@query("refill_dimension", needs=["prices", "info"], sql="""
    SELECT p.Ticker, p.Date, p.Volume, CASE WHEN i.Sector IS NULL OR i.Industry IS NULL THEN n.n_name ELSE i.Sector END AS Sector,
      CASE WHEN i.Sector IS NULL OR i.Industry IS NULL THEN s.s_name ELSE i.Industry END AS Industry
    FROM prices p LEFT JOIN info i USING (Ticker)
    LEFT JOIN supplier s ON p.Ticker = 'S' || CAST(s.s_suppkey AS VARCHAR) LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey""")
def refill_dimension(t):
    panel = X.prices(t).select("Ticker", "Date", "Volume").join(X.info(t), "Ticker", "left")
    lookup = t.read("supplier").join(t.read("nation"), F.expr("s_nationkey = n_nationkey")).selectExpr(
        "'S' || CAST(s_suppkey AS STRING) AS Ticker", "n_name AS Sector", "s_name AS Industry")
    return J.refill_dimension(stage(panel), lookup)


# --- sorting and sets -----------------------------------------------------------------------


@query("chronological_sort", needs=["prices"], sql="SELECT Ticker, Date, Volume FROM prices ORDER BY Ticker, Date")
def chronological_sort(t):
    return A.chronological_sort(X.prices(t).select("Ticker", "Date", "Volume"))


@query("top_k", sql="""
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 25""")
def top_k(t):
    df = t.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return A.top_k(df, [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey"], 25)


@query("union_by_name", needs=["statements_a", "statements_b_raw", "prices"], sql=f"""
    SELECT Ticker, Date, NULL::DATE AS PublishDate, {r('TotalRevenue', 'TotalRevenue')}, NULL::DOUBLE AS Volume FROM statements_a
    UNION ALL SELECT Ticker, NULL, PublishDate, {r('TotalRevenue')}, NULL FROM statements_b_raw
    UNION ALL SELECT Ticker, Date, NULL, NULL, Volume FROM prices""")
def union_by_name(t):
    t = X.landed(t)
    out = A.union_by_name(X.statements_a(t).select("Ticker", "Date", "TotalRevenue"),
                          X.statements_b_raw(t).select("Ticker", "PublishDate", "TotalRevenue"),
                          X.prices(t).select("Ticker", "Date", "Volume"))
    return rounded(out, "TotalRevenue")


@query("distinct_union", needs=["prices", "constituents"], sql="""
    SELECT Ticker FROM prices UNION SELECT Ticker FROM constituents""")
def distinct_union(t):
    return A.distinct_union(X.prices(t), X.constituents(t))


@query("set_difference", needs=["prices", "constituents"], sql="""
    SELECT Ticker FROM prices EXCEPT SELECT Ticker FROM constituents""")
def set_difference(t):
    return A.set_difference(X.prices(t), X.constituents(t))


@query("key_intersection", needs=["statements_a", "statements_b"], sql="""
    SELECT Ticker, Date FROM statements_a INTERSECT SELECT Ticker, Date FROM statements_b""")
def key_intersection(t):
    t = X.landed(t)
    return A.key_intersection(X.statements_a(t), X.statements_b(t))


# --- written and read back ------------------------------------------------------------------


@query("write_panel", needs=["prices"], sql=f"""
    SELECT Ticker, Date, {r('Open', 'Open', 8)}, Volume FROM prices WHERE year(Date) BETWEEN 1996 AND 1998""")
def write_panel(t):
    path = scratch_path(t.spark)
    sinks.write_panel(X.prices(t).select("Ticker", "Date", "Open", "Volume"), path)
    return rounded(sinks.read_written(t.spark, path, "1996-01-01", "1998-12-31"), "Open", places=8)


@query("upsert_store", needs=["prices"], sql="""
    SELECT Ticker, Date, CASE WHEN year(Date) >= 1997 THEN -Volume ELSE Volume END AS Volume FROM prices""")
def upsert_store(t):
    path, rows = scratch_path(t.spark), stage(X.prices(t).select("Ticker", "Date", "Volume"))
    sinks.upsert_store(rows, path)
    return sinks.upsert_store(rows.filter("year(Date) >= 1997").withColumn("Volume", -F.col("Volume")), path)


@query("read_csv_list", sql="SELECT p_brand AS Symbol, count(*) AS n FROM part GROUP BY 1")
def read_csv_list(t):
    path = scratch_path(t.spark)
    t.read("part").select(F.col("p_brand").alias("Symbol")).write.csv(path, header=True)
    return readers.read_csv_list(t.spark, path, "Symbol string").groupBy("Symbol").agg(F.count("*").alias("n"))


@query("write_report_csv", sql="SELECT s_suppkey AS Key, s_name AS Name, s_acctbal AS Balance FROM supplier")
def write_report_csv(t):
    rows = t.read("supplier").selectExpr("s_suppkey AS Key", "s_name AS Name", "s_acctbal AS Balance")
    path = sinks.write_report_csv(rows, scratch_path(t.spark), "2026-01-05")
    return t.spark.read.schema(rows.schema).csv(path, header=True)


@query("strip_column_spaces", sql="SELECT r_regionkey AS RegionKey, r_name AS Name FROM region")
def strip_column_spaces(t):
    return R.strip_column_spaces(t.read("region").selectExpr("r_regionkey AS `Region Key`", "r_name AS ` Name `"))


@query("report", needs=["prices"], sql=f"""
    SELECT Ticker, rank AS Probability_Top, max(Date) AS Date, {r('max_by(Open, Date)', 'Open', 4)}
    FROM prices JOIN (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS Ticker, s_acctbal / 100e0 AS rank FROM supplier) USING (Ticker)
    GROUP BY 1, 2""")
def report(t):
    from panelloom.modelling.report import report
    ranking = t.read("supplier").selectExpr("'S' || CAST(s_suppkey AS STRING) AS Ticker", "s_acctbal / 100e0 AS Probability_Top")
    panel = X.prices(t).select("Ticker", "Date", "Open")
    flat, path = report(ranking.join(panel.select("Ticker").distinct(), "Ticker", "left_semi"), panel, scratch_path(t.spark), "2026-01-05")
    return rounded(t.spark.read.schema(flat.schema).csv(path, header=True), "Open", places=4)


@query("store_new_rows", needs=["prices"], sql="""
    SELECT Ticker, Date, Volume FROM prices WHERE year(Date) < 1995 OR (year(Date) >= 1997 AND month(Date) % 2 = 1)""")
def store_new_rows(t):
    """Rows that a store does not hold, by the key filters of its years."""
    path = scratch_path(t.spark)
    rows = X.prices(t).select("Ticker", "Date", "Volume")
    sinks.upsert_store(rows.filter("year(Date) >= 1995 AND (year(Date) < 1997 OR month(Date) % 2 = 0)"), path)
    return sinks.new_rows_of_store(rows, path)[0]


@query("save_exclusions", needs=["constituents", "exclusions"], sql="""
    SELECT Ticker FROM constituents UNION SELECT Ticker FROM exclusions""")
def save_exclusions(t):
    path = scratch_path(t.spark)
    sinks.save_exclusions(X.exclusions(t), path)
    sinks.save_exclusions(X.constituents(t), path)
    return sinks.read_exclusions(t.spark, path)
