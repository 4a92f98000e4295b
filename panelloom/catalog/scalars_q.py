"""Sources and row scalars."""

from pyspark.sql import functions as F

from panelloom import schema as S
from panelloom.catalog import fixtures as X
from panelloom.catalog.registry import query, r, rounded, rs
from panelloom.functions import dates, metrics as M, text
from panelloom.sources import readers, sinks
from panelloom.operators import joins as J
from panelloom.session import stage

# --- sources ------------------------------------------------------------------------------


@query("read_panel", sql="""
    SELECT event_id, ts, user_id, event_type, CASE WHEN NOT isnan(value) THEN value END AS value, props
    FROM events""")
def read_panel(t):
    return readers.read_panel(t.spark, f"{t.folder}/events.parquet")


@query("read_keys_pruned", sql="SELECT l_suppkey, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem")
def read_keys_pruned(t):
    return readers.read_keys_pruned(t.spark, f"{t.folder}/lineitem.parquet", "l_suppkey", "l_shipdate")


FAMILY_SQL = [("fam", """
    SELECT s.*, CASE i.Sector WHEN 'ASIA' THEN 'banks' WHEN 'EUROPE' THEN 'insurance' ELSE 'general' END AS family
    FROM statements_b_raw s JOIN info i USING (Ticker)""")] + [
    (f"joined_{f}", f"""
    SELECT coalesce(a.Ticker, b.Ticker, c.Ticker) AS Ticker, coalesce(a.ReportDate, b.ReportDate, c.ReportDate) AS ReportDate,
           a.PublishDate, a.EBITDA, b.TotalAssets, {'c.FreeCashFlow' if f != 'banks' else 'CAST(NULL AS DOUBLE) AS FreeCashFlow'}
    FROM (SELECT * FROM fam WHERE family = '{f}' AND EBITDA IS NOT NULL) a
    FULL JOIN (SELECT * FROM fam WHERE family = '{f}' AND TotalAssets IS NOT NULL) b
      ON a.Ticker = b.Ticker AND a.ReportDate = b.ReportDate
    FULL JOIN (SELECT * FROM fam WHERE family = '{f}' AND FreeCashFlow IS NOT NULL) c
      ON coalesce(a.Ticker, b.Ticker) = c.Ticker AND coalesce(a.ReportDate, b.ReportDate) = c.ReportDate""")
    for f in ("general", "banks", "insurance")]


@query("load_statements", needs=["statements_b_raw", "info"], extra=FAMILY_SQL, sql=f"""
    SELECT Ticker, ReportDate, PublishDate, {rs(['EBITDA', 'TotalAssets', 'FreeCashFlow'])} FROM (
    SELECT * FROM joined_general UNION ALL SELECT * FROM joined_banks UNION ALL SELECT * FROM joined_insurance)""")
def load_statements(t):
    sector = X.info(t).select("Ticker", F.when(F.col("Sector") == "ASIA", "banks").when(
        F.col("Sector") == "EUROPE", "insurance").otherwise("general").alias("family"))
    raw = stage(X.statements_b_raw(t).select("Ticker", "ReportDate", "PublishDate", "EBITDA", "TotalAssets", "FreeCashFlow").join(
        sector, "Ticker").withColumnsRenamed({"PublishDate": "Publish Date", "ReportDate": "Report Date"}))
    families = []
    for name in ("general", "banks", "insurance"):
        part = raw.filter(F.col("family") == name)
        keep = ["Ticker", "Report Date", "Publish Date"]
        cash = part.dropna(subset=["FreeCashFlow"]).select(*keep, *(["FreeCashFlow"] if name != "banks" else []))
        families.append((part.dropna(subset=["EBITDA"]).select(*keep, "EBITDA"),
                         part.dropna(subset=["TotalAssets"]).select(*keep, "TotalAssets"), cash))
    out = readers.load_statements(families).withColumnsRenamed(
        {"Publish Date": "PublishDate", "Report Date": "ReportDate"})
    return rounded(out, "EBITDA", "TotalAssets", "FreeCashFlow")


@query("append_exclusions", needs=["constituents", "exclusions"], sql="""
    SELECT Ticker FROM constituents UNION SELECT Ticker FROM exclusions""")
def append_exclusions(t):
    return sinks.append_exclusions(X.constituents(t), X.exclusions(t))


# --- symbols, labels, names ----------------------------------------------------------------

_SYMBOL = "concat(' ', replace(p_brand, '#', '.'), ' x ')"


@query("clean_symbol", sql=f"""
    SELECT p_partkey, replace(replace(trim({_SYMBOL}), '.', '-'), ' ', '') AS symbol FROM part""")
def clean_symbol(t):
    return t.read("part").select("p_partkey", text.clean_symbol(F.expr(_SYMBOL)).alias("symbol"))


@query("remap_symbol", sql="""
    SELECT p_partkey, CASE p_brand WHEN 'Brand#2' THEN 'Brand#52' WHEN 'Brand#17' THEN 'Brand#71'
           ELSE p_brand END AS symbol FROM part""")
def remap_symbol(t):
    changes = {"Brand#2": "Brand#52", "Brand#17": "Brand#71"}
    return t.read("part").select("p_partkey", text.remap_symbol("p_brand", changes).alias("symbol"))


_LABEL = "concat(p_type, ' & ', replace(p_name, ' ', '-'))"


@query("clean_label", sql=f"""
    SELECT p_partkey, array_to_string(list_transform(
        string_split(trim(regexp_replace(replace({_LABEL}, '-', ' '), '\\s+', ' ', 'g')), ' '),
        lambda w: CASE WHEN w = '&' THEN 'And' ELSE upper(w[1]) || lower(w[2:]) END), ' ') AS label
    FROM part""")
def clean_label(t):
    return t.read("part").select("p_partkey", text.clean_label(F.expr(_LABEL)).alias("label"))


_B_NAMES = {k: S.squeeze(v) for k, v in S.PROVIDER_B_NAMES.items()}
_MISSING = ", ".join(f'CAST(NULL AS DOUBLE) AS "{c}"' for c in S.COMPUTED_LATER)


@query("standardise_columns", needs=["statements_b_raw"], sql=f"""
    SELECT {', '.join(r(S.squeeze(v), f'"{v}"') for v in S.PROVIDER_B_NAMES.values())}, {_MISSING},
      CAST(date_trunc('month', coalesce(PublishDate, ReportDate) + INTERVAL 1 MONTH) AS DATE) AS Date,
      Ticker, '{S.PROVIDER_B}' AS FinancialsSource
    FROM statements_b_raw""")
def standardise_columns(t):
    raw = X.statements_b_raw(t).select(
        "Ticker", F.col("ReportDate").alias("Report Date"), F.col("PublishDate").alias("Publish Date"),
        *[F.col(v).alias(k) for k, v in _B_NAMES.items()])
    return rounded(readers.standardise_columns(raw), *S.PROVIDER_B_NAMES.values())


@query("add_source_tag", needs=["statements_a"], sql=f"""
    SELECT Ticker, Date, '{S.PROVIDER_A}' AS FinancialsSource FROM statements_a""")
def add_source_tag(t):
    return readers.add_source_tag(X.statements_a(t).select("Ticker", "Date"), S.PROVIDER_A)


@query("drop_columns", sql="SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def drop_columns(t):
    named = t.read("orders").withColumnsRenamed(
        {"o_custkey": "High", "o_orderstatus": "Low", "o_orderpriority": "Adj Close"})
    return readers.drop_columns(named)


# --- dates ----------------------------------------------------------------------------------


@query("publish_date_fallback", needs=["statements_b_raw"], sql="""
    SELECT Ticker, ReportDate, coalesce(PublishDate, ReportDate) AS PublishDate FROM statements_b_raw""")
def publish_date_fallback(t):
    return X.statements_b_raw(t).select(
        "Ticker", "ReportDate", dates.publish_date(F.col("PublishDate"), F.col("ReportDate")).alias("PublishDate"))


@query("next_month_begin", sql="""
    SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) AS aligned FROM orders""")
def next_month_begin(t):
    return t.read("orders").select("o_orderkey", dates.next_month_begin("o_orderdate").alias("aligned"))


@query("fixed_delay_date", sql="""
    SELECT event_id, CAST(CAST(ts AS DATE) + INTERVAL 30 DAY AS DATE) AS delayed FROM events""")
def fixed_delay_date(t):
    return t.read("events").select("event_id", dates.fixed_delay_date("ts").alias("delayed"))


@query("utc_midnight", sql="""
    SELECT event_id, CAST(ts + INTERVAL 5 HOUR AS DATE) AS utc_day FROM events""")
def utc_midnight(t):
    return t.read("events").select("event_id", dates.utc_midnight(F.col("ts"), "-05:00").alias("utc_day"))


@query("years_since", needs=["constituents"], sql="""
    SELECT Ticker, coalesce(round_even((DATE '2010-06-30' - TRY_CAST(DateAdded AS DATE)) / 365.25e0, 0), 0.0e0)
           AS YearsInIndex FROM constituents""")
def years_since(t):
    return X.constituents(t).select("Ticker", dates.years_since(F.col("DateAdded"), "2010-06-30").alias("YearsInIndex"))


# --- corrections ----------------------------------------------------------------------------

_FIN = S.financial_columns()


@query("scale_millions", needs=["metrics_input"], sql=f"""
    SELECT Ticker, Date, {', '.join(r(f'{c} / 1e6', c, 11) for c in _FIN)} FROM metrics_input""")
def scale_millions(t):
    df = X.metrics_input(t).select("Ticker", "Date", *_FIN)
    return rounded(M.scale_millions(df, _FIN), *_FIN, places=11)


@query("fix_unit_error", needs=["statements_a"], sql=f"""
    SELECT Ticker, Date, {', '.join(r(
        f"CASE WHEN Ticker = 'S1' AND Date = DATE '2000-05-01' THEN {c} / 1000 ELSE {c} END", c)
        for c in S.UNIT_ERROR_COLUMNS)} FROM statements_a""")
def fix_unit_error(t):
    df = X.statements_a(t).select("Ticker", "Date", *S.UNIT_ERROR_COLUMNS)
    return rounded(M.fix_unit_error(df, [("S1", "2000-05-01", 1000.0)]), *S.UNIT_ERROR_COLUMNS)


TAGGED = [("tagged", """
    SELECT Ticker, Date, OperatingIncome, NetIncome, DepreciationAndAmortization, FinancialsSource FROM statements_a
    UNION ALL SELECT Ticker, Date, OperatingIncome, NetIncome, DepreciationAndAmortization, FinancialsSource FROM statements_b""")]
_TAG = ["Ticker", "Date", "OperatingIncome", "NetIncome", "DepreciationAndAmortization", "FinancialsSource"]


def _tagged(t):
    t = X.landed(t)
    return X.statements_a(t).select(*_TAG).union(X.statements_b(t).select(*_TAG))


@query("null_invalid_sign", needs=["statements_a", "statements_b"], extra=TAGGED, sql=f"""
    SELECT Ticker, Date, FinancialsSource, {r('CASE WHEN NetIncome >= 0 THEN NetIncome END', 'NetIncome')},
      {r(f"CASE WHEN OperatingIncome >= 0 OR FinancialsSource <> '{S.PROVIDER_A}' THEN OperatingIncome END", 'OperatingIncome')},
      {r('DepreciationAndAmortization', 'DepreciationAndAmortization')} FROM tagged""")
def null_invalid_sign(t):
    out = M.null_invalid_sign(_tagged(t), ["NetIncome"], ["OperatingIncome"])
    return rounded(out, "NetIncome", "OperatingIncome", "DepreciationAndAmortization")


@query("flip_sign_by_source", needs=["statements_a", "statements_b"], extra=TAGGED, sql=f"""
    SELECT Ticker, Date, FinancialsSource, {r('NetIncome', 'NetIncome')}, {', '.join(r(
      f"CASE WHEN FinancialsSource = '{S.PROVIDER_B}' AND {c} < 0 THEN abs({c}) ELSE {c} END", c)
      for c in ('OperatingIncome', 'DepreciationAndAmortization'))} FROM tagged""")
def flip_sign_by_source(t):
    out = M.flip_sign_by_source(_tagged(t), ["OperatingIncome", "DepreciationAndAmortization"])
    return rounded(out, "NetIncome", "OperatingIncome", "DepreciationAndAmortization")


@query("patch_by_key", needs=["info"], sql="""
    SELECT Ticker, CASE Ticker WHEN 'S0' THEN 'Technology' WHEN 'S3' THEN 'Services' ELSE Sector END AS Sector,
      CASE Ticker WHEN 'S0' THEN 'Instruments' WHEN 'S3' THEN 'Brokers' ELSE Industry END AS Industry FROM info""")
def patch_by_key(t):
    return J.patch_by_key(X.info(t), [("S0", "Technology", "Instruments"), ("S3", "Services", "Brokers")])


# --- ratios ---------------------------------------------------------------------------------

_DEBT = "coalesce(TotalDebt, coalesce(CurrentDebt, 0) + coalesce(LongTermDebt, 0))"
VALUED = [("valued", f"""
    SELECT *, Open * BasicAverageShares_TTM AS MarketCap,
      Open * BasicAverageShares_TTM + {_DEBT} - coalesce(CashAndCashEquivalents, 0) AS EnterpriseValue
    FROM metrics_input""")]


def _ratio(a, b):
    return f"({a}) / nullif({b}, 0)"


RATIOS = {
    "valuation_yields": {
        "EarningsYield": _ratio("NetIncome_TTM", "MarketCap"),
        "EbitdaYield": _ratio("EBITDA_TTM", "EnterpriseValue"),
        "RevenueYield": _ratio("TotalRevenue_TTM", "EnterpriseValue"),
        "BookToMarket": _ratio("StockholdersEquity", "MarketCap"),
        "AssetToMarket": _ratio("TotalAssets", "MarketCap"),
    },
    "profitability_ratios": {
        "OperatingMargins": _ratio("OperatingIncome_TTM", "TotalRevenue_TTM"),
        "ProfitMargins": _ratio("NetIncome_TTM", "TotalRevenue_TTM"),
        "ReturnOnAssets": _ratio("NetIncome_TTM", "TotalAssets"),
        "ReturnOnEquity": f"CASE WHEN StockholdersEquity <= 0 THEN -abs({_ratio('NetIncome_TTM', 'StockholdersEquity')}) "
                          f"ELSE {_ratio('NetIncome_TTM', 'StockholdersEquity')} END",
    },
    "solvency_ratios": {
        "DebtToEquity": f"CASE WHEN StockholdersEquity > 0 THEN ({_DEBT}) / StockholdersEquity END",
        "CurrentRatio": _ratio("CurrentAssets", "CurrentLiabilities"),
        "NetDebtToEbitda": _ratio(f"{_DEBT} - CashAndCashEquivalents", "EBITDA_TTM"),
    },
    "cashflow_ratios": {
        "FcfToEbitda": _ratio("FreeCashFlow_TTM", "EBITDA_TTM"),
        "CapExToRevenue": _ratio("abs(CapitalExpenditure_TTM)", "TotalRevenue_TTM"),
        "AccrualsRatio": _ratio("NetIncome_TTM - OperatingCashFlow_TTM", "TotalAssets"),
    },
}


@query("market_cap_ev", needs=["metrics_input"], extra=VALUED, sql=f"""
    SELECT Ticker, Date, {rs(['MarketCap', 'EnterpriseValue'], 7)} FROM valued""")
def market_cap_ev(t):
    out = M.market_cap_ev(X.metrics_input(t)).select("Ticker", "Date", "MarketCap", "EnterpriseValue")
    return rounded(out, "MarketCap", "EnterpriseValue", places=7)


def _register_ratios(name, step):
    columns = RATIOS[name]
    sql = ", ".join(r(e, c, 9) for c, e in columns.items())

    @query(name, needs=["metrics_input"], extra=VALUED, sql=f"SELECT Ticker, Date, {sql} FROM valued")
    def run(t):
        out = step(M.market_cap_ev(X.metrics_input(t))).select("Ticker", "Date", *columns)
        return rounded(out, *columns, places=9)


for _name in RATIOS:
    _register_ratios(_name, getattr(M, _name))


@query("inf_to_null_and_round", sql=f"""
    SELECT l_orderkey, l_linenumber, l_partkey,
      CASE WHEN l_discount <> l_tax THEN round_even(l_tax / (l_discount - l_tax), 6) + 0.0e0 END AS ratio
    FROM lineitem""")
def inf_to_null_and_round(t):
    d = F.col("l_discount") - F.col("l_tax")
    unbounded = F.when(d != 0, F.col("l_tax") / d).otherwise(F.lit(float("inf")))
    df = t.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", unbounded.alias("ratio"))
    return M.inf_to_null_and_round(df, ["ratio"], ["ratio"])


@query("average_daily_volume", needs=["prices"], sql=f"""
    SELECT Ticker, Date, {r('Volume / 21', 'AverageDailyVolume')} FROM prices""")
def average_daily_volume(t):
    out = M.average_daily_volume(X.prices(t).select("Ticker", "Date", "Volume"))
    return rounded(out, "AverageDailyVolume")


_PREV = {n: f"lag(Open, {k}) OVER (PARTITION BY Ticker ORDER BY Date)" for n, k in (("YoY", 12), ("QoQ", 3))}
GROWN = [("grown", "SELECT Ticker, Date, " + ", ".join(
    f"CASE WHEN Open IS NOT NULL AND {p} IS NOT NULL THEN greatest(-10.0e0, least(10.0e0, (Open - {p}) / abs({p}))) END AS Open_{n}"
    for n, p in _PREV.items()) + " FROM prices_gappy")]


def _grown(t):
    from panelloom.operators.windows import growth_rates
    return growth_rates(X.prices_gappy(t).select("Ticker", "Date", "Open"), ["Open"]).drop("Open")


@query("acceleration", needs=["prices_gappy"], extra=GROWN, sql=f"""
    SELECT Ticker, Date, {r('Open_QoQ - Open_YoY', 'Open_Acceleration')} FROM grown""")
def acceleration(t):
    out = M.acceleration(_grown(t), ["Open"]).select("Ticker", "Date", "Open_Acceleration")
    return rounded(out, "Open_Acceleration")


@query("neutral_fill_with_flag", needs=["prices_gappy"], extra=GROWN, sql=f"""
    SELECT Ticker, Date, {r('coalesce(Open_YoY, 0.03e0)', 'Open_YoY')}, {r('coalesce(Open_QoQ, 0.0074e0)', 'Open_QoQ')},
      CAST(Open_YoY IS NULL AS INTEGER) AS Open_YoY_IsMissing, CAST(Open_QoQ IS NULL AS INTEGER) AS Open_QoQ_IsMissing
    FROM grown""")
def neutral_fill_with_flag(t):
    return rounded(M.neutral_fill_with_flag(_grown(t), ["Open"]), "Open_YoY", "Open_QoQ")


@query("log_transform", sql=f"""
    SELECT l_orderkey, l_linenumber, l_partkey,
      {r('CASE WHEN l_discount > 0 THEN ln(l_discount) END', 'l_discount_Log')},
      {r('ln(1 + l_extendedprice)', 'l_extendedprice_Log1p')} FROM lineitem""")
def log_transform(t):
    df = t.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_extendedprice")
    out = M.log_transform(M.log_transform(df, ["l_discount"]), ["l_extendedprice"], plus_one=True)
    return rounded(out, "l_discount_Log", "l_extendedprice_Log1p")


@query("clip_one_side", needs=["metrics_input"], sql=f"""
    SELECT Ticker, Date,
      {r('CASE WHEN NetIncome_TTM > 5000 THEN 5000 WHEN NetIncome_TTM < -2000 THEN -2000 ELSE NetIncome_TTM END', 'NetIncome_TTM')},
      {r('CASE WHEN EBITDA_TTM < 0 THEN 0 ELSE EBITDA_TTM END', 'EBITDA_TTM')} FROM metrics_input""")
def clip_one_side(t):
    df = X.metrics_input(t).select("Ticker", "Date", "NetIncome_TTM", "EBITDA_TTM")
    out = M.clip_one_side(df, [("NetIncome_TTM", 5000.0), ("NetIncome_TTM", -2000.0), ("EBITDA_TTM", 0.0)])
    return rounded(out, "NetIncome_TTM", "EBITDA_TTM")


@query("binary_label", sql="""
    SELECT p_partkey, CASE WHEN nullif(p_size, 7) = 5 THEN 1 ELSE 0 END AS label FROM part""")
def binary_label(t):
    return t.read("part").select("p_partkey", M.binary_label(F.expr("nullif(p_size, 7)")).alias("label"))


@query("signal_label", sql="""
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_discount > 0.05e0 THEN 'Top_Quantile' ELSE 'Neutral' END AS signal
    FROM lineitem""")
def signal_label(t):
    predicted = (F.col("l_discount") > 0.05).cast("int")
    return t.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", M.signal_label(predicted).alias("signal"))


# --- identities -----------------------------------------------------------------------------


@query("identity_ebitda", needs=["metrics_input"], sql=f"""
    SELECT Ticker, Date, {r('coalesce(EBITDA_TTM, OperatingIncome_TTM + DepreciationAndAmortization_TTM)', 'EBITDA_TTM')}
    FROM metrics_input""")
def identity_ebitda(t):
    return rounded(M.identity_ebitda(X.metrics_input(t)).select("Ticker", "Date", "EBITDA_TTM"), "EBITDA_TTM")


@query("identity_free_cash_flow", needs=["metrics_input"], sql=f"""
    SELECT Ticker, Date, {r('coalesce(FreeCashFlow_TTM, OperatingCashFlow_TTM - abs(CapitalExpenditure_TTM))', 'FreeCashFlow_TTM')}
    FROM metrics_input""")
def identity_free_cash_flow(t):
    out = M.identity_free_cash_flow(X.metrics_input(t)).select("Ticker", "Date", "FreeCashFlow_TTM")
    return rounded(out, "FreeCashFlow_TTM")


def cascade(source, total, short, long, prefix):
    """The ordered completion steps, one CTE per step."""
    keep = "Ticker, Date"
    steps = [
        (f"{keep}, CASE WHEN t IS NULL AND s IS NOT NULL AND g IS NOT NULL THEN s + g ELSE t END AS t, s, g"),
        (f"{keep}, t, CASE WHEN t = 0 AND s IS NULL THEN 0 ELSE s END AS s, CASE WHEN t = 0 AND g IS NULL THEN 0 ELSE g END AS g"),
        (f"{keep}, t, CASE WHEN s IS NULL THEN t - g ELSE s END AS s, g"),
        (f"{keep}, t, s, CASE WHEN g IS NULL THEN t - s ELSE g END AS g"),
        (f"{keep}, t, CASE WHEN t IS NOT NULL AND s IS NULL AND g IS NULL THEN t * (1 - 0.8e0) ELSE s END AS s, "
         "CASE WHEN t IS NOT NULL AND s IS NULL AND g IS NULL THEN t * 0.8e0 ELSE g END AS g"),
        (f"{keep}, CASE WHEN t IS NULL AND s IS NULL THEN g / 0.8e0 ELSE t END AS t, "
         "CASE WHEN t IS NULL AND s IS NULL THEN g / 0.8e0 * (1 - 0.8e0) ELSE s END AS s, g"),
        (f"{keep}, CASE WHEN t IS NULL AND g IS NULL THEN s / (1 - 0.8e0) ELSE t END AS t, s, "
         "CASE WHEN t IS NULL AND g IS NULL THEN s / (1 - 0.8e0) * 0.8e0 ELSE g END AS g"),
    ]
    out = [(f"{prefix}0", f"SELECT {keep}, {total} AS t, {short} AS s, {long} AS g FROM {source}")]
    out += [(f"{prefix}{i + 1}", f"SELECT {text} FROM {prefix}{i}") for i, text in enumerate(steps)]
    final = (f"SELECT Ticker, Date, {r('t', total)}, {r('CASE WHEN s < 0 THEN 0 ELSE s END', short)}, "
             f"{r('CASE WHEN g < 0 THEN 0 ELSE g END', long)} FROM {prefix}{len(steps)}")
    return out, final


_DEBT_STEPS, _DEBT_SQL = cascade("metrics_input", "TotalDebt", "CurrentDebt", "LongTermDebt", "debt")
_LIAB_STEPS, _LIAB_SQL = cascade(
    "metrics_input", "TotalLiabilities", "CurrentLiabilities", "TotalNoncurrentLiabilities", "liab")


@query("identity_debt", needs=["metrics_input"], extra=_DEBT_STEPS, sql=_DEBT_SQL)
def identity_debt(t):
    cols = ["TotalDebt", "CurrentDebt", "LongTermDebt"]
    return rounded(M.identity_debt(X.metrics_input(t).select("Ticker", "Date", *cols)), *cols)


@query("identity_liabilities", needs=["metrics_input"], extra=_LIAB_STEPS, sql=_LIAB_SQL)
def identity_liabilities(t):
    cols = ["TotalLiabilities", "CurrentLiabilities", "TotalNoncurrentLiabilities"]
    return rounded(M.identity_liabilities(X.metrics_input(t).select("Ticker", "Date", *cols)), *cols)


@query("current_assets_floor", needs=["metrics_input"], sql=f"""
    SELECT Ticker, Date, {r('''CASE WHEN CurrentAssets IS NULL THEN CashAndCashEquivalents
      WHEN CurrentAssets < CashAndCashEquivalents THEN CashAndCashEquivalents ELSE CurrentAssets END''', 'CurrentAssets')}
    FROM metrics_input""")
def current_assets_floor(t):
    out = M.current_assets_floor(X.metrics_input(t)).select("Ticker", "Date", "CurrentAssets")
    return rounded(out, "CurrentAssets")
