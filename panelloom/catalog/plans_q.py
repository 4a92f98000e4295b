"""Composed jobs and modelling over the panel derived from the test tables."""

from pyspark.sql import functions as F

from panelloom import schema as S
from panelloom.catalog import fixtures as X
from panelloom.catalog.merges_q import MERGED
from panelloom.catalog.registry import query, r, rounded, rs
from panelloom.catalog.stats_q import _SPREAD, _spread
from panelloom.modelling import contributions as N, forest as O, report as Q, validation as V
from panelloom.operators import joins as J
from panelloom.operators.filters import split_latest_date
from panelloom.operators.power import fit_exponents
from panelloom.operators.ranking import expanding_folds
from panelloom.plans import features as P, macro, phases, raw_panel as R, train as T
from panelloom.session import scratch_path, stage
from panelloom.sources import sinks

AS_OF = "2001-12-31"
INVERSE = {S.squeeze(c): c for c in S.INCOME + S.BALANCE + S.CASH_FLOW}
TO_RAW = {S.squeeze(v): k for k, v in S.PROVIDER_B_NAMES.items()}


# --- raw panel --------------------------------------------------------------------------------


def provider_b(t):
    """Provider B as landed: its own names, without the figures computed later."""
    later = [S.squeeze(c) for c in S.COMPUTED_LATER]
    return (X.statements_b_raw(t).drop("k", *later)
            .withColumnsRenamed({**TO_RAW, "ReportDate": "Report Date", "PublishDate": "Publish Date"}))


def provider_a(t):
    """Provider A as dated, with an earlier period of the same month next to every third row."""
    rows = X.statements_a(t).withColumnsRenamed(INVERSE).withColumn(R.PERIOD_END, F.date_sub("Date", 31))
    clash = rows.filter(F.crc32(F.col("Ticker").cast("binary")) % 3 == 0).withColumns(
        {R.PERIOD_END: F.date_sub(R.PERIOD_END, 9), "Total Revenue": F.col("Total Revenue") * 2})
    return rows.unionByName(clash)


def raw_panel(t):
    """The raw panel of all suppliers that qualify, from landed fixtures."""
    t = X.landed(t)
    return R.build_raw_panel(
        provider_b(t), X.prices(t), provider_a(t), X.info(t), X.constituents(t),
        AS_OF, exclusions=X.exclusions(t), metric="Revenue", min_rows=19, top=None)


def _carry(c, n):
    return f"last_value({c} IGNORE NULLS) OVER (PARTITION BY Ticker ORDER BY Date ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"


_FLOW_SQL = ["TotalRevenue", "NetIncome", "EBITDA", "BasicAverageShares", "DepreciationAndAmortization"]
_STOCK_SQL = ["TotalAssets", "TotalDebt"]
_FIN_SQL = [f"{c}_TTM" for c in _FLOW_SQL] + _STOCK_SQL
RAW_STEPS = [
    ("uni", """SELECT Ticker FROM statements_b_raw WHERE Ticker NOT IN (SELECT Ticker FROM exclusions)
        GROUP BY Ticker HAVING count(*) >= 19"""),
    ("second", f"""SELECT * REPLACE (CAST(NULL AS DOUBLE) AS EBITDA, CAST(NULL AS DOUBLE) AS TotalDebt, CAST(NULL AS DOUBLE) AS FreeCashFlow)
        FROM statements_b WHERE Ticker IN (SELECT Ticker FROM uni) AND Date <= DATE '{AS_OF}'"""),
    ("px", "SELECT * FROM prices WHERE Ticker IN (SELECT Ticker FROM uni)"),
    ("first_side", "SELECT * FROM statements_a WHERE Ticker IN (SELECT Ticker FROM px)"),
    ("joined", MERGED[0][1].replace("FROM statements_a a", "FROM first_side a").replace("JOIN statements_b b", "JOIN second b")),
    ("filled2", "SELECT Ticker, Date, FinancialsSource, TotalAssets, TotalDebt, " + ", ".join(
        f"{_carry(c, 2)} AS {c}" for c in _FLOW_SQL) + " FROM joined"),
    ("ttm", "SELECT Ticker, Date, FinancialsSource, TotalAssets, TotalDebt, " + ", ".join(
        f"avg({c}) OVER w{'' if c == 'BasicAverageShares' else ' * 4'} AS {c}_TTM" for c in _FLOW_SQL)
     + " FROM filled2 WINDOW w AS (PARTITION BY Ticker ORDER BY Date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"),
    ("wide", """SELECT p.*, t.* EXCLUDE (Ticker, Date), i.Sector, i.Industry, c.DateAdded FROM px p
        LEFT JOIN ttm t ON t.Ticker = p.Ticker AND t.Date = p.Date
        LEFT JOIN info i ON i.Ticker = p.Ticker LEFT JOIN constituents c ON c.Ticker = p.Ticker"""),
]
_FINAL_SELECT = "Ticker, Date, Open, Volume, Sector, Industry, DateAdded, " + ", ".join(
    f"{_carry(c, 6)} AS {c}" for c in [*_FIN_SQL, "FinancialsSource"])
RAW_SQL = f"""
    SELECT Ticker, Date, {r('Open', 'Open', 8)}, Volume, Sector, Industry, DateAdded, FinancialsSource, {rs(_FIN_SQL)}
    FROM (SELECT {_FINAL_SELECT} FROM wide)
    WHERE Open IS NOT NULL AND (TotalAssets IS NOT NULL OR NetIncome_TTM IS NOT NULL)"""
RAW_NEEDS = ["statements_a", "statements_b", "prices", "info", "constituents", "exclusions"]


@query("build_raw_panel", needs=RAW_NEEDS, extra=RAW_STEPS, sql=RAW_SQL)
def build_raw_panel(t):
    out = raw_panel(t).select("Ticker", "Date", "Open", "Volume", "Sector", "Industry", "DateAdded",
                              "FinancialsSource", *_FIN_SQL)
    return rounded(rounded(out, *_FIN_SQL), "Open", places=8)


def land(t, folder):
    """The fixtures as landed files: two families of provider B, line items of provider A, long prices."""
    b = stage(provider_b(t))
    keys, shared = ["Ticker", "Report Date"], [c for c in b.columns if c in S.STATEMENT_METADATA]
    values = [c for c in b.columns if c not in keys + shared]
    for number, family in enumerate(("general", "banks")):
        own = b.filter(F.crc32(F.col("Ticker").cast("binary")) % 2 == number)
        for k, statement in enumerate(phases.STATEMENTS):
            own.select(*keys, *([] if k else shared), *values[k::3]).write.parquet(f"{folder}/statements_b/{family}/{statement}")
    a = stage(X.statements(t).filter("q >= DATE'2000-01-01'").withColumnsRenamed(INVERSE).withColumnRenamed("ReportDate", R.PERIOD_END))
    for statement, names in zip(phases.STATEMENTS, (S.INCOME, S.BALANCE, S.CASH_FLOW)):
        have = [c for c in names if c in a.columns]
        a.select("Ticker", R.PERIOD_END, *have).unpivot(["Ticker", R.PERIOD_END], have, "Item", "Value").write.parquet(
            f"{folder}/statements_a/{statement}")
    for name, table in (("prices", X.prices(t)), ("market_index", X.market(t)), ("info", X.info(t)), ("constituents", X.constituents(t))):
        table.write.parquet(f"{folder}/{name}")


@query("raw_job", needs=RAW_NEEDS, extra=RAW_STEPS, sql=RAW_SQL)
def raw_job(t):
    """Extraction from landed files into the store, read back."""
    landed, root = scratch_path(t.spark), scratch_path(t.spark)
    land(X.landed(t), landed)
    sinks.save_exclusions(X.exclusions(t), f"{root}/exclusions")
    store = phases.extract(t.spark, landed, root, AS_OF, ("general", "banks"), "Revenue", 19, None)
    out = store.select("Ticker", "Date", "Open", "Volume", "Sector", "Industry", "DateAdded", "FinancialsSource", *_FIN_SQL)
    return rounded(rounded(out, *_FIN_SQL), "Open", places=8)


_SPARSE = ["TotalAssets", "NetIncome_TTM", "TotalDebt"]


@query("final_clean", needs=["prices_gappy", "statements_b"], extra=[
    ("wide", """SELECT p.Ticker, p.Date, p.Open, s.TotalAssets, s.NetIncome AS NetIncome_TTM, s.TotalDebt, s.FinancialsSource
        FROM prices_gappy p LEFT JOIN statements_b s ON s.Ticker = p.Ticker AND s.Date = p.Date"""),
    ("carried", "SELECT Ticker, Date, Open, " + ", ".join(f"{_carry(c, 6)} AS {c}" for c in [*_SPARSE, "FinancialsSource"]) + " FROM wide")],
    sql=f"""SELECT Ticker, Date, {r('Open', 'Open', 8)}, FinancialsSource, {rs(_SPARSE)} FROM carried
        WHERE Open IS NOT NULL AND (TotalAssets IS NOT NULL OR NetIncome_TTM IS NOT NULL)""")
def final_clean(t):
    wide = J.join_prices_financials(
        X.prices_gappy(t).select("Ticker", "Date", "Open"),
        X.statements_b(t).selectExpr("Ticker", "Date", "TotalAssets", "NetIncome AS NetIncome_TTM", "TotalDebt", "FinancialsSource"))
    return rounded(rounded(R.final_clean(wide), *_SPARSE), "Open", places=8)


_KINDS = ["click", "error", "purchase", "signup", "view"]


@query("macro_monthly", sql=f"""
    SELECT CAST(ts AS DATE) AS Date, {', '.join(f"max_by(value, row(ts, event_id)) FILTER (event_type = '{k}') AS {k}" for k in _KINDS)}
    FROM events WHERE value IS NOT NULL GROUP BY 1""")
def macro_monthly(t):
    return macro.macro_monthly(t.read("events"), _KINDS, "event_type", unit="day", ties=["event_id"])


# --- power transform: the exponents themselves -----------------------------------------------------

_GRID_POINTS, _GRID_ROUNDS = 17, 8


def _grid_rounds():
    """Nested grid search in plain SQL: eight rounds of 17 exponents from [-3, 5]."""
    values = " UNION ALL ".join(f"SELECT '{c}' AS c, {c} AS x FROM spread WHERE {c} IS NOT NULL" for c in ("Margin", "Revenue", "Cover"))
    steps = [("vals", f"SELECT c, x, sign(x) * ln(1 + abs(x)) AS s FROM ({values})"),
             ("b0", "SELECT DISTINCT c, -3.0e0 AS lo, 5.0e0 AS hi FROM vals")]
    up = "CASE WHEN lam = 0 THEN ln(1 + x) ELSE (power(1 + x, lam) - 1) / lam END"
    down = "CASE WHEN lam = 2 THEN -ln(1 - x) ELSE -(power(1 - x, 2 - lam) - 1) / (2 - lam) END"
    for i in range(_GRID_ROUNDS):
        steps += [
            (f"g{i}", f"SELECT c, (hi - lo) / {_GRID_POINTS - 1} AS step, lo + (hi - lo) * k / {_GRID_POINTS - 1} AS lam FROM b{i}, range({_GRID_POINTS}) t(k)"),
            (f"l{i}", f"""SELECT c, lam, step, -0.5 * ln(var_pop(y)) + (lam - 1) * avg(s) AS ll FROM (
                SELECT v.c, lam, step, s, CASE WHEN x >= 0 THEN {up.replace('1 + x', '1 + greatest(x, 0)')}
                  ELSE {down.replace('1 - x', '1 - least(x, 0)')} END AS y FROM vals v JOIN g{i} g ON g.c = v.c) GROUP BY 1, 2, 3"""),
            (f"b{i + 1}", f"SELECT c, arg_max(lam, ll) - max(step) AS lo, arg_max(lam, ll) + max(step) AS hi FROM l{i} GROUP BY c"),
        ]
    return steps


@query("yeo_johnson_exponents", needs=["metrics_input"], extra=_SPREAD + _grid_rounds(), sql=f"""
    SELECT c AS column, {r('(lo + hi) / 2', 'exponent', 3)} FROM b{_GRID_ROUNDS}""")
def yeo_johnson_exponents(t):
    fitted = fit_exponents(_spread(t), ["Margin", "Revenue", "Cover"])
    return rounded(t.spark.createDataFrame(list(fitted.items()), "column string, exponent double"), "exponent", places=3)


# --- features and model -----------------------------------------------------------------------------


def feature_panel(t):
    landed = X.landed(t)
    return P.build_features(raw_panel(landed), X.market(landed), AS_OF)


def _clean(t):
    return stage(feature_panel(t))


def _trained(t):
    return T.train(_clean(t))


@query("build_features")
def build_features(t):
    return feature_panel(t)


@query("encode_features")
def encode_features(t):
    from pyspark.ml.functions import vector_to_array
    _, history, live = T.prepare(_clean(t))
    both = history.union(live)
    return both.select("Ticker", "Date", O.LABEL, vector_to_array("features").alias("features"))


@query("class_weights", needs=["predictions_cls"], sql=f"""
    SELECT actual, predicted, {r('count(*) OVER () / (2.0e0 * count(*) OVER (PARTITION BY actual))', 'weight')} FROM predictions_cls""")
def class_weights(t):
    return rounded(O.class_weights(X.predictions_cls(t), "actual"), "weight")


@query("fit_forest")
def fit_forest(t):
    trained = _trained(t)
    scored = trained.model.transform(trained.history)
    return scored.select("Ticker", "Date", O.LABEL, F.col("prediction").cast("int").alias("predicted"),
                         O.probability_of().alias("probability"))


@query("ranked_predictions")
def ranked_predictions(t):
    trained = _trained(t)
    return O.ranked_predictions(trained.model, trained.live)


@query("train_and_rank")
def train_and_rank(t):
    panel = _clean(t)
    return Q.report_join(T.train_and_rank(panel)[0], panel).select(
        "Ticker", "Predicted_Class", "Probability_Top", "Signal", "Date", "Sector", "Industry", "Open", "Close")


@query("report_join")
def report_join(t):
    panel = _clean(t)
    trained = T.train(panel)
    return Q.report_join(O.ranked_predictions(trained.model, trained.live), panel)


_SCORED = ("scored", """SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS Ticker,
    count(*) FILTER (l_returnflag = 'R') / CAST(count(*) AS DOUBLE) AS p FROM lineitem GROUP BY 1""")
_RANKED = f"""SELECT Ticker, CAST(p > 0.25 AS INTEGER) AS Predicted_Class, {r('p', 'Probability_Top', 9)},
    CASE WHEN p > 0.25 THEN 'Top_Quantile' ELSE 'Neutral' END AS Signal FROM scored"""


def _scored(t):
    """Suppliers with the share of returned lines as their probability."""
    share = F.count_if(F.col("l_returnflag") == "R") / F.count("*").cast("double")
    rows = t.read("lineitem").groupBy(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("Ticker")).agg(share.alias("p"))
    return rows.withColumn("prediction", (F.col("p") > 0.25).cast("double"))


@query("rank_scores", extra=[_SCORED], sql=_RANKED)
def rank_scores(t):
    return rounded(O.rank_scores(_scored(t), F.col("p")), "Probability_Top", places=9)


@query("report_of_scores", needs=["prices"], extra=[_SCORED, ("ranked", _RANKED), (
    "latest", "SELECT * FROM prices QUALIFY row_number() OVER (PARTITION BY Ticker ORDER BY Date DESC) = 1")], sql=f"""
    SELECT k.*, Date, {r('Open', 'Open', 8)}, Volume FROM ranked k LEFT JOIN latest l ON l.Ticker = k.Ticker""")
def report_of_scores(t):
    """The report join over table-derived probabilities."""
    ranked = rounded(O.rank_scores(_scored(t), F.col("p")), "Probability_Top", places=9)
    joined = Q.report_join(ranked, X.prices(t).select("Ticker", "Date", "Open", "Volume"))
    return rounded(joined, "Open", places=8)


@query("feature_importance")
def feature_importance(t):
    trained = _trained(t)
    return O.feature_importance(t.spark, trained.model, trained.names)


@query("prediction_contributions")
def prediction_contributions(t):
    trained = _trained(t)
    return N.prediction_contributions(trained.model, trained.live, trained.names)


@query("time_series_cv")
def time_series_cv(t):
    return V.time_series_cv(split_latest_date(_clean(t))[0], parallelism=3)


@query("grid_search_ts")
def grid_search_ts(t):
    return V.grid_search_ts(split_latest_date(_clean(t))[0], {"numTrees": [S.FOREST["numTrees"]]}, parallelism=3)


@query("history_figures")
def history_figures(t):
    confusion, precise = T.history_figures(_trained(t))
    return confusion.withColumn("precision", F.lit(precise.first()["precision"]))


@query("encoded_fixture", needs=["prices", "info"], extra=[
    ("secs", "SELECT Sector, row_number() OVER (ORDER BY Sector) AS code FROM (SELECT DISTINCT Sector FROM info WHERE Sector IS NOT NULL)"),
    ("panel", "SELECT p.Ticker, p.Date, p.Open, i.Sector FROM prices p JOIN info i ON i.Ticker = p.Ticker")],
    sql=f"""
    SELECT Ticker, Date, {r('''coalesce(CASE WHEN count(Open) OVER w >= 5 AND p.Sector IS NOT NULL THEN
        (Open - avg(Open) OVER w) / nullif(stddev_samp(Open) OVER w, 0) END, 0e0)''', 'z', 6)},
      CAST(coalesce(code, (SELECT count(*) + 1 FROM secs)) AS INTEGER) AS code
    FROM panel p LEFT JOIN secs s ON s.Sector = p.Sector WINDOW w AS (PARTITION BY Date, p.Sector)""")
def encoded_fixture(t):
    """Scaling and one-hot codes over table-derived rows."""
    from pyspark.ml.functions import vector_to_array
    panel = X.prices(t).select("Ticker", "Date", "Open").join(X.info(t).select("Ticker", "Sector"), "Ticker")
    scaled = stage(O.scale_features(panel, ["Open"]))
    vectors = O.encoder(["Open"], ["Sector"]).fit(scaled).transform(scaled).withColumn("v", vector_to_array("features"))
    return rounded(vectors.select("Ticker", "Date", F.col("v")[0].alias("z"), F.expr(
        "CAST(array_position(slice(v, 2, size(v) - 1), 1.0D) AS INT)").alias("code")), "z")


@query("model_invariants", sql="""
    SELECT * FROM (VALUES ('additive contributions', true), ('balanced weights', true), ('importance sums to one', true),
      ('one confusion count per row', true), ('whole folds', true)) v(figure, holds)""")
def model_invariants(t):
    """What must hold for any fitted model, as rows that SQL can state."""
    trained = _trained(t)
    n = trained.history.count()
    weights = [row["w"] for row in O.class_weights(trained.history).groupBy(O.LABEL).agg(F.sum("weight").alias("w")).collect()]
    gap = N.additivity_gap(N.prediction_contributions(trained.model, trained.live, trained.names)).first()["gap"]
    importance = sum(row["importance"] for row in O.feature_importance(t.spark, trained.model, trained.names).collect())
    confusion = T.history_figures(trained)[0].agg(F.sum("count")).first()[0]
    folds = {row["fold"]: row["count"] for row in expanding_folds(trained.history.select("Ticker", "Date")).groupBy("fold").count().collect()}
    held = {
        "additive contributions": gap < 1e-9,
        "balanced weights": all(abs(w - n / len(weights)) < 1e-6 * n for w in weights),
        "importance sums to one": abs(importance - 1) < 1e-9,
        "one confusion count per row": confusion == n,
        "whole folds": all(folds[k] == n // 6 for k in range(1, 6)) and sum(folds.values()) == n,
    }
    return t.spark.createDataFrame([(k, bool(v)) for k, v in held.items()], "figure string, holds boolean")
