"""Aggregations, imputation, cross-sections, outliers and evaluation figures."""

from pyspark.sql import functions as F

from panelloom.catalog import fixtures as X
from panelloom.catalog.merges_q import ASOF
from panelloom.catalog.registry import query, r, rounded, rs
from panelloom.operators import aggregates as A, cross_section as Z, impute as I, outliers as O
from panelloom.operators import power as P, ranking as K
from panelloom.session import stage

# --- history and universe ---------------------------------------------------------------------


@query("min_history_filter", needs=["statements"], sql="""
    SELECT Ticker, q FROM statements WHERE TotalDebt IS NOT NULL AND Ticker IN
      (SELECT Ticker FROM statements WHERE TotalDebt IS NOT NULL GROUP BY Ticker HAVING count(*) >= 18)""")
def min_history_filter(t):
    known = X.statements(t).dropna(subset=["TotalDebt"]).select("Ticker", "q")
    return A.min_history_filter(known, 18)


@query("universe_top_n", needs=["statements", "exclusions"], sql=f"""
    SELECT Ticker, {r('avg(TotalRevenue)', 'mean_TotalRevenue')} FROM statements
    WHERE Ticker NOT IN (SELECT Ticker FROM exclusions) GROUP BY Ticker HAVING count(*) >= 19
    ORDER BY avg(TotalRevenue) DESC, Ticker LIMIT 50""")
def universe_top_n(t):
    df = X.statements(t).select("Ticker", "TotalRevenue")
    return rounded(A.universe_top_n(df, "TotalRevenue", 19, 50, X.exclusions(t)), "mean_TotalRevenue")


@query("stale_tickers", needs=["info", "prices_gappy"], sql="""
    SELECT i.Ticker FROM info i LEFT JOIN
      (SELECT Ticker, max(Date) AS last FROM prices_gappy WHERE Open IS NOT NULL GROUP BY Ticker) p USING (Ticker)
    WHERE last IS NULL OR last < DATE '2001-11-01'""")
def stale_tickers(t):
    return A.stale_tickers(X.info(t), X.prices_gappy(t).dropna(subset=["Open"]), "2001-11-20")


# --- shares, counts, moments --------------------------------------------------------------------

_NULLED = list(X.NULL_RULES)


@query("null_share", needs=["statements"], sql=f"""
    SELECT * FROM ({' UNION ALL '.join(
        f"SELECT '{c}' AS column, {r(f'avg(CAST({c} IS NULL AS INTEGER))', 'share')} FROM statements" for c in [*_NULLED, 'TotalRevenue'])})
    WHERE share > 0""")
def null_share(t):
    return rounded(A.null_share(X.statements(t), [*_NULLED, "TotalRevenue"]), "share")


@query("null_share_by_group", needs=["metrics_input"], sql=f"""
    SELECT Sector, {r('avg(CAST(TotalDebt IS NULL AS INTEGER)) * 100', 'percent_null')} FROM metrics_input GROUP BY Sector""")
def null_share_by_group(t):
    return rounded(A.null_share_by_group(X.metrics_input(t), "TotalDebt", "Sector"), "percent_null")


@query("value_counts", sql='SELECT event_type, count(*) AS "count" FROM events GROUP BY 1 ORDER BY 2 DESC, 1')
def value_counts(t):
    return A.value_counts(t.read("events"), "event_type")


_SKEWED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("skewness", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS column, {r(f'skewness({c})', 'skew')} FROM lineitem" for c in _SKEWED))
def skewness(t):
    return rounded(A.skewness(t.read("lineitem"), _SKEWED), "skew")


_DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount"]
_STATS = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]


@query("describe", sql=" UNION ALL ".join(f"""
    SELECT '{c}' AS column, CAST(count({c}) AS DOUBLE) AS "count", {r(f'avg({c})', 'mean', 7)}, {r(f'stddev_samp({c})', 'std', 7)},
      {r(f'min({c})', '"min"', 7)}, {r(f'quantile_cont({c}, 0.25)', 'q25', 7)}, {r(f'quantile_cont({c}, 0.5)', 'q50', 7)},
      {r(f'quantile_cont({c}, 0.75)', 'q75', 7)}, {r(f'max({c})', '"max"', 7)} FROM lineitem""" for c in _DESCRIBED))
def describe(t):
    return rounded(A.describe(t.read("lineitem"), _DESCRIBED), *_STATS, places=7)


@query("row_at_extreme", sql="""
    (SELECT *, 'max' AS which FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1)
    UNION ALL (SELECT *, 'min' AS which FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1)""")
def row_at_extreme(t):
    orders = t.read("orders")
    top = A.row_at_extreme(orders, "o_totalprice", True, ["o_orderkey"]).withColumn("which", F.lit("max"))
    return top.union(A.row_at_extreme(orders, "o_totalprice", False, ["o_orderkey"]).withColumn("which", F.lit("min")))


@query("publication_lag_stats", needs=["periods", "publications"], extra=ASOF + [
    ("lags", "SELECT CAST(floor((epoch_us(Published) - epoch_us(PeriodEnd)) / 86400000000) AS BIGINT) AS lag "
             "FROM hits WHERE Published IS NOT NULL")], sql=f"""
    SELECT count(*) AS n, {r('avg(lag)', 'mean')}, quantile_cont(lag, 0.5) AS median, min(lag) AS min, max(lag) AS max,
      {r('quantile_cont(lag, 0.75)', 'p75')}, {r('quantile_cont(lag, 0.9)', 'p90')} FROM lags""")
def publication_lag_stats(t):
    out = A.publication_lag_stats(X.periods(t), X.publications(t), "Entity", "PeriodEnd", "Published", 2)
    return rounded(out, "mean", "p75", "p90")


@query("distinct_count", sql="SELECT count(DISTINCT user_id) AS n_distinct FROM events")
def distinct_count(t):
    return A.distinct_count(t.read("events"), "user_id")


@query("latest_class_counts", sql="""
    SELECT event_type, count(*) AS "count" FROM (SELECT * FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) GROUP BY 1""")
def latest_class_counts(t):
    return A.latest_class_counts(t.read("events"), "event_type", "user_id", "ts", [F.desc("event_id")])


# --- imputation ---------------------------------------------------------------------------------

_GROUP_MEDIAN = ("SELECT {0} AS grp, quantile_cont({1}, 0.5) AS med FROM {2} WHERE {0} IS NOT NULL GROUP BY {0}")


@query("group_median_impute", needs=["metrics_input"], extra=[
    ("g", _GROUP_MEDIAN.format("Sector", "TotalDebt", "metrics_input"))], sql=f"""
    SELECT Ticker, Date, {r('coalesce(TotalDebt, med, (SELECT quantile_cont(TotalDebt, 0.5) FROM metrics_input))', 'TotalDebt')}
    FROM metrics_input LEFT JOIN g ON grp = Sector""")
def group_median_impute(t):
    df = stage(X.metrics_input(t).select("Ticker", "Date", "Sector", "TotalDebt"))
    return rounded(I.group_median_impute(df, "TotalDebt", "Sector").drop("Sector"), "TotalDebt")


_DA = "DepreciationAndAmortization_TTM"
RATIO_FILL = [
    ("ratios", f"SELECT *, CASE WHEN TotalAssets > 0 THEN {_DA} / TotalAssets END AS ratio FROM metrics_input"),
    ("g1", _GROUP_MEDIAN.format("Sector", "ratio", "ratios")),
    ("filled", f"""SELECT r.Ticker, r.Date, r.Sector, coalesce({_DA},
        coalesce(med, (SELECT quantile_cont(ratio, 0.5) FROM ratios)) * TotalAssets) AS v
        FROM ratios r LEFT JOIN g1 ON grp = Sector"""),
    ("g2", _GROUP_MEDIAN.format("Sector", "v", "filled")),
]


@query("group_ratio_impute", needs=["metrics_input"], extra=RATIO_FILL, sql=f"""
    SELECT Ticker, Date, {r('coalesce(v, med, (SELECT quantile_cont(v, 0.5) FROM filled))', _DA)}
    FROM filled LEFT JOIN g2 ON grp = Sector""")
def group_ratio_impute(t):
    df = stage(X.metrics_input(t).select("Ticker", "Date", "Sector", "TotalAssets", _DA))
    out = I.group_ratio_impute(df, _DA, "Sector", "TotalAssets")
    return rounded(out.select("Ticker", "Date", _DA), _DA)


@query("current_assets_by_sector", needs=["metrics_input"], extra=[
    ("ca", "SELECT *, CurrentAssets / nullif(TotalAssets, 0) AS ratio FROM metrics_input"),
    ("g", _GROUP_MEDIAN.format("Sector", "ratio", "ca"))], sql=f"""
    SELECT Ticker, Date, {r('coalesce(CurrentAssets, TotalAssets * coalesce(med, (SELECT quantile_cont(ratio, 0.5) FROM ca)))', 'CurrentAssets')}
    FROM ca LEFT JOIN g ON grp = Sector""")
def current_assets_by_sector(t):
    df = stage(X.metrics_input(t).select("Ticker", "Date", "Sector", "TotalAssets", "CurrentAssets"))
    return rounded(I.current_assets_by_group(df).select("Ticker", "Date", "CurrentAssets"), "CurrentAssets")


# --- cross-sections -------------------------------------------------------------------------------


@query("cross_section_quantile", needs=["prices"], extra=[
    ("edges", """SELECT Date, count(Volume) AS n, quantile_cont(Volume, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS e
        FROM prices GROUP BY Date""")], sql="""
    SELECT Ticker, Date, CASE WHEN n >= 5 AND len(list_distinct(e)) > 1 THEN
      greatest(1, CAST(len(list_filter(list_distinct(e), lambda x: x < Volume)) AS INTEGER)) END AS Volume_Quantile
    FROM prices JOIN edges USING (Date)""")
def cross_section_quantile(t):
    return Z.cross_section_quantile(stage(X.prices(t).select("Ticker", "Date", "Volume")), "Volume")


@query("cross_section_zscore", needs=["prices", "info"], extra=[
    ("sectored", "SELECT p.*, Sector FROM prices p LEFT JOIN info USING (Ticker)"),
    ("stats", """SELECT Date, Sector, avg(Open) AS mo, stddev_samp(Open) AS so, count(Open) AS no,
        avg(Volume) AS mv, stddev_samp(Volume) AS sv, count(Volume) AS nv FROM sectored WHERE Sector IS NOT NULL GROUP BY 1, 2""")],
    sql=f"""
    SELECT x.Ticker, x.Date, x.Sector,
      {r('coalesce(CASE WHEN no >= 5 THEN (Open - mo) / nullif(so, 0) END, 0)', 'Open')},
      {r('coalesce(CASE WHEN nv >= 5 THEN (Volume - mv) / nullif(sv, 0) END, 0)', 'Volume')}
    FROM sectored x LEFT JOIN stats s ON s.Date = x.Date AND s.Sector = x.Sector""")
def cross_section_zscore(t):
    df = X.prices(t).join(X.info(t), "Ticker", "left").select("Ticker", "Date", "Sector", "Open", "Volume")
    return rounded(Z.cross_section_zscore(stage(df), ["Open", "Volume"]), "Open", "Volume")


# --- outliers and power transform -------------------------------------------------------------------

_OUT = ["Margin", "Revenue", "Cover"]
_SPREAD = [("spread", """SELECT Ticker, Date, OperatingIncome_TTM / nullif(NetIncome_TTM, 0) AS Margin, TotalRevenue_TTM AS Revenue,
    EBITDA_TTM / nullif(CurrentDebt, 0) AS Cover FROM metrics_input""")]


def _spread(t):
    return stage(X.metrics_input(t).select(
        "Ticker", "Date", (F.try_divide("OperatingIncome_TTM", "NetIncome_TTM")).alias("Margin"),
        F.col("TotalRevenue_TTM").alias("Revenue"), F.try_divide("EBITDA_TTM", "CurrentDebt").alias("Cover")))


def _rules_sql(c):
    return [
        (f"m_{c}", f"""SELECT avg({c}) AS mean, stddev_samp({c}) AS std, skewness({c}) AS skew, count({c}) AS n,
            quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med, quantile_cont({c}, 0.75) AS q3 FROM spread"""),
        (f"d_{c}", f"SELECT quantile_cont(abs({c} - med), 0.5) AS mad FROM spread, m_{c}"),
        (f"o_{c}", f"""SELECT Ticker, Date, {c} AS x, n, q1, q3, coalesce(
            (CASE WHEN abs(skew) < 3 THEN abs(({c} - mean) / std) > 3 ELSE abs(({c} - med) / mad) > 6 END)
            AND ({c} < q1 - 3 * (q3 - q1) OR {c} > q3 + 3 * (q3 - q1)), false) AS far FROM spread, m_{c}, d_{c}"""),
        (f"b_{c}", f"""SELECT max(x) FILTER (far AND x < q1) AS lo, min(x) FILTER (far AND x > q3) AS hi,
            count(*) FILTER (far AND x < q1) / max(n) AS l, count(*) FILTER (far AND x > q3) / max(n) AS h FROM o_{c}"""),
    ]


_RULES = _SPREAD + [x for c in _OUT for x in _rules_sql(c)]
_BY_ROW = " JOIN ".join(
    f"(SELECT Ticker, Date, {{{i}}} FROM o_{c}, b_{c}) t{i}" + (" USING (Ticker, Date)" if i else "")
    for i, c in enumerate(_OUT))


@query("outlier_share", needs=["metrics_input"], extra=_RULES, sql=" UNION ALL ".join(
    f"SELECT '{c}' AS column, {r('l * 100', 'low')}, {r('h * 100', 'high')}, {r('(l + h) * 100', 'total')} FROM b_{c}" for c in _OUT))
def outlier_share(t):
    return rounded(O.outlier_share(_spread(t), _OUT), "low", "high", "total")


@query("soft_winsorize", needs=["metrics_input"], extra=_RULES, sql=f"""
    SELECT Ticker, Date, {rs(_OUT)} FROM {_BY_ROW.format(*[
        f'CASE WHEN x > hi THEN hi + ln(1 + x - hi) WHEN x < lo THEN lo - ln(1 + lo - x) ELSE x END AS {c}' for c in _OUT])}""")
def soft_winsorize(t):
    return rounded(O.soft_winsorize(_spread(t), _OUT), *_OUT)


@query("outliers_to_null", needs=["metrics_input"], extra=_RULES, sql=f"""
    SELECT Ticker, Date, {rs(_OUT)} FROM {_BY_ROW.format(*[f'CASE WHEN NOT far THEN x END AS {c}' for c in _OUT])}""")
def outliers_to_null(t):
    return rounded(O.outliers_to_null(_spread(t), _OUT), *_OUT)


@query("yeo_johnson", needs=["metrics_input"])
def yeo_johnson(t):
    df = X.metrics_input(t).select("Ticker", "Date", "NetIncome_TTM", "TotalRevenue_TTM", "StockholdersEquity")
    return P.transform_yeo_johnson(stage(df), ["NetIncome_TTM", "TotalRevenue_TTM", "StockholdersEquity"])


def _yj_sql(x, lam):
    up = f"ln(1 + {x})" if lam == 0 else f"(power(1 + {x}, {lam}e0) - 1) / {lam}e0"
    down = f"-ln(1 - {x})" if lam == 2 else f"-(power(1 - {x}, {2 - lam}e0) - 1) / {2 - lam}e0"
    return f"CASE WHEN {x} >= 0 THEN {up} ELSE {down} END"


_FIXED = {"Margin": 0.5, "Revenue": 0.0, "Cover": 2.0}


@query("yeo_johnson_fixed", needs=["metrics_input"], extra=_SPREAD + [
    ("shaped", "SELECT Ticker, Date, " + ", ".join(f"{_yj_sql(c, lam)} AS {c}" for c, lam in _FIXED.items()) + " FROM spread")],
    sql=f"""SELECT Ticker, Date, {', '.join(r(
        f'({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()', f'{c}_Yeo') for c in _FIXED)} FROM shaped""")
def yeo_johnson_fixed(t):
    out = P.transform_yeo_johnson(_spread(t), list(_FIXED), _FIXED)
    return rounded(out, *[f"{c}_Yeo" for c in _FIXED])


# --- evaluation ---------------------------------------------------------------------------------------


@query("residual_summary", needs=["predictions_reg"], sql=f"""
    SELECT Ticker, {r('avg(Predicted)', 'Predicted')}, {r('avg(Observed)', 'Observed')}, {r('avg(Predicted - Observed)', 'Residuals')},
      CASE WHEN avg(Predicted - Observed) >= 0 THEN 'PositiveBias' ELSE 'NegativeBias' END AS Cluster
    FROM predictions_reg GROUP BY Ticker""")
def residual_summary(t):
    return rounded(A.residual_summary(X.predictions_reg(t)), "Predicted", "Observed", "Residuals")


@query("bias_cluster_stats", needs=["predictions_reg"], extra=[
    ("res", "SELECT Ticker, avg(Predicted - Observed) AS v FROM predictions_reg GROUP BY Ticker")], sql=f"""
    SELECT CASE WHEN v >= 0 THEN 'PositiveBias' ELSE 'NegativeBias' END AS Cluster, count(*) AS n,
      {r('avg(v)', 'mean_residual')} FROM res GROUP BY 1""")
def bias_cluster_stats(t):
    return rounded(A.bias_cluster_stats(A.residual_summary(X.predictions_reg(t))), "mean_residual")


@query("regression_metrics", needs=["predictions_reg"], sql=f"""
    SELECT {r('avg(abs(Predicted - Observed))', 'MAE')}, {r('avg((Predicted - Observed) * (Predicted - Observed))', 'MSE', 3)},
      {r('sqrt(avg((Predicted - Observed) * (Predicted - Observed)))', 'RMSE')},
      {r('1 - avg((Predicted - Observed) * (Predicted - Observed)) / var_pop(Observed)', 'R2')} FROM predictions_reg""")
def regression_metrics(t):
    out = A.regression_metrics(X.predictions_reg(t))
    return rounded(rounded(out, "MAE", "RMSE", "R2"), "MSE", places=3)


@query("confusion_matrix", needs=["predictions_cls"], sql="""
    SELECT actual, predicted, count(*) AS "count" FROM predictions_cls GROUP BY 1, 2""")
def confusion_matrix(t):
    return A.confusion_matrix(X.predictions_cls(t))


@query("precision", needs=["predictions_cls"], sql=f"""
    SELECT {r('count(*) FILTER (actual = 1 AND predicted = 1) / count(*) FILTER (predicted = 1)', 'precision')}
    FROM predictions_cls""")
def precision(t):
    return rounded(A.precision(X.predictions_cls(t)), "precision")


@query("time_series_folds", needs=["prices"], extra=[
    ("placed", "SELECT Ticker, Date, row_number() OVER (ORDER BY Date, Ticker) - 1 AS pos, count(*) OVER () AS n FROM prices")], sql="""
    SELECT Ticker, Date, CAST(CASE WHEN pos < n - 5 * (n // 6) THEN 0 ELSE (pos - (n - 5 * (n // 6))) // (n // 6) + 1 END AS INTEGER) AS fold
    FROM placed""")
def time_series_folds(t):
    return K.expanding_folds(X.prices(t).select("Ticker", "Date"))
