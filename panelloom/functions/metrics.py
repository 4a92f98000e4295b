"""Financial scalars: projections over one panel row."""

from pyspark.sql import functions as F

from panelloom.schema import (
    CLIP_LIMITS, LONG_SHARE, PROVIDER_A, PROVIDER_B, QOQ_NEUTRAL, ROUNDED_RATIOS, SOURCE,
    TRADING_DAYS_PER_MONTH, UNIT_ERROR_COLUMNS, UNIT_ERRORS, YOY_NEUTRAL, KEY, TIME,
)


def scale_millions(df, cols):
    return df.withColumns({c: F.col(c) / 1e6 for c in cols})


def fix_unit_error(df, rules=UNIT_ERRORS, cols=UNIT_ERROR_COLUMNS, key=KEY, time=TIME):
    """Divide ``cols`` on the rows listed as (key, date, divisor); the list is a few literals."""
    divisor = F.coalesce(*[
        F.when((F.col(key) == k) & (F.col(time) == F.to_date(F.lit(d))), F.lit(float(x)))
        for k, d, x in rules
    ], F.lit(1.0))
    return df.withColumns({c: F.col(c) / divisor for c in cols})


def null_invalid_sign(df, cols=("TotalRevenue_TTM", "CurrentDebt", "LongTermDebt"),
                      guarded=("DepreciationAndAmortization_TTM",), source=SOURCE, provider=PROVIDER_A):
    """Negative values to null; the ``guarded`` columns only on rows of one provider."""
    plain = {c: F.when(~(F.col(c) < 0), F.col(c)) for c in cols}
    ours = F.col(source).eqNullSafe(provider)
    return df.withColumns({**plain, **{c: F.when(~((F.col(c) < 0) & ours), F.col(c)) for c in guarded}})


def flip_sign_by_source(df, cols=("DepreciationAndAmortization_TTM",), source=SOURCE, provider=PROVIDER_B):
    """Negative values of one provider to absolute ones; rows merged from both are left alone."""
    ours = F.col(source).eqNullSafe(provider)
    return df.withColumns({c: F.when(ours, F.abs(c)).otherwise(F.col(c)) for c in cols})


def average_daily_volume(df, days=TRADING_DAYS_PER_MONTH):
    return df.withColumn("AverageDailyVolume", F.col("Volume") / days).drop("Volume")


# --- valuation and ratios ---------------------------------------------------------------


def _zero_if_null(c):
    return F.coalesce(F.col(c), F.lit(0.0))


def debt_known():
    return F.coalesce(F.col("TotalDebt"), _zero_if_null("CurrentDebt") + _zero_if_null("LongTermDebt"))


def market_cap_ev(df):
    cap = F.col("Open") * F.col("BasicAverageShares_TTM")
    value = cap + debt_known() - _zero_if_null("CashAndCashEquivalents")
    return df.withColumns({"MarketCap": cap, "EnterpriseValue": value})


def valuation_yields(df):
    """Needs MarketCap and EnterpriseValue; a zero denominator gives null."""
    return df.withColumns({
        "EarningsYield": F.try_divide("NetIncome_TTM", "MarketCap"),
        "EbitdaYield": F.try_divide("EBITDA_TTM", "EnterpriseValue"),
        "RevenueYield": F.try_divide("TotalRevenue_TTM", "EnterpriseValue"),
        "BookToMarket": F.try_divide("StockholdersEquity", "MarketCap"),
        "AssetToMarket": F.try_divide("TotalAssets", "MarketCap"),
    })


def profitability_ratios(df):
    roe = F.try_divide("NetIncome_TTM", "StockholdersEquity")
    return df.withColumns({
        "OperatingMargins": F.try_divide("OperatingIncome_TTM", "TotalRevenue_TTM"),
        "ProfitMargins": F.try_divide("NetIncome_TTM", "TotalRevenue_TTM"),
        "ReturnOnAssets": F.try_divide("NetIncome_TTM", "TotalAssets"),
        "ReturnOnEquity": F.when(F.col("StockholdersEquity") <= 0, -F.abs(roe)).otherwise(roe),
    })


def solvency_ratios(df):
    """Cash stays null in the net debt, unlike in the enterprise value."""
    debt = debt_known()
    return df.withColumns({
        "DebtToEquity": F.when(~(F.col("StockholdersEquity") <= 0),
                               F.try_divide(debt, F.col("StockholdersEquity"))),
        "CurrentRatio": F.try_divide("CurrentAssets", "CurrentLiabilities"),
        "NetDebtToEbitda": F.try_divide(debt - F.col("CashAndCashEquivalents"), F.col("EBITDA_TTM")),
    })


def cashflow_ratios(df):
    return df.withColumns({
        "FcfToEbitda": F.try_divide("FreeCashFlow_TTM", "EBITDA_TTM"),
        "CapExToRevenue": F.try_divide(F.abs("CapitalExpenditure_TTM"), F.col("TotalRevenue_TTM")),
        "AccrualsRatio": F.try_divide(
            F.col("NetIncome_TTM") - F.col("OperatingCashFlow_TTM"), F.col("TotalAssets")),
    })


def inf_to_null_and_round(df, infinite=None, round_cols=ROUNDED_RATIOS, places=6):
    """Infinities to null in ``infinite`` (default: every double), then round ``round_cols``."""
    doubles = [n for n, kind in df.dtypes if kind == "double"] if infinite is None else list(infinite)
    finite = {c: F.when(F.abs(c) != float("inf"), F.col(c)) for c in doubles}
    rounded = {c: F.bround(finite.get(c, F.col(c)), places) for c in round_cols}
    return df.withColumns({**finite, **rounded})


def financial_metrics(df):
    """Capitalisation, then all ratios, then rounding."""
    out = df
    for step in (market_cap_ev, valuation_yields, profitability_ratios, solvency_ratios, cashflow_ratios):
        out = step(out)
    return inf_to_null_and_round(out)


# --- growth ------------------------------------------------------------------------------


def acceleration(df, cols):
    return df.withColumns({f"{c}_Acceleration": F.col(f"{c}_QoQ") - F.col(f"{c}_YoY") for c in cols})


def neutral_fill_with_flag(df, cols, yearly=YOY_NEUTRAL, quarterly=QOQ_NEUTRAL):
    """Unknown growth to a neutral rate, with a 0/1 ``_IsMissing`` flag per column."""
    rates = {f"{c}_QoQ": quarterly for c in cols} | {f"{c}_YoY": yearly for c in cols}
    flags = {f"{c}_IsMissing": F.col(c).isNull().cast("int") for c in rates}
    return df.withColumns({**flags, **{c: F.coalesce(F.col(c), F.lit(x)) for c, x in rates.items()}})


# --- transforms and labels ---------------------------------------------------------------


def log_transform(df, cols, plus_one=False):
    """``<name>_Log`` or ``<name>_Log1p`` in place of the original; null where undefined."""
    fn, suffix = (F.log1p, "_Log1p") if plus_one else (F.log, "_Log")
    return df.select(*[c for c in df.columns if c not in cols],
                     *[fn(c).alias(c + suffix) for c in cols])


def clip_one_side(df, limits=CLIP_LIMITS):
    """Positive limits are ceilings, others floors; nulls stay null."""
    changes = {}
    for c, limit in limits:
        x = changes.get(c, F.col(c))
        beyond = x > limit if limit > 0 else x < limit
        changes[c] = F.when(beyond, F.lit(float(limit))).otherwise(x)
    return df.withColumns(changes)


def binary_label(col, top=5):
    column = F.col(col) if isinstance(col, str) else col
    return F.coalesce((column == top).cast("int"), F.lit(0))


def signal_label(col, target=1, signal="Top_Quantile"):
    column = F.col(col) if isinstance(col, str) else col
    return F.when(column == target, signal).otherwise("Neutral")


# --- accounting identities ---------------------------------------------------------------


def identity_ebitda(df):
    value = F.col("OperatingIncome_TTM") + F.col("DepreciationAndAmortization_TTM")
    return df.withColumn("EBITDA_TTM", F.coalesce(F.col("EBITDA_TTM"), value))


def identity_free_cash_flow(df):
    value = F.col("OperatingCashFlow_TTM") - F.abs("CapitalExpenditure_TTM")
    return df.withColumn("FreeCashFlow_TTM", F.coalesce(F.col("FreeCashFlow_TTM"), value))


def identity_split(df, total, short, long, share=LONG_SHARE, floor=True):
    """Complete total = short + long from whichever parts are known.

    Order of preference: the sum of both parts; a zero total makes both parts zero; the
    missing part by subtraction; a fixed share from the single known figure. Written over
    the input columns only, so it is one projection and no step reads another's result.
    """
    t, s, g = F.col(total), F.col(short), F.col(long)
    rest = 1 - share
    zero = F.when(t == 0, F.lit(0.0))
    from_short, from_long = s / rest, g / share
    parts = {
        short: F.coalesce(s, zero, t - g, t * rest, from_long * rest),
        long: F.coalesce(g, zero, t - s, t * share, from_short * share),
    }
    if floor:
        parts = {c: F.when(x < 0, F.lit(0.0)).otherwise(x) for c, x in parts.items()}
    return df.withColumns({total: F.coalesce(t, s + g, from_long, from_short), **parts})


def identity_debt(df):
    return identity_split(df, "TotalDebt", "CurrentDebt", "LongTermDebt")


def identity_liabilities(df):
    return identity_split(df, "TotalLiabilities", "CurrentLiabilities", "TotalNoncurrentLiabilities")


def current_assets_floor(df, assets="CurrentAssets", cash="CashAndCashEquivalents"):
    a, c = F.col(assets), F.col(cash)
    return df.withColumn(assets, F.when(a.isNull() | (a < c), F.coalesce(c, a)).otherwise(a))
