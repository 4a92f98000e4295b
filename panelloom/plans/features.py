"""Raw panel to model features."""

from pyspark.sql import functions as F

from panelloom.functions import metrics as M
from panelloom.functions.dates import years_since
from panelloom.functions.text import clean_label
from panelloom.operators import windows as W
from panelloom.operators.cross_section import cross_section_quantile
from panelloom.operators.filters import drop_rows_any_null
from panelloom.operators.impute import statement_ratios
from panelloom.operators.joins import patch_by_key
from panelloom.operators.outliers import soft_winsorize
from panelloom.operators.power import transform_yeo_johnson
from panelloom import schema as S
from panelloom.session import stage

TARGET = "Target_Top_Quintile"


def _doubles(df, exclude=()):
    return [n for n, kind in df.dtypes if kind == "double" and n not in exclude]


def clean_raw(raw, unit_errors=S.UNIT_ERRORS):
    """Labels, units and known errors: one projection."""
    named = raw.withColumns({"Industry": clean_label("Industry"), "Sector": clean_label("Sector")})
    scaled = M.scale_millions(named, S.financial_columns() + ["Volume"])
    return M.flip_sign_by_source(M.null_invalid_sign(M.fix_unit_error(scaled, unit_errors)))


def complete_statements(df):
    """Sector ratios and accounting identities. Reads a few columns of ``df`` several times."""
    identities = (M.identity_ebitda, M.identity_free_cash_flow, M.identity_debt, M.identity_liabilities)
    return M.current_assets_floor(statement_ratios(df, "DepreciationAndAmortization_TTM", "TotalAssets", identities))


def derive_features(df, as_of, growth=S.GROWTH_COLUMNS):
    """Membership age, ratios, volume, growth: all but the market-relative features."""
    out = df.withColumn("YearsInSP500", years_since(F.col("DateAdded"), as_of)).drop("DateAdded")
    out = M.average_daily_volume(M.financial_metrics(out))
    out = W.lag_value(out, ["AverageDailyVolume"])
    return M.acceleration(M.neutral_fill_with_flag(W.growth_rates(out, growth), growth), growth)


def build_features(raw, index, as_of, spared_first=S.NOT_REQUIRED_FIRST, spared_second=S.NOT_REQUIRED_SECOND,
                   power=S.POWER_COLUMNS, power_late=S.POWER_COLUMNS_LATE, clips=S.CLIP_LIMITS,
                   clips_late=S.CLIP_LIMITS_LATE, patches=None, unit_errors=S.UNIT_ERRORS):
    """The clean panel: statements completed, features derived, transformed and labelled.

    Three wide tables are staged: the cleaned input, the completed statements and the complete
    features. Everything between them is a chain of projections, small joins and one window
    partitioning by entity; the global statistics read only the columns they need.
    """
    cleaned = clean_raw(raw, unit_errors)
    if patches:
        cleaned = patch_by_key(cleaned, patches)
    completed = complete_statements(W.require_panel(stage(cleaned)))
    completed = W.rolling_impute(completed, _doubles(completed))
    completed = stage(drop_rows_any_null(completed, spared=spared_first))

    featured = W.returns_and_betas(derive_features(completed, as_of), index)
    known = [c for c in completed.columns if c not in spared_first]
    open_cols = [c for c in _doubles(featured, known) if featured.schema[c].nullable]
    featured = W.rolling_impute(featured, open_cols)
    featured = stage(drop_rows_any_null(featured, spared=spared_second))

    out = M.log_transform(featured, S.LOG_COLUMNS, plus_one=True)
    out = transform_yeo_johnson(out, power, source=featured)
    out = M.clip_one_side(out, clips)
    untouched = S.financial_columns() + S.flag_columns(out) + [
        "Close", "Open", "AverageDailyVolume_Lag1", "MonthlyExcessReturn"]
    out = soft_winsorize(out, _doubles(out, untouched))
    out = M.log_transform(out, S.LOG_COLUMNS_LATE, plus_one=True)
    out = M.clip_one_side(transform_yeo_johnson(out, power_late), clips_late)
    labelled = cross_section_quantile(out, "MonthlyExcessReturn")
    return labelled.withColumn(TARGET, M.binary_label("MonthlyExcessReturn_Quantile"))
