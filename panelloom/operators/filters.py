"""Row filters."""

from pyspark.sql import functions as F

from panelloom.functions.dates import as_date
from panelloom.schema import CRITICAL_METRICS, KEY, TIME, numeric_columns, squeeze


def drop_future_rows(df, as_of, time=TIME):
    return df.filter(F.col(time) <= as_date(as_of))


def filter_universe(df, universe, key=KEY):
    return df.join(universe.select(key), key, "left_semi")


def exclude_listed(df, exclusions, key=KEY):
    return df.join(exclusions.select(key), key, "left_anti")


def drop_rows_any_null(df, cols=None, spared=()):
    """Drop rows with a null in any of ``cols`` (default: every numeric column but ``spared``)."""
    return df.dropna(how="any", subset=numeric_columns(df, spared) if cols is None else list(cols))


def drop_rows_all_null(df, cols=tuple(squeeze(c) for c in CRITICAL_METRICS)):
    return df.dropna(how="all", subset=list(cols))


def split_latest_date(df, time=TIME):
    """(history, live): rows before the last date and rows on it.

    The last date is a scalar subquery, so both sides are plain filters on the scan.
    """
    last = df.select(F.max(time)).scalar()
    return df.filter(F.col(time) < last), df.filter(F.col(time) == last)


def anomaly_listing(df, condition, cols):
    """The rows that break a rule."""
    return df.filter(condition).select(*cols)
