"""Indicator series to one wide frame per period."""

from pyspark.sql import functions as F

from panelloom.operators.filters import drop_rows_all_null


def macro_monthly(series, indicators, indicator="indicator", value="value", at="ts", unit="month", ties=()):
    """Last known value of each indicator per period, dated to the period's last day.

    ``series`` holds one row per observation; periods without any value do not appear.
    """
    begin = F.date_trunc(unit, F.col(at))
    end = F.date_sub(F.to_date(begin + F.expr(f"INTERVAL 1 {unit.upper()}")), 1)
    order = F.struct(at, *ties) if ties else F.col(at)
    wide = (
        series.filter(F.col(value).isNotNull() & F.col(indicator).isin(list(indicators)))
        .groupBy(end.alias("Date")).pivot(indicator, list(indicators)).agg(F.max_by(value, order))
    )
    return drop_rows_all_null(wide, indicators)
