"""Calendar alignment. Clocks are arguments (``as_of``), never read inside."""

from pyspark.sql import functions as F

from panelloom.schema import PUBLICATION_DELAY_DAYS


def next_month_begin(col):
    """The first day of the following month; a first of month moves a whole month."""
    return F.trunc(F.add_months(col, 1), "MM")


def fixed_delay_date(col, days=PUBLICATION_DELAY_DAYS):
    return F.date_add(F.to_date(col), days)


def publish_date(publish, report):
    """Publication date, or the report date where none is known."""
    return F.to_date(F.coalesce(publish, report))


def utc_midnight(col, zone=None):
    """UTC calendar day of an instant, or of a wall-clock time in ``zone``."""
    return F.to_date(F.to_utc_timestamp(col, F.current_timezone() if zone is None else F.lit(zone)))


def as_date(text):
    return F.to_date(F.lit(text)) if isinstance(text, str) else F.lit(text)


def years_since(col, as_of):
    """Whole years (half to even) from a text date to ``as_of``; unreadable or missing gives 0."""
    days = F.datediff(as_date(as_of), F.try_to_timestamp(col).cast("date"))
    return F.coalesce(F.bround(days / 365.25, 0), F.lit(0.0))
