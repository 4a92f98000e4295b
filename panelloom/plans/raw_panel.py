"""Landed prices and statements to the raw monthly panel."""

from panelloom.functions.dates import fixed_delay_date, next_month_begin
from panelloom.functions.text import clean_symbol, remap_symbol
from panelloom.operators import joins as J
from panelloom.operators.aggregates import stale_tickers, universe_top_n
from panelloom.operators.filters import drop_rows_all_null, drop_rows_any_null, filter_universe
from panelloom.operators.reshape import strip_column_spaces, transpose_statement
from panelloom.operators.windows import ffill_limit, keep_last, ttm_flows
from panelloom.schema import (
    BALANCE, CASH_FLOW, FLOWS, INCOME, KEY, PROVIDER_A, SOURCE, STATEMENT_ALIASES, TIME, financial_columns,
)
from panelloom.session import stage
from panelloom.sources.readers import add_source_tag, standardise_columns
from pyspark.sql import functions as F


PERIOD_END = "PeriodEnd"


def provider_a_statements(income, balance, cash_flow, events, end="PeriodEnd", at="Published"):
    """Provider A's line items (entity, period end, Item, Value) to dated statement rows.

    Each period takes the month after its publication: the first event in reach, else the
    fixed delay; without ``events`` (None) all dates are approximate, by the fixed delay.
    ``balance`` and ``cash_flow`` may be None. Two period ends can fall on one month: the period
    end stays in the result, for the merge to keep the later one.
    """
    keys = [KEY, end]

    def wide(items, names):
        return None if items is None else transpose_statement(items, names, keys, aliases=STATEMENT_ALIASES)

    rows = J.left_join_statements(
        wide(income, INCOME), wide(balance, BALANCE), wide(cash_flow, CASH_FLOW), keys, BALANCE, CASH_FLOW)
    names = [c for c in rows.columns if c not in keys]
    dated = (rows.withColumn("PublicationDate", fixed_delay_date(end)) if events is None
             else J.asof_forward(rows, events, KEY, end, at, names))
    return add_source_tag(
        dated.select(KEY, next_month_begin("PublicationDate").alias(TIME), F.col(end).alias(PERIOD_END), *names), PROVIDER_A)


def final_clean(df, limit=6):
    """Statements carried over up to six months; rows need an opening price and one key metric."""
    carried = [c for c in financial_columns() + [SOURCE] if c in df.columns]
    filled = ffill_limit(df, carried, limit)
    return drop_rows_all_null(drop_rows_any_null(filled, ["Open"]), ["TotalAssets", "NetIncome_TTM"])


def build_raw_panel(statements_b, prices, statements_a, info, constituents, as_of, exclusions=None,
                    stored=None, metric="Revenue", min_rows=19, top=550):
    """The raw panel of the ``top`` largest entities, of all that qualify with None.

    ``statements_b`` is provider B as landed, ``statements_a`` provider A as returned by
    ``provider_a_statements``, with their period ends; of several periods of one month the latest
    counts, on either side. ``info`` and ``constituents`` are reduced to one row per entity, the
    first in order of their columns. With ``stored`` only rows and entities that need an update are
    processed; the result is then meant for ``upsert_store``.
    """
    named = statements_b.withColumn(KEY, remap_symbol(clean_symbol(KEY)))
    universe = stage(universe_top_n(named, metric, min_rows, top, exclusions).select(KEY))
    wanted = filter_universe(named, universe)
    second = standardise_columns(wanted, as_of, extra=["Report Date"])
    second = second.withColumnRenamed("Report Date", PERIOD_END)
    requested = universe
    if stored is not None:
        second = J.new_rows_anti(second, stored)
        requested = stale_tickers(universe, stored, as_of)
    price_rows = filter_universe(prices, requested)
    first = filter_universe(statements_a, price_rows.select(KEY).distinct())

    merged = strip_column_spaces(J.coalesce_merge(first, second, order=[PERIOD_END]).drop(PERIOD_END))
    quarters = ttm_flows(drop_rows_all_null(merged), [c for c in FLOWS if c in merged.columns])
    panel = J.join_prices_financials(price_rows, quarters)
    return final_clean(J.join_dimensions(panel, _one_row(info), _one_row(constituents)))


def _one_row(table):
    """One row per entity of a table of attributes; two spellings may clean to one symbol."""
    rest = [F.col(c).asc_nulls_last() for c in table.columns if c != KEY]
    return keep_last(table, [KEY], rest)
