"""The whole run in three phases, from landed folders to the dated report.

Landed tables are Parquet folders under one root, as a download leaves them:

    prices, market_index              long (entity, date, attributes) or wide (``attribute|entity`` columns)
    statements_b/<family>/<statement> provider B, per sector family its income, balance and cash_flow
    statements_a/<statement>          provider A, rows of (entity, PeriodEnd, Item, Value)
    events                            publication events (entity, Published); optional
    info, constituents                attributes of the entities

What a run keeps lies under another root: ``raw`` (the versioned store), ``exclusions``, ``clean``
and ``reports``. A phase reads what the one before has written, so each can be run by itself, and
again: extraction asks only for what the store does not hold yet.
"""

from collections import namedtuple

from pyspark.sql import functions as F

from panelloom.functions.dates import utc_midnight
from panelloom.functions.text import clean_symbol, remap_symbol
from panelloom.modelling import forest as O, report as Q
from panelloom.operators.aggregates import stale_tickers, universe_top_n
from panelloom.operators.filters import filter_universe
from panelloom.plans import train as T
from panelloom.plans.features import build_features
from panelloom.plans.raw_panel import build_raw_panel, provider_a_statements
from panelloom.schema import KEY, TIME
from panelloom.session import stage
from panelloom.sources import sinks
from panelloom.sources.readers import drop_columns, load_statements, read_panel, read_prices

STATEMENTS = ("income", "balance", "cash_flow")

Modelled = namedtuple("Modelled", "report path confusion precision importance")


def landed_prices(df, time=TIME, key=KEY, sep="|", zone=None):
    """A landed price table, long or wide, as the long panel of days with a close."""
    if key in df.columns:
        return drop_columns(df.withColumn(time, utc_midnight(F.col(time), zone))).dropna(subset=["Close"])
    parts = [c.split(sep, 1) for c in df.columns if sep in c]
    attributes, entities = (list(dict.fromkeys(p[k] for p in parts)) for k in (0, 1))
    return read_prices(df, attributes, entities, time, zone)


def without_data(universe, prices, statements, key=KEY):
    """Requested entities without a price, and those with prices but without a statement."""
    priced = prices.select(key).distinct()
    reported = statements.select(key).distinct()
    none = universe.select(key).join(priced, key, "left_anti")
    return none.unionAll(universe.select(key).join(priced, key, "left_semi").join(reported, key, "left_anti"))


def extract(spark, landed, root, as_of, families=("general",), metric="Revenue", min_rows=19, top=550):
    """Landed tables merged into the raw store; the store as read back, None if nothing was new.

    Entities without prices or statements go to the exclusions, which the next run leaves out.
    """
    def read(name):
        return read_panel(spark, f"{landed}/{name}")

    second = stage(load_statements([[read(f"statements_b/{family}/{s}") for s in STATEMENTS] for family in families]))
    events = read("events") if sinks.path_exists(spark, f"{landed}/events") else None
    first = stage(provider_a_statements(*[read(f"statements_a/{s}") for s in STATEMENTS], events))
    prices = stage(landed_prices(read("prices")))
    exclusions = sinks.read_exclusions(spark, f"{root}/exclusions")
    stored = sinks.open_store(spark, f"{root}/raw")
    raw = stage(build_raw_panel(second, prices, first, read("info"), read("constituents"), as_of, exclusions, stored,
                                metric, min_rows, top))
    named = second.withColumn(KEY, remap_symbol(clean_symbol(KEY)))
    requested = universe_top_n(named, metric, min_rows, top, exclusions).select(KEY)
    if stored is not None:
        requested = stale_tickers(requested, stored, as_of)
    sinks.save_exclusions(without_data(stage(requested), filter_universe(prices, requested), first), f"{root}/exclusions")
    return sinks.upsert_store(raw, f"{root}/raw")


def transform(spark, landed, root, as_of, **settings):
    """The raw store to the clean panel, written by year and read back."""
    raw = sinks.open_store(spark, f"{root}/raw")
    if raw is None:
        raise ValueError(f"nothing was extracted to {root}/raw")
    index = landed_prices(read_panel(spark, f"{landed}/market_index"))
    sinks.write_panel(build_features(raw, index, as_of, **settings), f"{root}/clean")
    return sinks.read_written(spark, f"{root}/clean")


def model(spark, root, as_of, **params):
    """The clean panel to the forest's ranking of the latest month: report file and figures."""
    panel = stage(sinks.read_written(spark, f"{root}/clean"))
    trained = T.train(panel, **params)
    ranked = O.ranked_predictions(trained.model, trained.live)
    joined, path = Q.report(ranked, panel, f"{root}/reports", as_of)
    confusion, precise = T.history_figures(trained)
    return Modelled(joined, path, confusion, precise, O.feature_importance(spark, trained.model, trained.names))


def run(spark, landed, root, as_of, families=("general",), metric="Revenue", min_rows=19, top=550, **params):
    """All three phases; ``params`` are those of the forest."""
    extract(spark, landed, root, as_of, families, metric, min_rows, top)
    transform(spark, landed, root, as_of)
    return model(spark, root, as_of, **params)
