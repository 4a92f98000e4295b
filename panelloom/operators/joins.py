"""Merges of statement sources, prices and dimensions."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelloom.functions.dates import fixed_delay_date
from panelloom.operators.windows import keep_last
from panelloom.schema import (
    BOTH_PROVIDERS, DIMENSION_PATCHES, KEY, PUBLICATION_TOLERANCE_DAYS, SOURCE, STATEMENT_METADATA, TIME,
)
from panelloom.session import lookup_join, stage


def outer_join_statements(income, balance, cash_flow, keys, metadata=STATEMENT_METADATA):
    """Full outer join of the three statements; shared metadata is kept from the first only."""
    sides = [income] + [x.drop(*[c for c in metadata if c in x.columns]) for x in (balance, cash_flow)]
    return reduce(lambda a, b: a.join(b, list(keys), "full"), sides)


def left_join_statements(income, balance, cash_flow, keys, balance_cols=(), cash_cols=()):
    """Income left join balance left join cash flow; an absent statement (None) gives null columns."""
    out = income
    for side, cols in ((balance, balance_cols), (cash_flow, cash_cols)):
        if side is None:
            out = out.withColumns({c: F.lit(None).cast("double") for c in cols})
        else:
            out = out.join(side, list(keys), "left")
    return out


def join_prices_financials(prices, financials, key=KEY, time=TIME):
    return prices.join(financials, [key, time], "left")


def join_dimensions(panel, info, constituents, key=KEY):
    """Sector, industry and index membership on the entity; both tables are scans of known size."""
    return panel.join(info.join(constituents, key, "left"), key, "left")


def new_rows_anti(df, stored, key=KEY, time=TIME):
    """Rows whose key is not stored yet; only the key columns of the store are read."""
    return df.join(stored.select(key, time), [key, time], "left_anti")


def coalesce_merge(first, second, keys=(KEY, TIME), tag=SOURCE, both=BOTH_PROVIDERS,
                   order=(), dedupe=True):
    """Full outer merge over the union of columns: the first side's value, else the second's.

    Both sides are reduced to one row per key, which also means no key can be hot in the
    join. ``order`` (column names, ascending, present on both sides) decides which duplicate is
    the last one; with ``dedupe`` it is required. With ``tag``, rows present on both sides carry
    ``both``.
    """
    keys = list(keys)
    if dedupe:
        if not order:
            raise ValueError("which duplicate is the last one? name the columns in order")
        by = [F.desc(c) for c in order]
        first, second = keep_last(first, keys, by), keep_last(second, keys, by)
    a = first.withColumn("__a", F.lit(True)).alias("a")
    b = second.withColumn("__b", F.lit(True)).alias("b")
    joined = a.join(b, keys, "full")
    here, there = F.col("a.__a").isNotNull(), F.col("b.__b").isNotNull()

    def merged(c):
        if c not in first.columns:
            value = F.col(f"b.{c}")
        elif c not in second.columns:
            value = F.col(f"a.{c}")
        else:
            value = F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}"))
        if c == tag:
            value = F.when(here & there, both).otherwise(value)
        return value.alias(c)

    values = [c for c in first.columns if c not in keys]
    values += [c for c in second.columns if c not in keys and c not in first.columns]
    return joined.select(*keys, *[merged(c) for c in values])


def upsert_panel(new, stored, keys=(KEY, TIME)):
    """New rows win, their null cells fall back to the stored value, the rest of both is kept."""
    return coalesce_merge(new, stored, keys, tag=None, dedupe=False)


#: rows of an entity's hour from which on the hour is cut, and the cuts it can get
ROWS_AT_ONCE, MOST_CUTS = 100_000, 1000


def time_buckets(both, entity, at="__t", rows=ROWS_AT_ONCE):
    """``both`` with ``__hour`` and ``__part``: an hour of more than ``rows`` rows is cut by their count.

    The cuts are quantiles of the hour's times from a mergeable sketch, so parts are of about ``rows``
    rows however the times lie in the hour; equal times stay together.
    """
    within = F.minute(at).cast("long") * 60_000_000 + (F.expr(f"extract(SECOND FROM {at})") * 1_000_000).cast("long")
    placed = both.withColumns({"__hour": F.date_trunc("hour", at), "__us": within})
    shares = [k / MOST_CUTS for k in range(1, MOST_CUTS)]
    sizes = placed.groupBy(entity, "__hour").agg(F.count(F.lit(1)).alias("__n"))
    hot = sizes.filter(F.col("__n") > rows)
    cuts = placed.join(hot, [entity, "__hour"]).groupBy(entity, "__hour").agg(
        F.max("__n").alias("__n"), F.approx_percentile("__us", shares, 10 * MOST_CUTS).alias("__all"))
    # every so many of the sketch's quantiles, as the hour has rows
    step = F.greatest(F.floor(F.lit(MOST_CUTS) * rows / F.col("__n")).cast("int"), F.lit(1))
    cuts = cuts.withColumn("__step", step).select(entity, "__hour", F.expr(
        "transform(sequence(0, (size(__all) - 1) div __step), k -> __all[k * __step])").alias("__cuts"))
    joined = lookup_join(placed, cuts, [entity, "__hour"])
    part = F.coalesce(F.size(F.filter("__cuts", lambda c: c < F.col("__us"))), F.lit(0))
    return joined.withColumn("__part", F.when(F.col("__cuts").isNull(), 0).otherwise(part)).drop("__us", "__cuts")


def first_event_after(periods, events, entity, end, at, keep, days=PUBLICATION_TOLERANCE_DAYS, rows=ROWS_AT_ONCE):
    """For each period the first event of its entity with ``end < at <= end + days``, else null.

    The entity's time line is cut into hours, and hours of many rows into parts of about ``rows``. An
    event of the same part is found in a window over (entity, hour, part); later ones need only each
    part's first event, which is pre-aggregated before the shuffle. A hot entity is therefore spread
    over its parts, and no pair of period and event is ever formed. Periods and events are read once
    and staged together.
    """
    left = periods.select(entity, *[F.col(c) for c in keep], F.col(end).alias("__t"), F.lit(1).alias("__p"))
    right = events.select(F.col(entity), *[F.lit(None).cast(periods.schema[c].dataType).alias(c) for c in keep],
                          F.col(at).alias("__t"), F.lit(0).alias("__p")).distinct()
    both = time_buckets(stage(left.union(right)), entity, rows=rows)
    event_time = F.when(F.col("__p") == 0, F.col("__t"))
    where = ["__hour", "__part"]
    # backwards, so that "the next event" is a running value; at equal times the period comes
    # first and does not see the event
    within = Window.partitionBy(entity, *where).orderBy(F.desc("__t"), F.desc("__p"))
    same_part = both.withColumn(
        "__same", F.last(event_time, True).over(within.rowsBetween(Window.unboundedPreceding, -1)))

    parts = both.groupBy(entity, *where).agg(F.min(event_time).alias("__first"))
    after = Window.partitionBy(entity).orderBy(*[F.desc(c) for c in where]).rowsBetween(Window.unboundedPreceding, -1)
    later = parts.select(entity, *where, F.last("__first", True).over(after).alias("__later"))

    found = F.coalesce("__same", "__later")
    in_reach = found <= F.col("__t") + F.make_interval(days=F.lit(days))
    return (
        same_part.filter("__p = 1").join(later, [entity, *where], "left")
        .select(entity, *keep, F.col("__t").alias(end), F.when(in_reach, found).alias(at))
    )


def asof_forward(periods, events, entity, end, at, keep, days=PUBLICATION_TOLERANCE_DAYS, delay=None):
    """Publication date of each period: first event in reach, else the period end plus a fixed delay."""
    hit = first_event_after(periods, events, entity, end, at, keep, days)
    fallback = fixed_delay_date(end) if delay is None else fixed_delay_date(end, delay)
    return hit.withColumn("PublicationDate", F.coalesce(F.to_date(at), fallback))


def refill_dimension(df, lookup, cols=("Sector", "Industry"), key=KEY):
    """Entities with any null in ``cols`` take all of them from ``lookup`` where it knows them."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    affected = df.filter(missing).select(key).distinct()
    fresh = lookup.join(affected, key, "left_semi").select(
        key, *[F.col(c).alias(f"__{c}") for c in cols], F.lit(True).alias("__hit"))
    joined = df.join(fresh, key, "left")
    return joined.select([
        F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
        for c in df.columns
    ])


def patch_by_key(df, patches=DIMENSION_PATCHES, cols=("Sector", "Industry"), key=KEY):
    """Overwrite dimensions of the listed entities; the list's true size decides how it is joined."""
    spark = df.sparkSession
    table = spark.createDataFrame(
        [tuple(p) for p in patches], ", ".join([f"{key} string"] + [f"__{c} string" for c in cols]))
    joined = lookup_join(df, table, [key])
    return joined.select([
        F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns
    ])
