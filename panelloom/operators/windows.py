"""Per-entity window operators.

A panel holds one row per (entity, month), so an entity's window is bounded by the calendar
and one exchange by entity serves every operator of this module in a chain.
"""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelloom.schema import AVERAGED_FLOWS, GROWTH_LIMIT, KEY, TIME
from panelloom.session import lookup_join


def entity_window(key=KEY, time=TIME):
    return Window.partitionBy(key).orderBy(time)


def trailing(rows, key=KEY, time=TIME):
    return entity_window(key, time).rowsBetween(-(rows - 1), 0)


def require_panel(df, key=KEY, time=TIME):
    """Raise unless ``df`` has one row per entity and month.

    That is what bounds the windows below: no entity can hold more rows than the calendar has
    months, however many rows there are in all.
    """
    months = df.select(key, F.trunc(time, "MM").alias(time))
    if not months.groupBy(key, time).count().filter("count > 1").isEmpty():
        raise ValueError(f"more than one row per {key} and month; reduce them with keep_last first")
    return df


def ffill_limit(df, cols, limit, key=KEY, time=TIME):
    """Carry the last known value over at most ``limit`` rows."""
    frame = entity_window(key, time).rowsBetween(-limit, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(frame) for c in cols})


def ttm_flows(df, cols, averaged=AVERAGED_FLOWS, fill=2, key=KEY, time=TIME):
    """Quarterly flows to trailing-twelve-month values: bounded fill, then four-row mean times four.

    Columns in ``averaged`` keep the mean. Originals are replaced by ``<name>_TTM``.
    """
    filled = ffill_limit(df, cols, fill, key, time)
    w4 = trailing(4, key, time)
    mean = {c: F.avg(c).over(w4) for c in cols}
    return filled.select(
        *[c for c in df.columns if c not in cols],
        *[(mean[c] if c in averaged else mean[c] * 4).alias(f"{c}_TTM") for c in cols],
    )


def bias_corrected_skew(n, skew, variance):
    """Sample skewness from the population form: null below three values, 0 for a constant."""
    factor = F.sqrt(n * (n - 1)) / F.when(n > 2, n - 2)
    return F.when(n < 3, F.lit(None)).when(variance == 0, F.lit(0.0)).otherwise(skew * factor)


def entity_skew(col, key=KEY):
    everything = Window.partitionBy(key)
    return bias_corrected_skew(
        F.count(col).over(everything),
        F.skewness(col).over(everything),
        F.var_pop(col).over(everything),
    )


def rolling_impute(df, cols, threshold=3.0, key=KEY, time=TIME):
    """Null to the mean (or, for strongly skewed entities, the median) of the four-row window.

    The current row is null whenever the fill is used, so only three lags matter: with one or
    two known values mean and median agree, with three the median is the middle one. That
    needs no sorted frame and no percentile state.
    """
    w = entity_window(key, time)
    lags = {f"__{c}_{k}": F.lag(c, k).over(w) for c in cols for k in (1, 2, 3)}
    skews = {f"__{c}_s": entity_skew(c, key) for c in cols}
    wide = df.withColumns({**lags, **skews})

    def fill(c):
        a, b, d = (F.col(f"__{c}_{k}") for k in (1, 2, 3))
        known = reduce(lambda x, y: x + y, [x.isNotNull().cast("int") for x in (a, b, d)])
        total = reduce(lambda x, y: x + y, [F.coalesce(x, F.lit(0.0)) for x in (d, b, a)])
        mean = total / F.when(known > 0, known)
        middle = F.greatest(F.least(a, b), F.least(F.greatest(a, b), d))
        mild = F.abs(F.col(f"__{c}_s")) < threshold
        skewed = F.coalesce(~mild, F.lit(True))
        return F.coalesce(F.col(c), F.when(skewed & (known == 3), middle).otherwise(mean)).alias(c)

    return wide.select([fill(c) if c in cols else F.col(c) for c in df.columns])


def lag_value(df, cols, months=1, key=KEY, time=TIME):
    """``<name>_Lag<n>`` within the entity; the original column is dropped."""
    w = entity_window(key, time)
    return df.select(
        *[c for c in df.columns if c not in cols],
        *[F.lag(c, months).over(w).alias(f"{c}_Lag{months}") for c in cols],
    )


def growth_rates(df, cols, spans=(("YoY", 12), ("QoQ", 3)), limit=GROWTH_LIMIT, key=KEY, time=TIME):
    """Change against the row 12 (YoY) or 3 (QoQ) earlier over its absolute value, within +-limit."""
    w = entity_window(key, time)

    def growth(c, rows):
        now, then = F.col(c), F.lag(c, rows).over(w)
        change = now - then
        bounded = F.greatest(F.lit(-limit), F.least(F.lit(limit), change / F.abs(then)))
        at_zero = F.when(change > 0, limit).when(change < 0, -limit)
        return F.when(then == 0, at_zero).when(change.isNotNull(), bounded)

    return df.withColumns({f"{c}_{s}": growth(c, n) for c in cols for s, n in spans})


def keep_last(df, keys, order):
    """The last row per key by an explicit order.

    Spark turns ``row_number() = 1`` into a group limit that runs before the shuffle, so a hot
    key sends one row per task, not all of its rows.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def market_calendar(panel, index, window=12, min_rows=6, time=TIME):
    """One row per month of the panel or the index, with the index's return statistics.

    ``__pos`` numbers the months. The table has one row per calendar month, which bounds the
    single-partition windows below.
    """
    months = panel.select(time).union(index.select(time)).distinct()
    order = Window.orderBy(time)
    frame = order.rowsBetween(-(window - 1), 0)
    previous = F.lag("__open").over(order)
    return (
        months.join(index.select(time, F.col("Open").alias("__open"), F.col("Close").alias("__close")),
                    time, "left")
        .select(
            time,
            F.row_number().over(order).alias("__pos"),
            F.coalesce(F.try_divide("__open", previous) - 1, F.lit(0.0)).alias("__m"),
            (F.try_divide("__close", "__open") - 1).alias("__m_intra"),
        )
        .select(
            "*",
            F.sum("__m").over(frame).alias("__m_sum"),
            F.count(F.lit(1)).over(frame).alias("__rows"),
            F.var_samp("__m").over(frame).alias("__m_var"),
        )
        .withColumn("__m_var", F.when(F.col("__rows") >= min_rows, F.col("__m_var")))
    )


def returns_and_betas(panel, index, window=12, min_rows=6, key=KEY, time=TIME):
    """MonthlyReturn, ShortTermBeta, Variance, Return_IsMissing and MonthlyExcessReturn.

    Returns run against the previous month of the common calendar; a month without a price
    counts as a zero return. The (month x entity) grid is never built: the moments of the months
    that are there, centred over a range frame of the month number, are merged with those of the
    absent ones, whose number and market returns come from the calendar. No figure is the
    difference of raw sums of squares, so a small spread around a large return keeps its digits.
    """
    months = market_calendar(panel, index, window, min_rows, time)
    joined = lookup_join(panel, months, [time])
    w = Window.partitionBy(key).orderBy("__pos")
    frame = w.rangeBetween(-(window - 1), 0)
    step = F.when(F.col("__pos") - F.lag("__pos").over(w) == 1,
                  F.try_divide("Open", F.lag("Open").over(w)) - 1)
    n, k = F.col("__rows"), F.col("__k")
    enough = n >= min_rows
    return (
        joined
        .withColumn("__raw", step)
        .withColumn("MonthlyReturn", F.coalesce("__raw", F.lit(0.0)))
        .withColumns({
            "__k": F.count("MonthlyReturn").over(frame),
            "__r": F.avg("MonthlyReturn").over(frame),
            "__rr": F.var_pop("MonthlyReturn").over(frame),
            "__rm": F.covar_pop("MonthlyReturn", "__m").over(frame),
            "__mm": F.avg("__m").over(frame),
        })
        .withColumns({
            # absent months are zeros: merging them moves both means
            "__moved": F.col("__r") * F.col("__r") * (n - k) / n,
            "__apart": F.when(k < n, F.col("__r") * (F.col("__mm") - F.col("__m_sum") / n)).otherwise(0.0),
        })
        .select(
            *panel.columns,
            "MonthlyReturn",
            F.when(enough, F.try_divide(k * (F.col("__rm") + F.col("__apart")) / (n - 1), F.col("__m_var"))).alias("ShortTermBeta"),
            F.when(enough, k * (F.col("__rr") + F.col("__moved")) / (n - 1)).alias("Variance"),
            F.col("__raw").isNull().cast("int").alias("Return_IsMissing"),
            (F.try_divide("Close", "Open") - 1 - F.col("__m_intra")).alias("MonthlyExcessReturn"),
        )
    )
