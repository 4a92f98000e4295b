"""Exact quantiles of groups of any size, by narrowing.

1. one scan: a mergeable sketch per group and column brackets each wanted quantile, next to the
   counts (and whatever other figures the caller asks for). The sketch's error bounds the number
   of values in a bracket;
2. where that bound is above ``leaf``, one scan counts how many values lie in each bracket, and
   their least and largest, and brackets that hold a wanted rank and more than ``leaf`` values are
   cut into ``CUTS`` ranges of the values' order keys and counted again, until every bracket is small
   or a single value. A key is the value's place among all doubles, so a pass leaves a 256th of them
   and eight passes end at single values whatever the values spread over, infinities included;
3. the values inside the brackets are shuffled as (value, count) pairs, those between them as counts,
   and a running count picks the ranks.

The counts make the result exact; a rank outside its bracket would be an error, not another value.
Groups and columns are rows, so many columns cost as many jobs as one, and no task holds more than
``leaf`` distinct values of a bracket.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelloom.session import lookup_join, stage

ACCURACY = 10_000
LEAF = 200_000
CUTS = 256


def stack_columns(df, cols, by=()):
    """Rows (by..., __i, __x): one per non-null value, ``__i`` being the position in ``cols``.

    Statistics of many columns as one aggregate over few expressions: the generated code
    stays small, and map-side combining reduces the extra rows before any shuffle.
    """
    cells = [F.struct(F.lit(i).alias("__i"), F.col(c).cast("double").alias("__x")) for i, c in enumerate(cols)]
    return df.select(*by, F.inline(F.array(*cells))).filter("__x IS NOT NULL")


def order_key(x):
    """The place of a double among all doubles as a long: same order, different for different values.

    Zero is 0, negative values mirror the positive ones, and NaN comes last. The power of two below the value
    is taken from its logarithm and put right where that is rounded; all other steps are exact.
    """
    size = F.abs(x)
    guess = F.floor(F.log2(size)).cast("double")
    ratio = size / F.pow(F.lit(2.0), guess)
    power = guess + F.when(ratio >= 2, 1).when(ratio < 1, -1).otherwise(0)
    whole = float(1 << 52)
    normal = (power + 1023).cast("long") * (1 << 52) + ((size / F.pow(F.lit(2.0), power) - 1) * whole).cast("long")
    small = (size * float(1 << 537) * float(1 << 537)).cast("long")  # whole multiples of the least double
    key = F.when(size < 2.0 ** -1022, small).when(size == float("inf"), F.lit(2047 << 52)).otherwise(normal)
    return F.when(F.isnan(x), F.lit((1 << 63) - 1)).when(x < 0, -key).otherwise(key)


def _cut(key, low, high):
    """Range 0 .. ``CUTS`` - 1 of a key between ``low`` and ``high``; no difference passes 64 bits."""
    half = CUTS // 2
    below = F.expr(f"(__k - __klo) div ((-1 - __klo) div {half} + 1)")
    above = F.expr(f"{half} + __k div (__khi div {half} + 1)")
    plain = F.expr(f"(__k - __klo) div ((__khi - __klo) div {CUTS} + 1)")
    return F.when((low < 0) & (high >= 0), F.when(key < 0, below).otherwise(above)).otherwise(plain).cast("int")


def stacked_quantiles(df, cols, probs, by=(), accuracy=ACCURACY, also=None, leaf=LEAF):
    """Rows (by..., __i, __n, __q, also...): linearly interpolated quantiles per group and column.

    ``also`` maps names to aggregates of ``__x`` for the first scan. Rows with a null group key
    are left out, as are groups without values of a column. ``df`` is read at least twice, so an
    expensive input should be staged by the caller.
    """
    by, cols, probs, also = list(by), list(cols), [float(p) for p in probs], also or {}
    data = df.select(*by, *cols).dropna(subset=by) if by else df.select(*cols)
    long, key = stack_columns(data, cols, by), [*by, "__i"]
    margin = 2.0 / accuracy
    ends = sorted({min(max(x, 0.0), 1.0) for p in probs for x in (p - margin, p + margin)})
    marks = long.groupBy(*key).agg(
        F.approx_percentile("__x", ends, accuracy).alias("__s"), F.count("__x").alias("__n"),
        *[figure.alias(name) for name, figure in also.items()])
    most = leaf * accuracy / 8  # a bracket holds 6 n / accuracy values at most, but for equal ones
    rows = None
    if by:
        marks = stage(marks)
        few = marks.filter(F.col("__n") > most).isEmpty()
    else:  # one row per column: on the driver
        schema, rows = marks.schema, marks.collect()
        few = all(r["__n"] <= most for r in rows)
        if not few:
            marks = stage(df.sparkSession.createDataFrame(rows, schema))
    if few:
        brackets = [tuple(ends.index(min(max(x, 0.0), 1.0)) for x in (p - margin, p + margin)) for p in probs]
        joined = (lookup_join(long, marks.select(*key, "__s", "__n"), key, "inner", ready=True) if by else
                  long.withColumns({"__s": _by_index(schema, rows, "__s"), "__n": _by_index(schema, rows, "__n")}))
        placed = _placed(joined, key, len(ends), brackets, 4 * accuracy)
    else:
        placed = _narrowed(long, marks, key, probs, ends, leaf)

    x = F.col("__x")

    def at(rank):
        return F.max(F.when((F.col("__start") <= rank) & (rank < F.col("__stop")), x))

    picks, values = [], []
    for k, p in enumerate(probs):
        low, high, part = _ranks(F.col("__n"), p)
        picks += [at(low).alias(f"__lo{k}"), at(high).alias(f"__hi{k}")]
        lo, hi = F.col(f"__lo{k}"), F.col(f"__hi{k}")
        # equal neighbours need no difference, which infinities do not have
        value = F.when((part == 0) | (lo == hi), lo).otherwise(lo + (hi - lo) * part)
        values.append(F.when(lo.isNull() | hi.isNull(), F.raise_error(F.lit("a rank outside its bracket")).cast("double")).otherwise(value))
    out = placed.groupBy(*key, "__n").agg(*picks).select(*key, "__n", F.array(*values).alias("__q"))
    if not also:
        return out
    if rows is not None:
        return out.withColumns({name: _by_index(schema, rows, name) for name in also})
    return lookup_join(out, marks.select(*key, *also), key, "inner", ready=True)


def _by_index(schema, rows, name):
    """A figure of the column number ``__i`` from a few rows on the driver."""
    known = {r["__i"]: r[name] for r in rows}
    kind = schema[name].dataType.simpleString()
    cells = [F.lit(known.get(i)).cast(kind) for i in range(max(known, default=0) + 1)]
    return F.get(F.array(*cells), F.col("__i"))


def _placed(joined, key, ends, brackets, whole):
    """Values inside the brackets, and the counts of those between, with the ranks they take.

    Of groups of less than ``whole`` values, whose brackets may be less than a rank wide, all are inside.
    """
    x, s = F.col("__x"), F.col("__s")
    bucket = sum(((x > s[j]).cast("int") for j in range(1, ends)), (x > s[0]).cast("int"))
    inside = F.col("__n") < whole
    for low, high in brackets:
        inside = inside | ((x >= s[low]) & (x <= s[high]))
    # what a bucket holds below the bracket that begins at its end comes first in it, as one null
    cells = joined.select(*key, "__n", bucket.alias("__b"), F.when(inside, x).alias("__x"))
    counted = cells.groupBy(*key, "__n", "__b", "__x").agg(F.count(F.lit(1)).alias("__m"))
    running = Window.partitionBy(*key).orderBy("__b", F.asc_nulls_first("__x")).rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("__stop", F.sum("__m").over(running))
    return placed.withColumn("__start", F.col("__stop") - F.col("__m"))


def _narrowed(long, marks, key, probs, ends, leaf):
    """The same for groups of any size: brackets are counted and cut until they are small."""
    x = F.col("__x")
    bucket = sum(((x > F.col("__s")[j]).cast("int") for j in range(1, len(ends))), (x > F.col("__s")[0]).cast("int"))
    inside = lookup_join(long, marks.select(*key, "__s"), key, "inner", ready=True).select(*key, bucket.alias("__b"), "__x")
    open_ = _holding(_sized(inside, key), marks.select(*key, "__n"), key, probs, before=None)
    while not open_.filter((F.col("__m") > leaf) & (F.col("__lo") < F.col("__hi"))).isEmpty():
        ends_of = open_.withColumns({"__klo": order_key(F.col("__lo")), "__khi": order_key(F.col("__hi"))})
        cells = _within(long, ends_of, key).withColumn("__k", order_key(x)).select(
            *key, "__b", "__at", _cut(F.col("__k"), F.col("__klo"), F.col("__khi")).alias("__c"), "__x")
        narrowed = _sized(cells, [*key, "__b", "__at"], "__c")
        open_ = _holding(narrowed, marks.select(*key, "__n"), key, probs, before="__at")
    counted = _within(long, open_, key).groupBy(*key, "__n", "__at", "__b", "__x").agg(F.count(F.lit(1)).alias("__m"))
    running = Window.partitionBy(*key, "__b", "__at").orderBy("__x").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("__stop", F.col("__at") + F.sum("__m").over(running))
    return placed.withColumn("__start", F.col("__stop") - F.col("__m"))


def _ranks(n, p):
    at = F.round((n - 1) * p, 9)
    return F.floor(at), F.ceil(at), at - F.floor(at)


def _sized(rows, key, part="__b"):
    """Values, least and largest value per part of a group."""
    return rows.groupBy(*key, part).agg(
        F.count(F.lit(1)).alias("__m"), F.min("__x").alias("__lo"), F.max("__x").alias("__hi"))


def _holding(parts, sizes, key, probs, before):
    """The parts that hold a wanted rank: ``__at`` is the rank before each, ``__b`` numbers them."""
    over, order = (key, "__b") if before is None else ([*key, "__b", before], "__c")
    earlier = Window.partitionBy(*over).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("__m").over(earlier), F.lit(0)) + (F.lit(0) if before is None else F.col(before))
    placed = parts.withColumn("__start", start)
    if before is not None:
        placed = placed.drop(before)
    placed = lookup_join(placed.withColumnRenamed("__start", "__at"), sizes, key, "inner", ready=True)
    hit = F.lit(False)
    for p in probs:
        for rank in _ranks(F.col("__n"), p)[:2]:
            hit = hit | ((rank >= F.col("__at")) & (rank < F.col("__at") + F.col("__m")))
    return stage(placed.filter(hit).select(
        *key, F.col("__b" if before is None else "__c").alias("__b"), "__at", "__m", "__n", "__lo", "__hi"))


def _within(long, open_, key):
    """Values next to the open part they lie in; parts of one group and column do not overlap."""
    return lookup_join(long, open_, key, "inner", ready=True).filter(
        (F.col("__x") >= F.col("__lo")) & (F.col("__x") <= F.col("__hi")))


def group_quantiles(df, cols, probs, by=(), accuracy=ACCURACY, leaf=LEAF):
    """One row per group: ``by``; per column an array of quantiles and ``<column>__n``, its count."""
    cols, by = list(cols), list(by)
    long = stacked_quantiles(df, cols, probs, by, accuracy, leaf=leaf)
    if len(cols) == 1:
        return long.select(*by, F.col("__q").alias(cols[0]), F.col("__n").alias(f"{cols[0]}__n"))
    wide = long.groupBy(*by).agg(
        *[F.first(F.when(F.col("__i") == i, F.col("__q")), True).alias(c) for i, c in enumerate(cols)],
        *[F.first(F.when(F.col("__i") == i, F.col("__n")), True).alias(f"{c}__n") for i, c in enumerate(cols)])
    return wide


def column_quantiles(df, cols, probs, accuracy=ACCURACY, also=None, leaf=LEAF):
    """Quantiles of whole columns as a dict ``column -> list``; a few numbers, so on the driver.

    With ``also``, a second dict ``column -> row`` holds the other figures of the first scan.
    """
    cols = list(cols)
    rows = {cols[r["__i"]]: r for r in stacked_quantiles(df, cols, probs, (), accuracy, also, leaf).collect()}
    quantiles = {c: rows[c]["__q"] if c in rows else [None] * len(probs) for c in cols}
    return quantiles if also is None else (quantiles, rows)
