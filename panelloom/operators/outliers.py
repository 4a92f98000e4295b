"""Outliers of whole columns: share, soft compression, removal.

Fitting yields a few numbers per column, which are collected; applying them is a projection.
"""

from pyspark.sql import functions as F

from panelloom.operators.quantiles import ACCURACY, column_quantiles, stack_columns
from panelloom.operators.windows import bias_corrected_skew
from panelloom.session import stage

SKEW_LIMIT, Z_LIMIT, MAD_LIMIT, IQR_FACTOR = 3.0, 3.0, 6.0, 3.0


def fit_outlier_rule(df, cols, accuracy=ACCURACY):
    """``{column: rule}``; ``df`` is read several times, so stage it first.

    A value is far out when it lies more than ``reach`` from ``centre`` (three deviations from
    the mean for mild skew, else six median absolute deviations from the median) and also
    below ``low`` or above ``high`` (three interquartile ranges beyond the quartiles).
    """
    cols = list(cols)
    quartiles, moments = column_quantiles(df, cols, [0.25, 0.5, 0.75], accuracy, also={
        "mean": F.avg("__x"), "std": F.stddev_samp("__x"),
        "skew": bias_corrected_skew(F.count("__x"), F.skewness("__x"), F.var_pop("__x"))})
    known = [c for c in cols if c in moments]
    skewed = [c for c in known if moments[c]["skew"] is None or abs(moments[c]["skew"]) >= SKEW_LIMIT]
    deviations = {}
    if skewed:
        distance = df.select([F.abs(F.col(c) - quartiles[c][1]).alias(c) for c in skewed])
        deviations = column_quantiles(distance, skewed, [0.5], accuracy)
    rules = {}
    for c in known:
        q1, median, q3 = quartiles[c]
        if c in deviations:
            centre, reach = median, MAD_LIMIT * deviations[c][0]
        else:
            std = moments[c]["std"]
            centre, reach = moments[c]["mean"], Z_LIMIT * std if std else float("inf")
        span = IQR_FACTOR * (q3 - q1)
        rules[c] = {"centre": centre, "reach": reach, "low": q1 - span, "high": q3 + span}
    return rules


def outlier_conditions(x, rule):
    """(low, high) conditions on ``x``; the rule's figures may be numbers or columns."""
    far = F.abs(x - rule["centre"]) > rule["reach"]
    return far & (x < rule["low"]), far & (x > rule["high"])


def outlier_figures(df, cols, rules):
    """Per column: values, low and high outliers, and the outliers nearest to the bulk, in one job."""
    cols = [c for c in cols if c in rules]
    at = F.col("__i")
    rule = {name: F.get(F.array(*[F.lit(float(rules[c][name])) for c in cols]), at)
            for name in ("centre", "reach", "low", "high")}
    x = F.col("__x")
    low, high = outlier_conditions(x, rule)
    rows = stack_columns(df, cols).groupBy("__i").agg(
        F.count("__x").alias("n"), F.count_if(low).alias("n_low"), F.count_if(high).alias("n_high"),
        F.max(F.when(low, x)).alias("low"), F.min(F.when(high, x)).alias("high"))
    return {cols[row["__i"]]: row for row in rows.collect()}


def outlier_share(df, cols):
    """Percent of low, high and all outliers per column; the result has one row per column."""
    data = stage(df.select(*cols))
    rules = fit_outlier_rule(data, cols)
    figures = outlier_figures(data, cols, rules)
    rows = []
    for c in cols:
        n, low, high = (figures[c][x] for x in ("n", "n_low", "n_high")) if c in figures else (0, 0, 0)
        rows.append((c, *[x * 100 / n if n else None for x in (low, high, low + high)]))
    return df.sparkSession.createDataFrame(rows, "column string, low double, high double, total double")


def compress(col, low, high):
    """Values beyond a bound keep the logarithm of their distance to it."""
    x = F.col(col)
    out = x
    if high is not None:
        out = F.when(x > high, high + F.log1p(x - high)).otherwise(out)
    if low is not None:
        out = F.when(x < low, low - F.log1p(low - x)).otherwise(out)
    return out


def soft_winsorize(df, cols):
    """Compress the tails of ``cols`` from the outlier nearest to the bulk on."""
    data = stage(df.select(*cols))
    figures = outlier_figures(data, cols, fit_outlier_rule(data, cols))
    bounds = {c: (row["low"], row["high"]) for c, row in figures.items()}
    return df.withColumns({c: compress(c, *b) for c, b in bounds.items() if b != (None, None)})


def outliers_to_null(df, cols):
    data = stage(df.select(*cols))
    rules = fit_outlier_rule(data, cols)
    changes = {}
    for c in rules:
        low, high = outlier_conditions(F.col(c), rules[c])
        changes[c] = F.when(~(low | high), F.col(c))
    return df.withColumns(changes)
