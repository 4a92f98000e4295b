"""Aggregations and reports."""

from functools import reduce

from pyspark.sql import functions as F

from panelloom.functions.dates import as_date
from panelloom.functions.text import clean_symbol, remap_symbol
from panelloom.operators.filters import exclude_listed
from panelloom.operators.joins import first_event_after
from panelloom.operators.quantiles import stacked_quantiles
from panelloom.operators.windows import bias_corrected_skew, keep_last
from panelloom.schema import KEY, TIME


def min_history_filter(df, rows=19, key=KEY):
    enough = df.groupBy(key).count().filter(F.col("count") >= rows)
    return df.join(enough, key, "left_semi")


def universe_top_n(df, metric="Revenue", rows=19, n=550, exclusions=None, key=KEY):
    """The n entities (all with None) with the highest mean metric among those with enough history.

    Counts and sums are one partial aggregate; the history test is a filter on its result.
    """
    named = df.select(remap_symbol(clean_symbol(key)).alias(key), metric)
    if exclusions is not None:
        named = exclude_listed(named, exclusions.select(clean_symbol(key).alias(key)), key)
    known = named.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.avg(metric).alias("__mean")).filter(
        (F.col("__n") >= rows) & F.col(key).isNotNull())
    if n is not None:
        known = known.orderBy(F.desc_nulls_last("__mean"), key).limit(n)
    return known.select(key, F.col("__mean").alias(f"mean_{metric}"))


def stale_tickers(universe, stored, as_of, key=KEY, time=TIME):
    """Requested entities that are not stored or whose last month is before the current one."""
    last = stored.groupBy(key).agg(F.max(time).alias("__last"))
    month = F.trunc(as_date(as_of), "MM")
    return (universe.select(key).distinct().join(last, key, "left")
            .filter(F.col("__last").isNull() | (F.col("__last") < month)).select(key))


def null_share(df, cols=None):
    """Share of nulls per column, only where positive, highest first."""
    cols = list(cols or df.columns)
    one = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in cols])
    return (one.unpivot([], cols, "column", "share").filter(F.col("share") > 0)
            .orderBy(F.desc("share"), "column"))


def null_share_by_group(df, col, group):
    return df.groupBy(group).agg((F.avg(F.col(col).isNull().cast("int")) * 100).alias("percent_null"))


def value_counts(df, col):
    return df.groupBy(col).count().orderBy(F.desc("count"), col)


def skewness(df, cols):
    """Bias-corrected skewness per numeric column, highest first."""
    one = df.agg(*[
        bias_corrected_skew(F.count(c), F.skewness(c), F.var_pop(c)).alias(c) for c in cols])
    return one.unpivot([], list(cols), "column", "skew").orderBy(F.desc_nulls_last("skew"), "column")


def describe(df, cols):
    """count, mean, std, min, quartiles and max per column, also of columns without values.

    ``df`` is read three times: once for the moments and the sketch, twice for the quartiles.
    """
    cols = list(cols)
    figures = {"mean": F.avg("__x"), "std": F.stddev_samp("__x"), "min": F.min("__x"), "max": F.max("__x")}
    found = stacked_quantiles(df, cols, [0.25, 0.5, 0.75], also=figures)
    names = df.sparkSession.createDataFrame(list(enumerate(cols)), "__i int, column string")
    return names.join(found, "__i", "left").select(
        "column", F.coalesce("__n", F.lit(0)).cast("double").alias("count"), "mean", "std", "min",
        *[F.col("__q")[k].alias(q) for k, q in enumerate(("q25", "q50", "q75"))], "max")


def row_at_extreme(df, col, largest=True, ties=()):
    """The full row at the largest or smallest value: a top-one per task, then one of those."""
    order = F.desc_nulls_last(col) if largest else F.asc_nulls_last(col)
    return df.orderBy(order, *ties).limit(1)


def publication_lag_stats(periods, events, entity, end, at, days):
    """Days from a period end to its matched event; unmatched periods are left out.

    A lag is a whole number of days up to ``days``, so the percentile state is bounded.
    """
    hit = first_event_after(periods, events, entity, end, at, [], days).filter(F.col(at).isNotNull())
    lag = F.floor((F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(F.col(end).cast("timestamp")))
                  / (86400 * 1_000_000))
    return hit.select(lag.alias("lag")).agg(
        F.count("lag").alias("n"), F.avg("lag").alias("mean"), F.percentile("lag", F.lit(0.5)).alias("median"),
        F.min("lag").alias("min"), F.max("lag").alias("max"),
        F.percentile("lag", F.lit(0.75)).alias("p75"), F.percentile("lag", F.lit(0.9)).alias("p90"))


def distinct_count(df, key=KEY):
    return df.agg(F.countDistinct(key).alias("n_distinct"))


def residual_summary(df, key=KEY, predicted="Predicted", observed="Observed"):
    return (
        df.groupBy(key)
        .agg(F.avg(predicted).alias("Predicted"), F.avg(observed).alias("Observed"),
             F.avg(F.col(predicted) - F.col(observed)).alias("Residuals"))
        .withColumn("Cluster", F.when(F.col("Residuals") >= 0, "PositiveBias").otherwise("NegativeBias"))
    )


def bias_cluster_stats(summary):
    return summary.groupBy("Cluster").agg(
        F.count(F.lit(1)).alias("n"), F.avg("Residuals").alias("mean_residual"))


def regression_metrics(df, predicted="Predicted", observed="Observed"):
    """MAE, MSE, RMSE and R2 in one pass; R2 from the population variance of the observed."""
    error = F.col(predicted) - F.col(observed)
    one = df.agg(F.avg(F.abs(error)).alias("MAE"), F.avg(error * error).alias("MSE"),
                 F.var_pop(observed).alias("__var"))
    return one.select("MAE", "MSE", F.sqrt("MSE").alias("RMSE"),
                      (1 - F.try_divide("MSE", "__var")).alias("R2"))


def confusion_matrix(df, actual="actual", predicted="predicted"):
    return df.groupBy(actual, predicted).count()


def precision(df, actual="actual", predicted="predicted", target=1):
    hit = F.count_if((F.col(actual) == target) & (F.col(predicted) == target))
    return df.agg(F.try_divide(hit.cast("double"), F.count_if(F.col(predicted) == target).cast("double"))
                  .alias("precision"))


def latest_class_counts(df, label, key=KEY, time=TIME, ties=()):
    return keep_last(df, [key], [F.desc(time), *ties]).groupBy(label).count()


def top_k(df, order, k):
    return df.orderBy(*order).limit(k)


def chronological_sort(df, key=KEY, time=TIME):
    return df.orderBy(key, time)


def union_by_name(*frames):
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_union(a, b, key=KEY):
    return a.select(key).union(b.select(key)).distinct()


def set_difference(a, b, key=KEY):
    return a.select(key).subtract(b.select(key))


def key_intersection(a, b, keys=(KEY, TIME)):
    return a.select(*keys).intersect(b.select(*keys))
