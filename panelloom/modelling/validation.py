"""Time-ordered validation over prepared folds.

Folds follow row order within (date, entity). The two sides of each fold are scaled by themselves and
the codes learnt from its own training rows, so nothing of a test block is known before. Scores are
computed once for all folds, the folds written; every parameter set that is tried reads the same tables.
"""

from collections import namedtuple
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from panelloom.modelling.forest import LABEL, encoder, fit_forest, predictors, scale_features
from panelloom.operators.aggregates import precision
from panelloom.operators.cross_section import cross_section_zscore
from panelloom.operators.ranking import expanding_folds
from panelloom.schema import KEY, TIME
from panelloom.session import lookup_join, stage

#: a prepared fold: its number, the encoded rows before it and its own
Fold = namedtuple("Fold", "number history tested")


def _scaled_once(placed, numeric, time=TIME):
    """The rows of ``placed`` scaled for every fold in one pass, and the filters of a fold's two sides.

    A month inside one block has the same scores on either side of any fold. A month that a border cuts, one per
    border at most, is scaled once up to each of its blocks and once for each block by itself: ``__last``
    is the last block that counts, or minus the only one.
    """
    cut = placed.groupBy(time).agg(F.min("fold").alias("__lo"), F.max("fold").alias("__hi")).filter("__lo < __hi")
    known = lookup_join(placed, cut, [time]).withColumns({c: F.coalesce(c, "fold") for c in ("__lo", "__hi")})
    rows = known.withColumn("__last", F.explode(F.expr(
        "concat(sequence(fold, __hi), if(fold > __lo, array(-fold), CAST(array() AS array<int>)))")))
    scaled = stage(scale_features(rows, numeric, (time, "Sector", "__last")))

    def sides(number):
        before = (F.col("fold") < number) & (F.col("__last") == F.least(F.lit(number - 1), "__hi"))
        own = (F.col("fold") == number) & (F.col("__last") == F.when(F.col("fold") > F.col("__lo"), -F.col("fold")).otherwise(F.col("fold")))
        return scaled.filter(before), scaled.filter(own)

    return sides


def _scaled_sides(placed, numeric, time=TIME):
    """A function from a fold's number to its two sides, each scaled by itself.

    A month inside one block has the same scores on either side of any fold, so all those are scaled together,
    once. Months that a border cuts, one per border at most, are scaled on each side by what lies there.
    """
    group = (time, "Sector")
    cut = placed.groupBy(time).agg(F.min("fold").alias("__lo"), F.max("fold").alias("__hi")).filter("__lo < __hi")
    known = lookup_join(placed, cut, [time])
    whole = stage(cross_section_zscore(known.filter("__lo IS NULL").drop("__lo", "__hi"), numeric, group))
    parted = stage(known.filter("__lo IS NOT NULL").drop("__lo", "__hi"))

    def sides(number):
        return [whole.filter(side).unionByName(scale_features(parted.filter(side), numeric, group))
                for side in (F.col("fold") < number, F.col("fold") == number)]

    return sides


def fold_store(panel, folds=5, label=LABEL, order=(TIME, KEY), parallelism=1):
    """The folds of ``panel``, scaled, encoded and staged; as many tables as twice the folds."""
    numeric, categorical = predictors(panel)
    placed = stage(expanding_folds(panel.select(*order, label, *numeric, *categorical), folds, order))
    sides = _scaled_sides(placed, numeric)

    def prepared(number):
        before, own = sides(number)
        codes = encoder(numeric, categorical).fit(before)
        wanted = [*order, label, "features"]
        return Fold(number, *(stage(codes.transform(side).select(*wanted)) for side in (before, own)))

    return _together(panel.sparkSession, prepared, range(1, folds + 1), parallelism)


def _together(spark, work, items, parallelism):
    """``work`` of each item, several submitted at once; the fits run as Spark jobs."""
    with ThreadPool(parallelism) as pool:
        return pool.map(inheritable_thread_target(spark)(work), list(items), chunksize=1)


def fold_precision(fold, label=LABEL, **params):
    """Precision on a fold of a forest fitted to the rows before it; 0 without a positive prediction."""
    tested = fit_forest(fold.history, label, **params).transform(fold.tested)
    return precision(tested, label, "prediction").first()["precision"] or 0.0


def time_series_cv(panel, folds=5, label=LABEL, order=(TIME, KEY), parallelism=1, **params):
    """Precision of each expanding fold as a DataFrame (fold, precision)."""
    store = fold_store(panel, folds, label, order, parallelism)
    rows = _together(panel.sparkSession, lambda f: (f.number, fold_precision(f, label, **params)), store, parallelism)
    return panel.sparkSession.createDataFrame(rows, "fold int, precision double")


def cv_summary(scores):
    return scores.agg(F.avg("precision").alias("mean"), F.stddev_pop("precision").alias("std"))


def grid_search_ts(panel, grid, folds=5, label=LABEL, order=(TIME, KEY), parallelism=1):
    """Mean fold precision of every combination in ``grid`` (name -> values), best first.

    All combinations share the prepared folds and are submitted together.
    """
    spark, names = panel.sparkSession, list(grid)
    store = fold_store(panel, folds, label, order, parallelism)
    points = [dict(zip(names, values)) for values in product(*grid.values())]
    scored = _together(spark, lambda work: (str(work[0]), work[1].number, fold_precision(work[1], label, **work[0])),
                       product(points, store), parallelism)
    return spark.createDataFrame(scored, "params string, fold int, precision double").groupBy("params").agg(
        F.avg("precision").alias("precision")).orderBy(F.desc("precision"), "params")
