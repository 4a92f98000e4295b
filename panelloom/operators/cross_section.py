"""Operators across the entities of one month.

A month (or a month and sector) may hold any number of rows, so its figures come from
aggregates with map-side combining and are joined back, never from a window over the group.
"""

from pyspark.sql import functions as F

from panelloom.operators.quantiles import ACCURACY, group_quantiles
from panelloom.schema import TIME
from panelloom.session import lookup_join


def cross_section_quantile(df, col, k=5, time=TIME, accuracy=ACCURACY):
    """``<col>_Quantile``: 1..k per date by right-closed bins between linear quantiles.

    Repeated edges are merged, which lowers the labels above them; dates with fewer than
    ``k`` values get null. The source column is dropped. ``df`` is read more than once.
    """
    probs = [i / k for i in range(k + 1)]
    edges = group_quantiles(df, [col], probs, [time], accuracy)
    edges = edges.select(time, F.array_distinct(col).alias("__edges"), F.col(f"{col}__n").alias("__n"))
    joined = lookup_join(df, edges, [time])
    value, e = F.col(col), F.col("__edges")
    return joined.select(
        *[c for c in df.columns if c != col],
        F.when((F.col("__n") >= k) & value.isNotNull() & (F.size(e) > 1),
               F.greatest(F.lit(1), _edges_below(e, value, k))).alias(f"{col}_Quantile"),
    )


def _edges_below(edges, value, k):
    """How many edges lie below the value; absent (merged) edges count as not below."""
    flags = [F.coalesce((F.get(edges, F.lit(i)) < value).cast("int"), F.lit(0)) for i in range(k + 1)]
    return sum(flags[1:], flags[0])


def group_statistics(df, group, features):
    return df.dropna(subset=list(group)).groupBy(*group).agg(
        *[F.avg(c).alias(f"__mean_{c}") for c in features],
        *[F.stddev_samp(c).alias(f"__std_{c}") for c in features],
        *[F.count(c).alias(f"__n_{c}") for c in features],
    )


def cross_section_zscore(df, features, group=(TIME, "Sector"), min_samples=5):
    """(x - mean) / std within the group; 0 for small or constant groups, nulls and null keys."""
    joined = lookup_join(df, group_statistics(df, group, features), group)

    def score(c):
        mean, std, n = F.col(f"__mean_{c}"), F.col(f"__std_{c}"), F.col(f"__n_{c}")
        z = F.try_divide(F.col(c) - mean, std)
        return F.coalesce(F.when(n >= min_samples, z), F.lit(0.0)).alias(c)

    return joined.select([score(c) if c in features else F.col(c) for c in df.columns])
