"""Connected components of a link table by alternating star contractions.

Every round is a join and an aggregate over the remaining links; nothing is collected, and a
node with very many links meets map-side combining or adaptive skew splitting, not one task.
"""

from pyspark.sql import functions as F

from panelloom.llm.common import staged


def _finished(edges):
    """Whether the links are stars: every node is tied to one smaller node, which is tied to none."""
    roles = edges.select(F.col("u").alias("n"), F.lit(1).alias("low"), F.lit(0).alias("high")).unionAll(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("low"), F.lit(1).alias("high")))
    odd = roles.groupBy("n").agg(F.sum("low").alias("low"), F.max("high").alias("high"))
    return odd.filter("low > 1 or (low > 0 and high > 0)").isEmpty()


def _large_star(edges):
    """Every larger neighbour of a node is tied to the smallest node around it."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges):
    """A node and its smaller neighbours are tied to the smallest of them; links run downwards."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(links, a="a", b="b"):
    """``node`` and ``component`` (its smallest node) for every node that has a link.

    Self links and nulls say nothing; repeated links count once. The number of rounds grows with
    the logarithm of a component's width.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    edges = staged(edges)
    while not _finished(edges):
        edges = staged(_small_star(_large_star(edges)))
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionAll(roots)
