"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.storage import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(``node``, ``root``) for every node that has an edge to another node.

    The root is the least node of the component. Each round hangs larger neighbours
    on the least one around (large star), then the rest on the least smaller one
    (small star); paths shrink by more than half, so rounds grow with the logarithm
    of the longest path. Nothing is gathered per node but its least neighbour, which
    is reduced on the map side. Each round's edges are stored, which ends lineage.
    """
    least = F.least(a, b).alias("v"), F.greatest(a, b).alias("u")
    stars = materialize(edges.filter(F.col(a) != F.col(b)).select(*least).distinct(), "edges")
    seen = _fingerprint(stars)
    while seen[0]:
        stars = materialize(_small_star(_large_star(stars)), "edges")
        now = _fingerprint(stars)
        if now == seen:
            break
        seen = now
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are joined to the least node around it."""
    around = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = around.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))
    return around.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, are joined to the least of them; ``u`` > ``v``."""
    edges = edges.distinct()
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v"))).distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    each = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(each), F.sum(each.cast("decimal(20,0)"))).first())
