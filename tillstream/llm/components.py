"""Connected components of a graph given by its edges, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import kept


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``v``, ``component``: the smallest vertex reachable, for each vertex of ``edges``.

    ``edges`` has columns ``a`` and ``b``, in any order and with repeats. Every round
    links each vertex's neighbours to the smallest of them (first the larger ones, then
    the smaller ones), which halves long paths; the rounds end when each vertex points
    straight at a root. No vertex's neighbours are ever collected: minima are combined
    before the shuffle and joined back, so a vertex may have any number of edges.
    """
    edges = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")
    )
    edges = kept(edges.distinct(), "edges")
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("m").alias("v"), F.col("v").alias("m")))
        least = both.groupBy("v").agg(F.min("m").alias("least"))
        least = least.select("v", F.least("v", "least").alias("least"))
        larger = (
            both.join(least, "v")
            .filter("m > v")
            .select(F.col("m").alias("v"), F.col("least").alias("m"))
            .unionByName(least.filter("least < v").select("v", F.col("least").alias("m")))
            .distinct()
        )
        root = larger.groupBy("v").agg(F.min("m").alias("least"))
        smaller = (
            larger.join(root, "v")
            .select(F.when(F.col("m") == F.col("least"), F.col("v")).otherwise(F.col("m")).alias("v"),
                    F.col("least").alias("m"))
            .distinct()
        )
        edges = kept(smaller, "edges")
        # Done when every vertex has one edge, to a vertex that has none upwards.
        roles = edges.select("v", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            edges.select(F.col("m").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        )
        roles = roles.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        loose = roles.filter("up > 1 or (up > 0 and down > 0)")
        if loose.isEmpty():
            return edges.select("v", F.col("m").alias("component")).unionByName(
                edges.select(F.col("m").alias("v"), F.col("m").alias("component")).distinct()
            )
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def merged(label: DataFrame | None, links: DataFrame) -> DataFrame:
    """``v``, ``component`` of the graph that ``label`` names the components of, with ``links``.

    Only components are linked anew: what was found before is not gone through again.
    ``label`` is None where nothing is linked yet.
    """
    if label is None:
        return kept(components(links), "labels")

    for x in "ab":
        named = label.select(F.col("v").alias(x), F.col("component").alias("of"))
        links = links.join(named, x, "left").withColumn(x, F.coalesce("of", x)).drop("of")
    joined = kept(components(links), "joined-components")
    old = label.join(joined.select(F.col("v").alias("component"), F.col("component").alias("to")), "component", "left")
    old = old.select("v", F.coalesce("to", "component").alias("component"))
    return kept(old.unionByName(joined.join(label, "v", "left_anti")), "labels")
