"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runway.llm.common import few_tasks, stage


def _settled(edges: DataFrame) -> bool:
    """Whether links (a, b), a > b, are stars already: a node has one link down, or is a
    centre, never both. No further step would change them."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("centre")).unionAll(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("centre")))
    roles = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("centre").alias("centre"))
    return roles.agg(F.coalesce(F.max((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("centre") > 0))), F.lit(False))).first()[0] is False


def components(links: DataFrame, tasks: int | None = None) -> DataFrame:
    """node, root (the smallest node reachable) for every node in ``links`` (a, b).

    Every step is a minimum by node and a join, so a node with very many links
    is pre-aggregated and its links stay spread. Links to oneself are ignored;
    no links give no rows. Links that are stars need no step at all.
    ``tasks``: files of a stored step, by the number of links if not given.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stage(edges, "links", tasks)
    tasks = tasks or few_tasks(edges)
    while not _settled(edges):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stage(large, "large-star", tasks)
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            down.select("a", F.col("m").alias("b"))).where("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        edges = stage(small, "small-star", tasks)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
