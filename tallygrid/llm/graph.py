"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of `links` (a, b): the smallest node it reaches.

    Alternates large-star and small-star rounds until the edges stop changing: every node
    ends linked to the smallest of its component.  A round groups, joins and drops repeats;
    no neighbourhood is gathered in a task, and each round's table is written to the shared
    folder.  Null nodes and self-links are ignored.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges, before = materialize(edges, name), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        edges = materialize(small, name)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
