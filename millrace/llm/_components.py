"""Connected components of a graph given as a table of links, by contracting neighbourhoods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._shared import written


def components(links: DataFrame) -> DataFrame:
    """node, component (some node of it) for every node with a link. links: a, b (long).

    In each round a node is replaced by the node of least rank within two steps of it, and links that become loops go.
    Ranks are hashes drawn anew for each round, so a round leaves at most a share of the nodes of any graph, chains
    included, and a star goes in one; rounds go on until no link is left. Every step is a grouping with a running minimum
    or a join, so no node's neighbours are gathered in one place. Each round is written; a lost executor costs one round.
    """
    edges = written(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        rank = lambda c, salt=len(rounds): F.xxhash64(F.col(c), F.lit(salt))
        both = edges.select("a", "b").union(edges.select("b", "a")).toDF("u", "v")
        one = both.union(both.select("u", F.col("u").alias("v"))).groupBy("u").agg(F.min_by("v", rank("v")).alias("m"))
        two = both.join(one.toDF("v", "m"), "v").select("u", "m").union(one).groupBy("u").agg(F.min_by("m", rank("m")).alias("to"))
        moved = written(two, "links-moved")
        rounds.append(moved)
        ends = edges.join(moved.toDF("a", "x"), "a").join(moved.toDF("b", "y"), "b")
        edges = written(ends.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    labels = rounds[0] if rounds else edges.select(F.col("a").alias("u"), F.col("b").alias("to"))
    for moved in rounds[1:]:
        labels = labels.join(moved.toDF("to", "next"), "to", "left").select("u", F.coalesce("next", "to").alias("to"))
    return labels.select(F.col("u").alias("node"), F.col("to").alias("component"))
