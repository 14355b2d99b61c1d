"""Connected components of a link table by rounds of hooking to the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiopanel.llm.common import written


def connected(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b): the smallest id reachable.

    Each round hooks every component to its smallest neighbour, follows the
    hooks once more, and keeps the links that still join two components.
    Chains shorten by a factor each round; links shaped as stars around small
    ids need one. Tables of every round are written, so nothing is recomputed
    when an executor is lost. Empty links give an empty table.
    """
    edges = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .filter("a <> b").distinct(), "edges")
    ids = edges.select(F.col("a").alias("id")).union(edges.select(F.col("b").alias("id"))).distinct()
    labels = ids.select("id", F.col("id").alias("component"))
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = written(both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("to")), "hooks")
        jump = written(hook.join(hook.select(F.col("a").alias("to"), F.col("to").alias("far")), "to")
                       .select(F.col("a").alias("old"), F.col("far").alias("new")), "jumps")
        labels = written(labels.join(jump, F.col("component") == F.col("old"), "left")
                         .select("id", F.coalesce("new", "component").alias("component")), "labels")
        edges = written(
            edges.join(jump.select(F.col("old").alias("a"), F.col("new").alias("na")), "a")
            .join(jump.select(F.col("old").alias("b"), F.col("new").alias("nb")), "b")
            .filter("na <> nb").select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).distinct(),
            "edges")
    return labels
