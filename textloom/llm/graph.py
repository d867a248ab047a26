"""Connected components of a distributed link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b); the root is a node of the same component.

    Contraction: each node hooks to its smallest neighbour, hooks are followed
    twice, linked roots are linked again, until no link is left. Smallest
    neighbours are partial aggregates, so a node with a third of all links is
    one row per task; joins carry one row per node. Every round is saved in the
    shared folder.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b")
    edges = saved(both.distinct(), "cc-edges")
    labels = links.select(F.col("a").alias("node")).union(links.select("b")).distinct().withColumn("root", F.col("node"))
    while not edges.isEmpty():
        hook = edges.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.col("u")).alias("p"))
        twice = hook.join(hook.select(F.col("u").alias("p"), F.col("p").alias("pp")), "p", "left")
        hook = saved(twice.select("u", F.coalesce("pp", "p").alias("p")), "cc-hook")
        move = lambda df, c: (df.join(hook.withColumnRenamed("u", c), c, "left")  # noqa: E731, B023
                              .withColumn(c, F.coalesce("p", c)).drop("p"))
        labels = move(labels, "root")
        edges = saved(move(move(edges, "a"), "b").filter("a <> b").distinct(), "cc-edges")
    return labels
