"""Connected components of a table of links, as Spark jobs over tables on shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import drop_stored, stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a, b``): the smallest node it can reach.

    In each round every node takes its smallest neighbour, or itself, as parent;
    trees are flattened; and links are moved to the roots, where those within a
    tree vanish. At least half of the nodes that still have links vanish with
    them, so rounds are few. Joins are on nodes, never on the members of a
    component, and a node that very many share is split by adaptive execution.
    """
    edges = stored(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(),
        "component-links",
    )
    both = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b"))).distinct()
    labels = stored(both.withColumn("component", F.col("node")), "component-labels")
    while not edges.isEmpty():
        either = edges.union(edges.select("b", "a")).toDF("node", "other")
        parents = stored(
            either.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("parent")),
            "component-parents",
        )
        parents = _flat(parents)
        moved = _moved(_moved(edges, "a", parents), "b", parents)
        moved = moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
        before = edges, labels, parents
        labels = stored(_moved(labels, "component", parents), "component-labels")
        edges = stored(moved, "component-links")
        for old in before:
            drop_stored(old)
    drop_stored(edges)
    return labels


def _moved(rows: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """``rows`` with ``column`` replaced by its parent, where it has one."""
    known = parents.select(F.col("node").alias("known"), F.col("parent").alias("known_parent"))
    return rows.join(known, F.col(column) == F.col("known"), "left").select(
        *[F.coalesce("known_parent", column).alias(column) if c == column else F.col(c) for c in rows.columns]
    )


def _flat(parents: DataFrame) -> DataFrame:
    """Parents replaced by their roots, doubling the distance covered each time."""
    while True:
        above = parents.select(F.col("node").alias("known"), F.col("parent").alias("known_parent"))
        further = F.coalesce("known_parent", "parent")
        jumped = stored(
            parents.join(above, F.col("parent") == F.col("known"), "left").select(
                "node", further.alias("parent"), (further != F.col("parent")).alias("moved")
            ),
            "component-parents",
        )
        drop_stored(parents)
        parents = jumped.select("node", "parent")
        if jumped.filter("moved").isEmpty():
            return parents
