"""Connected components of links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import discard, materialise


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of ``edges(a, b)``; component is the smallest id reachable.

    Every node starts with the smallest id among itself and its neighbours. A round takes
    the smallest label of the neighbours, then replaces labels by their own labels, so
    paths halve; rounds go on until no label moves. Each round reads and writes tables in
    the shared folder and deletes those of the round before; joins are between plain
    tables, which adaptive execution splits where a label or a node is hot.
    """
    one = materialise(edges.selectExpr("least(a, b) a", "greatest(a, b) b").filter("a < b").distinct())
    both = one.selectExpr("a id", "b near").unionByName(one.selectExpr("b id", "a near"))
    labels = last = materialise(both.groupBy("id").agg(F.min("near").alias("m")).selectExpr("id", "least(id, m) component"))
    while True:
        near = both.join(labels.selectExpr("id near", "component c"), "near").groupBy("id").agg(F.min("c").alias("c"))
        moved = materialise(near.join(labels, "id").selectExpr("id", "component before", "least(component, c) component"))
        up = moved.selectExpr("id component", "component top")
        after = materialise(moved.join(up, "component").selectExpr("id", "before", "top component"))
        discard(moved, last)
        labels, last = after.select("id", "component"), after
        if after.filter("component <> before").isEmpty():
            discard(one)
            return labels
