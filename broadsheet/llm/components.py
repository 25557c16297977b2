"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import written


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b); one root per component.

    Contraction: each node hooks to its smallest neighbour, hooks are followed
    twice, the edges are renamed and equal ones fall together. A star or a
    dense group is one node after the first round; what is left of the edges
    shrinks from round to round, and chains in logarithmically many. Each round
    is written to the shared folder. Hooks are edges, so renaming keeps what
    is connected connected, whether or not a hook has reached its end.
    """
    edges = written(edges.select("a", "b").where("a <> b").distinct(), f"{name}-edges")
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a")).toDF("node", "other")
        hooks = both.groupBy("node").agg(F.least("node", F.min("other")).alias("up"))
        for _ in range(2):
            above = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
            hooks = hooks.join(above, "up").select("node", F.col("top").alias("up"))
        hooks = written(hooks, f"{name}-hooks")
        if labels is None:
            labels = hooks.toDF("node", "root")
        else:
            moved = labels.join(hooks.toDF("root", "up"), "root", "left")
            labels = moved.select("node", F.coalesce("up", "root").alias("root"))
        labels = written(labels, f"{name}-labels")
        for end in ("a", "b"):
            edges = edges.join(hooks.toDF(end, "up"), end).drop(end).withColumnRenamed("up", end)
        smaller, larger = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        edges = written(
            edges.where("a <> b").select(smaller, larger).distinct(), f"{name}-edges"
        )
    if labels is None:
        return edges.toDF("node", "root")
    return labels
