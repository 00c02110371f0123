"""Connected components by rounds of contraction, each one a few joins.

Every node hooks to its smallest neighbour, pointers are followed to their
roots, and the edges are rewritten between roots; a round at least halves
the nodes that still have edges. Tables of a round are written to the
shared folder, so a lost executor costs a reread, not the whole history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parapet.llm.shared import write_shared


def _roots(hooks: DataFrame) -> DataFrame:
    """Follow (node, to) until every pointer ends at a node that points to itself."""
    while True:
        further = hooks.select(F.col("node").alias("to"), F.col("to").alias("next"))
        jumped = write_shared(
            hooks.join(further, "to", "left").select("node", F.coalesce("next", "to").alias("to"),
                                                     (F.col("next") != F.col("to")).alias("moved")), "roots")
        if not jumped.filter("moved").take(1):
            return jumped.select("node", "to")
        hooks = jumped.select("node", "to")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node
    reachable. Self-links and repeated links are fine; no edges, no rows."""
    edges = write_shared(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                         .filter("a < b").distinct(), "edges")
    mapping = None
    while edges.take(1):
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("to")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("to")))
        hooks = both.groupBy("node").agg(F.min("to").alias("to")).withColumn("to", F.least("node", "to"))
        roots = _roots(write_shared(hooks, "hooks"))
        if mapping is None:
            mapping = roots
        else:       # nodes of earlier rounds whose root moved on
            moved = roots.select(F.col("node").alias("to"), F.col("to").alias("next"))
            mapping = write_shared(mapping.join(moved, "to", "left")
                                   .select("node", F.coalesce("next", "to").alias("to")), "mapping")
        a = roots.select(F.col("node").alias("a"), F.col("to").alias("ra"))
        b = roots.select(F.col("node").alias("b"), F.col("to").alias("rb"))
        edges = write_shared(
            edges.join(a, "a").join(b, "b").filter("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
    if mapping is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return mapping.select("node", F.col("to").alias("component"))
