"""Connected components by repeated contraction, as joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroperf.llm.storage import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) -> (node, component): the smallest node reachable, for every node of an edge.

    Each round hooks every node to its smallest neighbour, shortens the paths,
    and replaces the edges by those between different roots; a round at least
    halves the nodes that still have edges. Tables are written between rounds,
    so both sides of every join are plain scans and a hot node (a star's
    centre) is split by adaptive execution. Null ends, loops and repeated edges
    count for nothing; no edges give an empty table.
    """
    a, b = F.col("a"), F.col("b")
    now = stored(edges.where(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "edges")
    levels = []
    while not now.isEmpty():
        both = now.select(a.alias("node"), b.alias("near")).union(now.select(b, a))
        up = both.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("root"))
        up = stored(up, "hooks")
        for _ in range(2):  # paths of up to 4 hooks end at their root; longer ones take another round
            above = up.select(F.col("node").alias("root"), F.col("root").alias("above"))
            longer = stored(up.join(above, "root", "left").select("node", F.coalesce("above", "root").alias("root")), "hooks")
            discard(up)
            up = longer
        levels.append(up)
        left = now.join(up.select(a_of("a"), F.col("root").alias("ra")), "a")
        left = left.join(up.select(a_of("b"), F.col("root").alias("rb")), "b").where("ra <> rb")
        after = stored(left.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
        discard(now)
        now = after
    if not levels:
        return now.select(a.alias("node"), b.alias("component"))
    out = levels[0]
    for up in levels[1:]:
        above = up.select(F.col("node").alias("root"), F.col("root").alias("above"))
        out = out.join(above, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
    return stored(out.select("node", F.col("root").alias("component")), "components")


def a_of(name: str):
    return F.col("node").alias(name)
