"""Connected components of an edge table, as joins and aggregations."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cut_lineage(df: DataFrame) -> DataFrame:
    """An eager checkpoint in ``spark.checkpoint.dir``; where that is unset, in a temporary folder in local mode, and an error on a cluster."""
    sc = df.sparkSession.sparkContext
    if not sc.getConf().get("spark.checkpoint.dir") and sc._jsc.sc().getCheckpointDir().isEmpty():
        if sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
    return df.checkpoint()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that edges lead to, for every node of an edge.

    Rounds of hooking to the smallest neighbour and of contracting the edges
    to roots; each at least halves the nodes left. Null ends and loops count
    for nothing; an empty table gives an empty one.
    """
    x, y = F.col("x"), F.col("y")
    now = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where(x != y)
    now = cut_lineage(now.select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y")).distinct())
    out = None
    while not now.isEmpty():
        both = now.union(now.select(y, x)).toDF("node", "near")
        hook = both.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("root"))
        up = hook.select(F.col("node").alias("root"), F.col("root").alias("above"))
        hook = cut_lineage(hook.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root")))
        to = lambda c, r: hook.select(F.col("node").alias(c), F.col("root").alias(r))  # noqa: B023, E731
        now = now.join(to("x", "rx"), "x").join(to("y", "ry"), "y").where("rx <> ry").select(F.least("rx", "ry").alias("x"), F.greatest("rx", "ry").alias("y")).distinct()
        now = cut_lineage(now)
        if out is None:
            out = hook
        else:
            above = hook.select(F.col("node").alias("root"), F.col("root").alias("above"))
            out = out.join(above, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
    return now.toDF("node", "component") if out is None else out.withColumnRenamed("root", "component")
