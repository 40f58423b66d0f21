"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """One row per node of ``edges`` (a, b): node and root, the least node it is connected with.

    Each round gives a node the least root among its neighbours' and its own, hooks the old root to it, and then follows
    the roots one step, so long chains shrink fast. All groupings combine before they shuffle; no group is gathered.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.filter("a <> b").distinct(), "edges")
    roots = materialize(both.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node")), "roots")
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), F.col("root").alias("near")), "b").groupBy("a").agg(
            F.min("near").alias("near"))
        seen = roots.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", "root", F.least("root", "near").alias("least"))
        # the old root learns of the least root that any of its nodes has seen
        hooks = seen.filter("least < root").groupBy("root").agg(F.min("least").alias("hook")).withColumnRenamed("root", "node")
        hooked = materialize(seen.join(hooks, "node", "left").select(
            "node", F.col("root").alias("before"), F.least("least", F.coalesce("hook", "least")).alias("root")), "hooked")
        up = hooked.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = materialize(hooked.join(up, "root").select(
            "node", F.least("root", "above").alias("root"), (F.least("root", "above") < F.col("before")).alias("moved")), "roots")
        roots = jumped.select("node", "root")
        if jumped.filter("moved").isEmpty():
            return roots
