"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import materialize


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node in ``edges`` (u, v: longs); root is the least node it can reach.

    Large stars and small stars alternate until nothing changes, which takes about as many rounds as the
    logarithm of the longest path squared. Each round is written to the shared folder; least neighbours
    are aggregated before they are shuffled. Self-links are dropped; no edges give no rows.
    """
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = state
    raise RuntimeError(f"components did not settle in {rounds} rounds")
