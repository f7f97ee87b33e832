"""Connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dugoutline.session import checkpointed


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the least node that each node of the edges is connected with.

    Large-star and small-star steps until nothing changes, each step written to the shared checkpoint folder.
    """
    now = checkpointed(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        now = checkpointed(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        after = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == mark:
            break
        mark = after
    own = now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")))
    return own.groupBy("node").agg(F.min("component").alias("component"))
