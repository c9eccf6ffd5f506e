"""Connected components by alternating stars, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.session import shared_dir


def connected_components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """(node, root): every node that has an edge, root being the least node of its component.

    Each round replaces edges by shorter ones to smaller nodes (large and small
    star, Kiveris et al. 2014); nothing but a count and a sum reaches the driver.
    Rounds are written to the shared folder, which ends their lineage.
    """
    spark = edges.sparkSession

    def kept(df: DataFrame) -> DataFrame:
        folder = shared_dir(spark, "stars")
        df.write.parquet(folder)
        return spark.read.parquet(folder)

    a, b = F.col("a"), F.col("b")
    now = kept(edges.select(F.greatest(u, v).alias("a"), F.least(u, v).alias("b")).filter(a != b).distinct())
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = now.unionByName(now.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = kept(both.join(least, "a").filter(b > a).select(b.alias("a"), F.col("m").alias("b")).filter(a != b).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(least, "a").select(F.explode(F.array(F.struct(b.alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        now = kept(linked.select("e.*").filter(a != b).distinct())
    return now.select(a.alias("node"), b.alias("root")).unionByName(now.select(b.alias("node"), b.alias("root")).distinct())
