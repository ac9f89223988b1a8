"""Connected components of a graph whose links are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node``, ``label``: every end of a link ``a``, ``b``, with the smallest node that it reaches.

    Rounds of large and small stars (each node links its larger, then its smaller neighbours to the smallest one it
    sees) until nothing changes; their number grows with the logarithm of the longest path. Each round is written to
    the shared folder. Minima are taken before the shuffle, and the joins are plain ones that the adaptive
    execution splits where a node has very many neighbours.
    """
    ends = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, state = stored(ends, "links"), None
    while True:
        # large star
        both = edges.union(edges.select("v", "u").toDF("u", "v"))
        low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m")).withColumnRenamed("u", "c")
        large = both.where("v > u").join(low, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct(), "large-stars")
        # small star
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "c")
        small = large.join(low, F.col("u") == F.col("c"))
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("c", "m"))
        edges = stored(small.where("u <> v").distinct(), "small-stars")
        new = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    stars = edges.groupBy("u").agg(F.min("v").alias("label")).withColumnRenamed("u", "node")
    return stars.union(edges.select("v", "v").distinct().toDF("node", "label"))
