"""Connected components of an edge table by alternating stars, with no edges on the driver.

Each round hangs a node's larger neighbours (large star), then its neighbours
and itself (small star), on the least node known; rounds are written to the
shared folder. A hot centre's edges are folded by map-side minima, and the joins
that carry its label can be split by the engine where skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_path, remove, settle


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (a, b): for each node its neighbours are linked to the least of them and itself."""
    if large:
        seen = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = seen.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        out = seen.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        out = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return out.where("a <> b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component is its least node."""
    spark = edges.sparkSession
    now = edges.where("a <> b").select("a", "b").distinct()
    last_path, last_state = None, None
    for _ in range(max_rounds):
        path = fresh_path(spark, "star")
        _star(_star(now, True), False).write.parquet(path)
        now = spark.read.parquet(path)
        state = now.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if last_path:
            remove(spark, last_path)
        if state == last_state:
            break
        last_path, last_state = path, state
    else:
        raise RuntimeError(f"components were not stable after {max_rounds} rounds")
    settle(spark)
    own = now.groupBy("a").agg(F.min("b").alias("component"))
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return own.select(F.col("a").alias("node"), "component").unionByName(roots)
