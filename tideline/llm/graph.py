"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.session import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge, the component being its smallest node.

    Each round links all larger neighbours of a node to its smallest one, then
    its smaller neighbours to the smallest of them, until nothing changes; the
    rounds grow with the logarithm of the longest path.  A node with very many
    edges is only ever grouped to its minimum.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    links = materialize(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(low, F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # Here every row points from a node to a smaller one.
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        small = large.join(least, F.col("u") == F.col("w")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = materialize(small.unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct(), "links")
        now = _state(links)
        if now == state:
            break
        state = now
    roots = links.select(F.col("v").alias("u"), "v").distinct()
    return links.unionByName(roots).select(F.col("u").alias("node"), F.col("v").alias("component"))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
