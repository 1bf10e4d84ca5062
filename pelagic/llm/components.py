"""Connected components of a large graph by alternating large-star and small-star steps, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_counted, materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b): the component's smallest node. Self-links and repeats do no harm.

    Every round halves the depth at least; each is written to the shared folder. A round's minimum is a grouped
    aggregate, so that a node with very many links is combined where its links lie, and meets them by broadcast.
    """
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u != v").distinct()
    edges = materialize(edges, "components")
    before, rows = None, edges.count()
    while True:
        both = F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")
        both = edges.select(both).select("e.*")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = join_counted(both.where("v > u"), low, "u", "n", 2 * rows).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        ends = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")
        small = join_counted(large, low, "u", "n", rows).select(ends).select("e.*").where("u != v").distinct()
        edges = materialize(small, "components", rows)
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before, rows = now, now[0]
