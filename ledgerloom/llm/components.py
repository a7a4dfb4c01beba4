"""Connected components of a link table by alternating star rounds; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b): component is the smallest node that can be reached.

    Large star: each node links its larger neighbours to its smallest one; small star: each node links its smaller
    neighbours and itself to its smallest one. Edges only ever move to smaller nodes, until all is stars. A node
    with very many neighbours is reduced by a minimum (map-side first) and joined back, never gathered.
    """
    edges = cut(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        new = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        new = cut(new)
        # Stars only: no node is on both sides, and each u has one v. Then nothing changes any more.
        total = new.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("u").alias("k")).first()
        chained = new.select("v").join(new.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()
        edges = new
        if total["n"] == total["k"] and not chained:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
