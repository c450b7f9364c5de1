"""Connected components of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import cut_narrow


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (a, b), where comp is the
    smallest node reachable.  Each round hangs every node's larger
    neighbours, then its smaller ones, on its smallest neighbour; the links
    end as stars.  Minima are taken map-side first, and the join back is one
    row against a node's links, so AQE splits a hot node."""
    e = cut_narrow(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut_narrow(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        new = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if new == state or not new[0]:
            break
        state = new
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
