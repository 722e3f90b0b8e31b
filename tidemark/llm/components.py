"""Connected components by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from tidemark.llm.shared import keep


def _minima(df: DataFrame) -> DataFrame:
    return df.groupBy("u").agg(F.min("v").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(u, v)``, root being the smallest node it is connected with.

    Nodes are longs. Links may repeat, come in either direction or be loops; nulls are ignored, a node without
    another gets no row, and no links give no rows. Every round is two aggregations and two joins over the
    links, written to the shared folder; rounds grow with the logarithm of the longest chain. The sums per
    node combine map-side, and the joins with a hot node are split by adaptive execution.
    """
    edges = links.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, last = keep(edges, "links"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = _minima(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        lowest = _minima(large)
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()
        seen = Observation()
        edges = keep(small.observe(
            seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("xor")), "stars")
        now = tuple(seen.get[k] for k in ("n", "xor"))
        if now == last or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        last = now
