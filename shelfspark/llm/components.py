"""Connected components of an edge table, as alternating star contractions.

Large-star and small-star steps (Kiveris et al., "Connected Components in MapReduce and Beyond") are
aggregates and equi-joins; nothing is collected.  Every round is written to the shared checkpoint folder,
so that a lost executor costs one round at most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest node of its neighbourhood."""
    both = edges.select("src", "dst").union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    low = both.groupBy("src").agg(F.min("dst").alias("low")).select("src", F.least("src", "low").alias("low"))
    return both.join(low, "src").where("dst > src").select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands itself and its smaller neighbours to the smallest of them (``src > dst`` holds on input)."""
    low = edges.groupBy("src").agg(F.min("dst").alias("low"))
    moved = edges.join(low, "src").where("dst > low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return low.select("src", F.col("low").alias("dst")).union(moved).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: ``src``, ``dst`` longs, any direction, repeats and loops allowed (NULL ends are dropped).

    Returns ``node``, ``root``: one row for each node that has an edge to another node, with the smallest node of its
    component.  No edges: no rows.  The number of rounds grows with the logarithm of the size of a component."""
    start = edges.where("src != dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()
    stars, seen = cut_lineage(start, "edges"), None
    while True:
        sign = tuple(stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("src", "dst"))).first())
        if sign == seen or not sign[0]:
            return stars.select(F.col("src").alias("node"), F.col("dst").alias("root")).union(stars.select("dst", "dst").distinct())
        seen, stars = sign, cut_lineage(_small_star(_large_star(stars)), "stars")
