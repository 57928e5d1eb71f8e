"""Connected components of a link table, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.session import reliable_checkpoint


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): for every node of the links (u, v), the smallest node it can reach.

    Alternating star contraction: each node's neighbours are linked to its
    smallest neighbour, first the larger ones, then all smaller ones; the rounds
    grow with the logarithm of a component's size.  Every round is
    checkpointed, so a lost executor repeats one round only.  Self-links and
    null ends are ignored; nodes without a link do not appear.
    """
    e = edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = reliable_checkpoint(e)
    seen = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == seen:
            break
        seen = now
        # large star: the larger neighbours of a node are linked to the smallest of its neighbours and itself
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours are linked to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = reliable_checkpoint(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
