"""Connected components of a link table, by alternating large-star and small-star steps.

Nodes and links stay in Spark: each step is a group-by for the smallest
neighbour (combined before the shuffle) and a join with it. Links are written
to the shared folder after each round and reread, so lineage stays short, a
lost executor costs one round, and both sides of a join are plain shuffles
that Spark can split where one node has very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listinglab.llm.common import drop, save


def _large_star(links: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Each node ties its larger neighbours to the smallest node it knows; the table of smallest nodes."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = save(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), name)
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), least


def _small_star(links: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Each node ties its smaller neighbours and itself to the smallest of them. ``u`` is the larger end."""
    least = save(links.groupBy("u").agg(F.min("v").alias("m")), name)
    tied = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), least


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """From links (u, v), rows (u, v): each linked node with the smallest node of its component, itself left out."""
    ends = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = save(ends.where("u <> v").distinct(), name)
    state = None
    while True:
        if (found := now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()) == state:
            return now
        state = found
        for star in (_large_star, _small_star):
            step, least = star(now, name)
            after = save(step, name)
            drop(least)
            drop(now)
            now = after
