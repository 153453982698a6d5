"""Connected components of an undirected graph held as a table of links, by alternating star contractions.

Each round writes its links to the shared folder, so a lost executor costs one round at most. A node of very high
degree is summed by partial aggregates and joined under AQE's skew join; nothing is collected per node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.textops import Scratch


def _lowest(links: DataFrame) -> DataFrame:
    """u, v and low: the smallest of u and its neighbours."""
    low = links.groupBy("u").agg(F.min("v").alias("_v")).select("u", F.least("u", "_v").alias("low"))
    return links.join(low, "u")


def _round(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step. links: u > v, distinct."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _lowest(both).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
    low = _lowest(large)
    small = low.where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return small.unionByName(low.select("u", F.col("low").alias("v"))).distinct()


def connected(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """u long, v long (any order, repeats and self links allowed) to node, root: each linked node's smallest reachable node."""
    links = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    step = Scratch(links.sparkSession)
    links, mark = step.keep(links, "links0"), None
    for n in range(most_rounds):
        state = links.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 30)))).first()
        if state[0] == 0 or tuple(state) == mark:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(state)
        links = step.keep(_round(links), f"links{n + 1}")
        step.drop(f"links{n}")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
