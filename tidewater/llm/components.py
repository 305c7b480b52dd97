"""Connected components by alternating large-star and small-star rounds.

Each round is two grouped minima and two joins over the links; links are staged
in the shared folder after a round, so the lineage stays short and nothing but
a count and a checksum comes to the driver. Hubs only meet in partially
aggregated minima and in joins that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import stage


def _state(links: DataFrame) -> tuple:
    r = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return r[0], r[1]


def _star(links: DataFrame, both_ways: bool) -> DataFrame:
    """Large star (both ways) or small star over links a -> b."""
    if both_ways:
        near = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = near.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    met = near.join(low, "a")
    if both_ways:
        out = met.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("low").alias("b")) \
            .unionByName(low.select("a", F.col("low").alias("b")))
    return out.filter("a <> b").distinct()


def component_roots(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links`` (a, b: numbers) to (node, root): every node but a component's
    smallest, with that smallest node."""
    cur = stage(links.filter("a <> b").select("a", "b"), "links")
    before = _state(cur)
    for _ in range(max_rounds):
        if not before[0]:
            break
        cur = stage(_star(_star(cur, True), False), "links")
        now = _state(cur)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
