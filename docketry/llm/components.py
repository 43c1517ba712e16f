"""Connected components of a table of links, by alternating star contractions.

Every round writes its links to the shared folder, so that a lost executor costs a re-read and
the plan stays short. A node with very many links is an aggregate and an equi-join, which Spark
combines before the shuffle and splits after it; no node's links are gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.session import stage


def _contract(links: DataFrame, larger: bool) -> DataFrame:
    """One star contraction: the neighbours of a node are tied to the least of them instead.

    With `larger`, every node hands its least neighbour to those neighbours that are larger than
    itself; else to its smaller neighbours and itself.
    """
    if larger:
        links = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    tied = links.join(least, "u")
    if larger:
        tied = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        tied = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
    return tied.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """`node, component` for every node of `links` (columns u, v); the component is its least node.

    Links may come in either direction, repeatedly, or from a node to itself (ignored); null ends
    are ignored. No links give an empty table.
    """
    now = stage(
        links.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        name,
    )
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if mark == (seen[0], seen[1]):
            break
        mark = (seen[0], seen[1])
        if not seen[0]:
            break
        now = stage(_contract(_contract(now, True), False), name)
    ends = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
