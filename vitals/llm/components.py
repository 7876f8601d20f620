"""Connected components of a graph held as a table of links, by alternating star contractions.

Every round rewrites the links so that they point to ever smaller ids. A *large star* links all
larger neighbours of a node to the smallest id it knows, a *small star* the smaller neighbours and
the node itself. The number of rounds grows with the logarithm of the longest chain. Both are
a two-phase minimum and one join, so a node with many neighbours is pre-aggregated and its join
partition can be split. Each round is written in the shared checkpoint folder; only two numbers per
round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    inner = down.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return inner.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(``u``, ``v``) for each linked node ``u`` but the smallest of its component, which is ``v``.

    ``links`` has the columns ``u`` and ``v``, in any direction; loops are ignored.
    """
    links = links.filter("u <> v").select("u", "v").distinct().checkpoint()
    state = None
    for _ in range(most_rounds):
        links = small_star(large_star(links)).checkpoint()
        now = links.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == state or not now[0]:
            return links
        state = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
