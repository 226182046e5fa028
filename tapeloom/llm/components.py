"""Connected components by randomised contraction, entirely in tables.

Each round draws a new random order of the nodes, lets every node join the
least node of its closed neighbourhood and contracts the edges accordingly.
A round removes a constant share of the nodes on average, whatever the shape
(a chain does not need as many rounds as it has nodes). Minima are combined
map-side, so a node with very many links is one row per task; the driver only
sees one count per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.plans.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(src, dst)``; component is its least node.

    Edges may repeat, point either way and link a node to itself; nulls are no
    nodes. Both columns hold longs.
    """
    links = edges.where("src is not null and dst is not null").select(
        F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")
    )
    links = stage(links.distinct())
    both = links.select(F.col("src").alias("node")).union(links.select("dst"))
    member = both.distinct().select("node", F.col("node").alias("at"))
    links = links.where("src <> dst")
    round_number = 0
    while not links.isEmpty():
        round_number += 1
        order = lambda c: F.struct(F.xxhash64(c, F.lit(round_number)).alias("rank"), c.alias("id"))
        around = links.select("src", "dst").union(links.select(F.col("dst"), F.col("src")))
        lowest = around.groupBy("src").agg(F.min(order(F.col("dst"))).alias("other"))
        chosen = stage(
            lowest.select(
                F.col("src").alias("at"), F.least("other", order(F.col("src"))).getField("id").alias("next")
            )
        )
        member = stage(
            member.join(chosen, "at", "left").select("node", F.coalesce("next", "at").alias("at"))
        )
        step = lambda side: chosen.select(F.col("at").alias(side), F.col("next").alias(f"{side}_next"))
        moved = links.join(step("src"), "src").join(step("dst"), "dst")
        moved = moved.where("src_next <> dst_next").select(
            F.least("src_next", "dst_next").alias("src"), F.greatest("src_next", "dst_next").alias("dst")
        )
        links = stage(moved.distinct())
    least = member.groupBy("at").agg(F.min("node").alias("component"))
    return member.join(least, "at").select("node", "component")
