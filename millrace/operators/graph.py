"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut


def connected_components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(id, component)`` with the smallest id of each component.

    ``nodes`` is ``(id)``, ``edges`` ``(src, dst)``. A round sends every node a constant
    number of rows per edge, and long chains shorten by half each time.
    """
    links = cut(edges.where("src <> dst").select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())
    before = None
    for _ in range(max_rounds):
        links = cut(_star(_star(links, large=True), large=False))
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    found = links.groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("component"))
    return nodes.select("id").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links`` runs from larger to smaller id. Large star: link the larger neighbours of a
    node to the node's smallest neighbour; small star: link the smaller ones."""
    if large:
        turned = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
        around = links.unionByName(turned)
    else:
        around = links
    lowest = around.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low"))
    joined = around.join(lowest, "src")
    if large:
        out = joined.where("dst > src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    else:
        to_low = joined.select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        out = to_low.unionByName(lowest.select("src", F.col("low").alias("dst")))
    return out.where("src <> dst").distinct()
