"""Connected components of a link table by alternating large-star and small-star steps.

Every step is a grouped minimum and a join on the node, so a hub with any number of
neighbours is pre-aggregated and its join is one that Spark can split. Links stay on the
executors; each round is written to the shared checkpoint folder, which cuts the lineage
and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgate.llm.common import materialize

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over undirected links (u, v), u > v, each once."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    hung = both.join(least, "u")
    if large:
        out = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links(u, v)`` to ``(id, component_id)``: the smallest id that each linked node reaches.

    Direction, repeats, self-links and null ends don't matter; nodes without links to
    another node are not returned.
    """
    edges = materialize(
        links.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v"))
        .distinct(), "links")
    seen = None
    for _ in range(MAX_ROUNDS):
        edges = materialize(_star(_star(edges, True), False), "stars")
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum("v"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component_id"))).distinct()
