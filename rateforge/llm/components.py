"""Connected components of a table of links by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialize


def _nearest(edges: DataFrame) -> DataFrame:
    """(node, low): the smallest of each node's neighbours, in a table of its own.

    As a table, both sides of the next join come straight from a shuffle, so
    the planner can split the rows of a node with very many links.
    """
    return materialize(edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low")), "star-centres")


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (its first two columns); label is the component's least node.

    Each round has a large-star step (a node's greater neighbours are linked
    to its least neighbour) and a small-star step (its lesser neighbours and
    itself are). Rounds are logarithmic in the size of a component; a round's
    links are written to the shared folder, which cuts the lineage. Only two
    figures a round come to the driver. Links to null are left out; a link of
    a node to itself gives the node a component of its own.
    """
    a, b = links.columns[:2]
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    alone = pairs.where("a = b").select(F.col("a").alias("node")).distinct()
    edges = materialize(
        pairs.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    state = None
    while True:
        figures = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if figures["n"] == 0 or figures == state:
            break
        state = figures
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        centres = _nearest(both)
        large = materialize(
            both.join(centres, both.u == centres.node)
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("low", both.u).alias("v"))
            .where("u <> v")
            .distinct(),
            "large-stars",
        )
        centres = _nearest(large)
        joined = large.join(centres, large.u == centres.node)
        small = joined.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = materialize(small.unionAll(centres.select(F.col("node").alias("u"), F.col("low").alias("v"))).distinct(), "links")
    labelled = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    centre = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("label"))
    found = labelled.unionAll(centre)
    lonely = alone.join(found, "node", "left_anti").select("node", F.col("node").alias("label"))
    return materialize(found.unionAll(lonely), "components")
