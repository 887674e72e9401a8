"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitwatch.llm.common import join_hot, stored

MAX_ROUNDS = 60


def _minimum(links: DataFrame) -> DataFrame:
    """Smallest neighbour and number of links of each ``u``; counted down in the map tasks."""
    return links.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n_rows"))


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node with a link, the component being its smallest node.

    ``links`` has the long columns ``u`` and ``v``; direction, repeats and loops do not
    matter, and nulls are left out. Each round hangs larger neighbours on the smallest one
    of every node, then smaller ones, until only stars are left: a logarithm of the longest
    path in rounds. Links are written to the shared folder in between and never gathered;
    a node with a large share of all links is joined by broadcast.
    """
    edges = stored(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter("u != v").distinct(),
        "links",
    )
    before = None
    for _ in range(MAX_ROUNDS):
        count, state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if not count or state == before:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = stored(_minimum(both), "nearest")
        large = stored(
            join_hot(both, near, "u", 2 * count)
            .filter("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct(),
            "links",
        )
        near = stored(_minimum(large), "nearest")
        small = (
            join_hot(large, near, "u", count)
            .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                      F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .filter("u != v")
            .distinct()
        )
        edges = stored(small, "links")
    else:
        raise RuntimeError("components did not settle")
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
