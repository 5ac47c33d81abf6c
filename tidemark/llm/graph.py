"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import materialize, release


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) of every node in ``links`` (``a``, ``b``).

    Alternates two star operations until nothing changes: every node links its larger neighbours to
    the smallest neighbour, then its smaller ones. The number of rounds is logarithmic in practice, long
    chains included; every round is written to the shared folder, so the plan stays short. Neighbours are
    only aggregated and joined, never gathered, so a node with many links is no hot spot.
    NULL ends and links of a node to itself are left out.
    """
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    nodes = materialize(edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct())
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # larger neighbours of u to the smallest neighbour of u
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        # smaller neighbours of u, and u, to the smallest of them
        small = large.join(smallest, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
        new = materialize(small.select("e.u", "e.v").where("u <> v").distinct())
        # settled when every node links to one root that links to nothing
        deep = new.select(F.col("v").alias("u")).distinct().join(new.select("u").distinct(), "u", "left_semi")
        several = new.groupBy("u").agg(F.count("*").alias("n")).where("n > 1")
        release(edges)
        edges = new
        if deep.isEmpty() and several.isEmpty():
            break
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
