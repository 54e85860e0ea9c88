"""Connected components by alternating star contraction, entirely in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatledger.session import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))
        ).first()
    )


def _nearest(edges: DataFrame) -> DataFrame:
    """Every edge (u, v) with ``m``, the least node next to u or u itself.

    The least neighbour is an aggregate, so a hub costs one record per map task; the join
    back lets Spark split the hub's partition.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b): root is the least node reachable.

    Each pass hangs all larger neighbours of a node onto its least neighbour, then all
    smaller ones; passes are logarithmic in practice and end when the edges no longer
    change. Null ends and self-loops are ignored; no edges give no rows.
    """
    u, v = F.greatest("a", "b"), F.least("a", "b")
    now = stored(
        edges.where("a is not null and b is not null and a <> b").select(u.alias("u"), v.alias("v")).distinct(),
        "edges",
    )
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(
            _nearest(both).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "large",
        )
        pairs = _nearest(large)
        now = stored(
            pairs.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(pairs.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct(),
            "small",
        )
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
