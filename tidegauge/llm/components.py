"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import discard, stored


def _mark(edges: DataFrame):
    """Count and checksum, to see whether a round changed anything."""
    return edges.agg(
        F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")
    ).first()


def components(edges: DataFrame) -> DataFrame:
    """`node, root` for every node of `edges` (`a`, `b` of type long) that is not its own root.

    The root is the smallest node of its component. Large-star and small-star steps
    alternate until nothing changes, which takes a number of rounds that grows with
    the logarithm of the number of nodes; only the last round's table stays. A node's neighbours are never gathered: their
    minimum is aggregated before the shuffle and joined back, and adaptive execution
    splits that join at hot nodes. Each round is a written table. Loops, repeated
    edges and null ends are ignored; no edges give no rows.
    """
    now = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    mark = _mark(now)
    while mark["n"]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        large = stored(large, "large")
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lower, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(lower.withColumnRenamed("m", "v"))
            .distinct()
        )
        then, before, now = mark, now, stored(small, "small")
        mark = _mark(now)
        discard(before, large)
        if (mark["n"], mark["x"]) == (then["n"], then["x"]):
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
