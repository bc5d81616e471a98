"""Connected components of an edge table, by alternating large-star and small-star.

Every round is two joins and two aggregations over the edges; nothing is collected
to the driver but a count and a checksum. Rounds are cut with reliable checkpoints.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import checkpointed


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over pairs (u, v), u > v. Large: every neighbour above a vertex
    is tied to the smallest of its neighbourhood. Small: every neighbour below."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    if large:
        tied = both.filter("v > u").join(least.select("u", F.least("u", "m").alias("m")), "u").select("v", "m")
    else:
        tied = both.join(least, "u").select("v", "m").union(least.select(F.col("u").alias("v"), "m"))
    return tied.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, root): every vertex of ``edges`` (u, v: long) but the roots themselves, with
    the smallest vertex of its component. Any edge direction, repeats and loops."""
    clean = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    clean = checkpointed(clean)
    before = _state(clean)
    while before[0]:
        clean = checkpointed(_star(_star(clean, large=True), large=False))
        after = _state(clean)
        if after == before:
            break
        before = after
    return clean.select("u", F.col("v").alias("root"))
