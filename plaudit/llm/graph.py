"""Connected components by alternating star operations, written out after each round."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plaudit.staging import stage


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def components(links: DataFrame) -> DataFrame:
    """Rows (id, component) for all ids of the links (a, b); a component is named by its
    smallest id.  Each round points every id at the smallest one around it, so the number of
    rounds follows the logarithm of the longest path.  Smallest ids are found by partial
    aggregation, so an id with very many links is no single task's work."""
    edges = stage(
        links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo").distinct(), "links"
    )
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).filter("hi <> lo").distinct()
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lowest, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).filter("hi <> lo")
        edges = stage(small.unionByName(lowest.select("hi", F.col("m").alias("lo"))).distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
    return edges.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(roots)
