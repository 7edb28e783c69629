"""Rows of a large table by a list of ids, without moving the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SLOTS = 1 << 20


def slot(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(SLOTS))


def near_rows(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id shares a hash slot with one of ``ids``, where they are.  The
    list of slots that goes to every task has at most ``SLOTS`` numbers."""
    slots = ids.select(slot(key).alias("_slot")).distinct()
    return docs.withColumn("_slot", slot(key)).join(F.broadcast(slots), "_slot", "left_semi").drop("_slot")


def rows_of(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` with one of ``ids``; the same plan for every number of ids."""
    return near_rows(docs, ids, key).join(ids.select(key).hint("merge"), key, "left_semi")


def flagged(rows: DataFrame, key: Column, some: DataFrame, flag: str) -> DataFrame:
    """``rows`` with the boolean ``flag``: true for all whose ``key``, a 64-bit hash, is in the
    one column of ``some``, and by chance for a few others.  The bits of the keys' places that go
    to every task are at most ``SLOTS`` numbers, so the rows stay where they are at every size."""

    def placed(df: DataFrame, hashed: Column) -> DataFrame:
        place = df.withColumn("_place", F.pmod(hashed, F.lit(64 * SLOTS)))
        return place.withColumn("_slot", F.shiftright("_place", 6)).withColumn("_place", F.pmod("_place", F.lit(64)).cast("int"))

    bits = placed(some, F.col(some.columns[0])).groupBy("_slot").agg(F.bit_or(F.expr("shiftleft(1L, _place)")).alias("_bits"))
    asked = placed(rows, key).join(F.broadcast(bits), "_slot", "left")
    found = F.bit_get("_bits", F.col("_place")) == 1
    return asked.withColumn(flag, F.coalesce(found, F.lit(False))).drop("_slot", "_place", "_bits")
