"""Rows that were delivered before, told by stored digests and a Bloom filter.

The store keeps the digest of every raw row taken so far, never its text.  Before a
new batch is compared with it, the batch's digests are looked up in a Bloom filter: most new
rows have an unset bit there and need no comparison.  The filter is a table of bitmaps of
4 KB, one for each slot, so it grows with ``slots`` and no task holds more than one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from plaudit.functions.digest import row_digest
from plaudit.staging import stage

SLOT_BITS = 32768  # of Spark's bitmap aggregates
SLOTS = 4096  # of the filter; 10 million digests set about one bit in seven
PROBES = 2  # bits of a digest
BUCKETS = 1024  # the digest table is ordered by them, so files and row groups hold few each


def digested(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows of a batch with their ``digest``, and how often each was ``delivered``."""
    return raw.groupBy(*columns).agg(F.count(F.lit(1)).alias("delivered")).withColumn("digest", row_digest(columns))


def bucket_of(digest: Column) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(BUCKETS)).cast("int")


def _bits(digests: DataFrame, slots: int) -> DataFrame:
    """Rows (digest, slot, bit): the filter's bits of each digest."""
    places = F.explode(F.array(*[F.pmod(F.xxhash64("digest", F.lit(n)), F.lit(slots * SLOT_BITS)) for n in range(1, PROBES + 1)]))
    placed = digests.select("digest", places.alias("_place"))
    slot = F.call_function("div", F.col("_place"), F.lit(SLOT_BITS))
    return placed.select("digest", slot.alias("slot"), F.pmod("_place", F.lit(SLOT_BITS)).alias("bit"))


def bloom(digests: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Rows (slot, bits) of the filter of ``digests``."""
    return _bits(digests, slots).groupBy("slot").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merged_bloom(stored: DataFrame, added: DataFrame) -> DataFrame:
    return stored.unionByName(added).groupBy("slot").agg(F.bitmap_or_agg("bits").alias("bits"))


def maybe_seen(digests: DataFrame, stored: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Those of ``digests`` all of whose bits are set; of the others it is certain that they are new."""
    asked = _bits(digests, slots).join(stored, "slot")
    byte = F.substring("bits", (F.call_function("div", F.col("bit"), F.lit(8)) + 1).cast("int"), F.lit(1))
    set_bit = F.bit_get(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod("bit", F.lit(8)).cast("int"))
    return asked.filter(set_bit == 1).groupBy("digest").agg(F.count(F.lit(1)).alias("_set")).filter(F.col("_set") == PROBES).select("digest")


def seen_before(digests: DataFrame, store: DataFrame, filter_rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Those of ``digests`` that the store (digest, bucket) holds."""
    maybe = stage(maybe_seen(digests, filter_rows, slots).withColumn("bucket", bucket_of(F.col("digest"))), "maybe-seen")
    return maybe.join(store.select("bucket", "digest"), ["bucket", "digest"], "left_semi").select("digest")
