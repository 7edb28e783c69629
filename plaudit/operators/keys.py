"""Surrogate keys that do not depend on layout and never sort everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from plaudit.functions.digest import row_md5
from plaudit.staging import stage

_SLOT_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def dense_key(df: DataFrame, order_cols: Sequence[str], name: str, after: Column | int = 0) -> DataFrame:
    """Number distinct rows ``after + 1 .. after + n`` in the order of ``order_cols``.

    ``order_cols`` must be unique.  Rows are range-partitioned on the whole key and
    sorted inside each partition; the position there plus the sizes of the
    partitions before it gives the key.  Unique keys keep the ranges balanced
    however skewed a prefix is.  The ranked rows are written once because sampled
    range bounds could differ if the two readers below computed them separately.
    """
    ranked = stage(
        df.repartitionByRange(*order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_slot", F.monotonically_increasing_id()),
        name,
    )
    part = F.shiftright("_slot", _SLOT_BITS)
    # one row per shuffle partition
    sizes = ranked.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")
    offsets = sizes.select("_part", before.alias("_before"))
    inside = F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    start = F.lit(after) if isinstance(after, int) else after
    return (
        ranked.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select((start + F.col("_before") + inside + 1).cast("long").alias(name), *df.columns)
    )


def extend_keys(ledger: DataFrame | None, members: DataFrame, order_cols: Sequence[str], name: str) -> DataFrame:
    """``ledger`` (key ``name`` and ``order_cols``) with the members that it lacks.

    A key once given stays with its member, so tables that refer to it need no rewrite; new
    members are numbered after the largest key, in the order of ``order_cols``, and a member that
    is no longer delivered keeps its row.
    """
    found = members.select(*order_cols).distinct()
    if ledger is None:
        return dense_key(found, order_cols, name)
    known = ledger.select(*[F.col(c).alias(f"_{c}") for c in order_cols])
    same = None
    for c in order_cols:
        equal = F.col(c).eqNullSafe(F.col(f"_{c}"))
        same = equal if same is None else same & equal
    last = ledger.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]
    new = dense_key(found.join(known, same, "left_anti"), order_cols, name, after=last)
    return ledger.select(name, *order_cols).unionByName(new)


def content_key(
    df: DataFrame, cols: Sequence[str] | None = None, name: str = "review_key", bucket_chars: int = 4, chunk: int = 100_000
) -> DataFrame:
    """Number all rows 1..n in the order of a digest of their content.

    Equal rows are collapsed to one row and a count before anything is sorted, so a
    row repeated many times costs one row; its copies are numbered afterwards.
    Distinct rows fall evenly into ``16 ** bucket_chars`` buckets, which are ranked
    independently.  Only a much repeated row makes a bucket large: the copies of such
    rows are spread over the cluster in chunks, all others are numbered in place.
    """
    columns = df.columns
    digested = df.withColumn("_digest", row_md5(list(cols or columns)))
    digested = digested.withColumn("_bucket", F.substring("_digest", 1, bucket_chars))
    # at most 16 ** bucket_chars rows
    sizes = stage(digested.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows")), f"{name}_buckets")
    total, largest = sizes.agg(F.coalesce(F.sum("_rows"), F.lit(0)), F.coalesce(F.max("_rows"), F.lit(0))).first()
    chunk = max(chunk, 2 * total // 16**bucket_chars)

    few = _placed(digested, sizes, columns).filter(F.col("_n") <= chunk)
    few = few.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    out = [(F.col("_start") + F.col("_copy")).alias(name), *[F.col(c) for c in columns]]
    if largest <= chunk:
        return few.select(*out)
    crowded = F.broadcast(sizes.filter(F.col("_rows") > chunk).select("_bucket"))
    many = _placed(digested.join(crowded, "_bucket", "left_semi"), sizes, columns).filter(F.col("_n") > chunk)
    last = F.call_function("div", F.col("_n") - 1, F.lit(chunk).cast("long"))
    chunks = many.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last))).repartition("_digest", "_chunk")
    begin = F.col("_chunk") * F.lit(chunk).cast("long")
    copies = chunks.withColumn("_copy", F.explode(F.sequence(begin + 1, F.least(F.col("_n"), begin + chunk))))
    return few.select(*out).unionByName(copies.select(*out))


def _placed(digested: DataFrame, sizes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows with their count ``_n`` and the number of rows before them, ``_start``."""
    offsets = sizes.select("_bucket", (F.sum("_rows").over(Window.orderBy("_bucket")) - F.col("_rows")).alias("_offset"))
    inside = Window.partitionBy("_bucket").orderBy("_digest", *columns)
    before = F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    return (
        digested.groupBy("_bucket", "_digest", *columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_inside", before)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn("_start", F.col("_offset") + F.col("_inside"))
    )
