"""Marts kept up to date by batches: a new batch is read, what is stored is added to.

The stored state is additive: the cube's counts and exact sums, totals of every product, uses
of every word.  A batch's rows that were not delivered before are cleaned and summed up,
and these sums are added to the stored ones; averages, shares and thresholds are worked
out when a mart is read.  A row that an earlier batch delivered is found by its digest and
counted once, as in a run over everything.  So a version after any batches equals the
version after one batch with all their rows, and a merge reads the batch, digests and sums, but
no stored text.

All tables of a version are published together, see ``plaudit.sources.snapshots``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from plaudit.functions.rules import CATEGORY_RULES
from plaudit.operators import cube as K
from plaudit.operators import seen
from plaudit.operators import words as W
from plaudit.operators.keys import dense_key, extend_keys
from plaudit.plans.silver import cleaned
from plaudit.sources.raw import BRONZE_COLUMNS
from plaudit.sources.snapshots import Snapshot, latest, publish, put
from plaudit.staging import stage

# additive tables and what identifies their rows
STATE = {"cube": K.CUBE_DIMS, "product_totals": ("product_name", "category"), "words": ("word",)}
PRODUCT = ("product_name", "category")


def added(stored: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums of both by ``keys``; types stay those of ``delta``."""
    kinds = {field.name: field.dataType for field in delta.schema}
    sums = [F.sum(c).cast(kinds[c]).alias(c) for c in delta.columns if c not in keys]
    return stored.select(*delta.columns).unionByName(delta).groupBy(*keys).agg(*sums)


def deltas(reviews: DataFrame) -> dict[str, DataFrame]:
    """The additive state of some cleaned reviews."""
    return {"cube": K.cube(reviews), "product_totals": K.product_totals(reviews, 1), "words": W.word_pivot(W.tokens(reviews))}


def fresh_rows(base: Snapshot, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct rows of a batch, and those of them that no earlier batch delivered."""
    rows = stage(seen.digested(raw, BRONZE_COLUMNS), "batch", "zstd")
    if "digests" not in base:
        return rows, rows
    known = stage(seen.seen_before(rows.select("digest"), base.read("digests"), base.read("bloom")), "known")
    # texts are read from the batch again: a copy of the fresh ones would be written for nothing
    return rows, rows.join(known, "digest", "left_anti")


def apply_batch(spark: SparkSession, root: str, raw: DataFrame, batch: str, rules: Sequence = CATEGORY_RULES) -> Snapshot:
    """The version after ``raw``.  ``batch`` names the delivery: one that a version holds
    already changes nothing, so a delivery can be repeated after a failure."""
    base = latest(spark, root)
    if batch in base.batches:
        return base
    rows, fresh = fresh_rows(base, raw)
    # distinct rows by their digests; written once, where the version will have them
    place, reviews = put(base, "silver", cleaned(fresh.select(*BRONZE_COLUMNS), rules=rules))
    digests = stage(fresh.select("digest"), "fresh")

    state = {}
    for name, delta in deltas(reviews).items():
        state[name] = added(base.read(name), delta, STATE[name]) if name in base else delta
    named = reviews.filter(F.col("product_name").isNotNull())
    state["product_keys"] = extend_keys(base.read("product_keys") if "product_keys" in base else None, named, PRODUCT, "product_key")
    bloom = seen.bloom(digests)
    state["bloom"] = seen.merged_bloom(base.read("bloom"), bloom) if "bloom" in base else bloom

    last = base.read("digests").agg(F.coalesce(F.max("row_key"), F.lit(0))).first()[0] if "digests" in base else 0
    keyed = dense_key(digests, ["digest"], "row_key", after=last)
    size = lambda df: df.agg(F.count(F.lit(1))).scalar()
    counts = rows.agg(F.coalesce(F.sum("delivered"), F.lit(0)).alias("delivered"), F.count(F.lit(1)).alias("distinct_rows"))
    counts = counts.withColumn("added", size(digests)).withColumn("kept", size(reviews))
    more = {
        "digests": keyed.withColumn("bucket", seen.bucket_of(F.col("digest"))).repartitionByRange("bucket").sortWithinPartitions("bucket"),
        "batches": counts.select(F.lit(batch).alias("batch"), *counts.columns),
    }
    return publish(base, state, more, batch, {"silver": (place, reviews)})


def cube_of(version: Snapshot) -> DataFrame:
    return K.published_cube(version.read("cube"))


def products_of(version: Snapshot, min_reviews: int = 100) -> DataFrame:
    totals = version.read("product_totals")
    return K.ordered(K.rated(totals.filter(F.col("reviews") >= min_reviews)))


def batch_sink(root: str, stream: str, rules: Sequence = CATEGORY_RULES) -> Callable[[DataFrame, int], None]:
    """For ``writeStream.foreachBatch``: merges each micro-batch under its own name, so one that
    Spark repeats after a failure is merged once."""

    def merge(raw: DataFrame, number: int) -> None:
        apply_batch(raw.sparkSession, root, raw, f"{stream}-{number}", rules)

    return merge
