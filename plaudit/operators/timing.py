"""Summaries of timed runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from plaudit.functions.rounding import settle
from plaudit.staging import stage

_SLOT_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def median_times(timings: DataFrame) -> DataFrame:
    """Number of runs and median seconds per configuration.

    Runs are sorted across the cluster; a run's place is its place in its partition plus
    the configuration's runs in the partitions before it.  Only the middle runs are then
    read, so no task holds a whole configuration.  Runs without a time count as runs only.
    """
    runs = timings.groupBy("engine").agg(F.count(F.lit(1)).alias("runs"))
    timed = timings.filter(F.col("seconds").isNotNull()).select("engine", "seconds")
    ranked = stage(
        timed.repartitionByRange("engine", "seconds").sortWithinPartitions("engine", "seconds").withColumn(
            "_slot", F.monotonically_increasing_id()
        ),
        "times",
    ).withColumn("_part", F.shiftright("_slot", _SLOT_BITS))
    # a row per configuration and partition
    sizes = ranked.groupBy("engine", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_slot").alias("_first"))
    order = Window.partitionBy("engine").orderBy("_part")
    starts = sizes.select(
        "engine",
        "_part",
        "_first",
        (F.sum("_n").over(order) - F.col("_n")).alias("_before"),
        F.sum("_n").over(Window.partitionBy("engine")).alias("_all"),
    )
    place = F.col("_before") + F.col("_slot") - F.col("_first")
    half = F.call_function("div", F.col("_all"), F.lit(2).cast("long"))
    middle = place.between(F.when(F.col("_all") % 2 == 0, half - 1).otherwise(half), half)
    medians = ranked.join(starts, ["engine", "_part"]).filter(middle).groupBy("engine").agg(settle(F.avg("seconds"), 4).alias("seconds"))
    return runs.join(medians, runs["engine"].eqNullSafe(medians["engine"]), "left").select(runs["engine"], "runs", "seconds")


def throughput(timings: DataFrame) -> DataFrame:
    """Rows per second of each run; 0 for a run too short to measure."""
    rate = F.when(F.col("seconds") > 0, settle(F.col("rows") / F.col("seconds"), 2)).otherwise(F.lit(0.0))
    return timings.withColumn("rows_per_second", rate)
