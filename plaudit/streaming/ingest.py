"""Incremental ingest of raw review files."""

from __future__ import annotations

from pyspark.sql import SparkSession

from plaudit.sources.rejects import MARK_OPTIONS, MARKED_RAW, with_marks


def ingest_new(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> None:
    """Append the files of ``src`` not seen before to the Parquet table ``dst``.

    The checkpoint remembers finished files, so a second run, or a run after a
    failure, adds each file once.  A file whose header differs from the expected
    one fails the run; a record with too few or too many fields is marked
    (``plaudit.sources.rejects``).
    """
    reader = spark.readStream.schema(MARKED_RAW).options(**MARK_OPTIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        with_marks(reader.csv(src))
        .writeStream.format("parquet")
        .option("path", dst)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
