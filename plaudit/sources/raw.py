"""Raw review files: everything stays text until the cleaning step."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

# ---- fixed values: file header and the names used everywhere else -----------
RAW_NAMES = {
    "ProductName": "product_name",
    "Price": "price",
    "Rate": "rate",
    "Review": "review_title",
    "Summary": "summary",
}
# -----------------------------------------------------------------------------
RAW_SCHEMA = StructType([StructField(name, StringType()) for name in RAW_NAMES])
BRONZE_COLUMNS = tuple(RAW_NAMES.values())

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}


def read_raw(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """All-text columns named by the file header.

    ``multiline`` accepts line breaks inside quotes, but then a file cannot be split.
    """
    return spark.read.options(**CSV_OPTIONS, multiLine=str(multiline).lower()).csv(path)


def rename_columns(df: DataFrame, mapping: Mapping[str, str] = RAW_NAMES) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV written by the executors; blanks around a value are kept."""
    (
        df.write.mode(mode)
        .options(**CSV_OPTIONS, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
        .csv(path)
    )
