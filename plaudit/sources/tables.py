"""Parquet and catalog tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    stamp: bool = False,
    format: str = "parquet",
) -> None:
    """Write from the executors.  ``stamp`` adds the load time as ``refreshed_at``."""
    out = df.withColumn("refreshed_at", F.current_timestamp()) if stamp else df
    writer = out.write.mode(mode).format(format)
    if format == "csv":
        writer = writer.option("header", True)
    if format == "parquet":
        writer = writer.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None, require: bool = True) -> DataFrame:
    """Read Parquet, only the named columns, after checking that the input exists."""
    df = open_inputs(spark, [path])[0] if require else spark.read.parquet(path)
    return df.select(*columns) if columns else df


def open_inputs(spark: SparkSession, paths: Iterable[str]) -> list[DataFrame]:
    """Parquet inputs, opened once; fails before any work starts when one is absent, naming
    all absent ones.  Any other fault of an input is raised as it is."""
    opened, missing = [], []
    for path in paths:
        try:
            opened.append(spark.read.parquet(path))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(path)
    if missing:
        raise FileNotFoundError("missing inputs: " + ", ".join(missing))
    return opened


def write_tables(tables: dict[str, DataFrame], folder: str, stamp: Iterable[str] = ()) -> None:
    stamped = set(stamp)
    for name, df in tables.items():
        write_table(df, f"{folder}/{name}", stamp=name in stamped)


def save_tables(tables: dict[str, DataFrame], database: str) -> None:
    """Replace catalog tables, each task writing its own rows."""
    for name, df in tables.items():
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        df.write.mode("overwrite").saveAsTable(f"{database}.{name}")


def read_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    names = list(names)
    return dict(zip(names, open_inputs(spark, [f"{folder}/{name}" for name in names])))


def load_marts(spark: SparkSession, folder: str, names: Iterable[str], skip: Iterable[str] = ("model_weights",)) -> list[str]:
    """Register CSV marts as catalog tables ``gold_<name>`` with inferred types."""
    loaded = []
    for name in names:
        if name in set(skip):
            continue
        df = spark.read.csv(f"{folder}/{name}", header=True, inferSchema=True)
        df.write.mode("overwrite").saveAsTable(f"gold_{name}")
        loaded.append(f"gold_{name}")
    return loaded


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Truncate and reload a database table, each task sending its own rows."""
    df.write.option("truncate", "true").jdbc(url, table, mode="overwrite", properties=properties or {})


def cast_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast to a declared target schema; a value that does not fit fails."""
    return df.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in schema])


def register(tables: dict[str, DataFrame]) -> None:
    """Expose tables to SQL text."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
