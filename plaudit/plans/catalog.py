"""Partitioned catalog tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from plaudit.functions.digest import row_digest
from plaudit.staging import stage

REVIEW_COLUMNS = (
    "product_name",
    "price",
    "price_band",
    "rating",
    "sentiment",
    "word_count",
    "review_text",
    "category",
)


def recreate(spark: SparkSession, database: str, table: str) -> str:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")
    return f"{database}.{table}"


def save_partitioned(df: DataFrame, table: str, by: str = "category", path: str | None = None) -> DataFrame:
    """Save as ``database.table`` with one folder per value of ``by``.

    Rows are dealt by ``by`` first, so a task writes few folders; adaptive execution splits
    a large category over several tasks.
    """
    spark = df.sparkSession
    database, _, name = table.rpartition(".")
    full = recreate(spark, database or "default", name)
    writer = df.hint("rebalance", by).write.mode("overwrite").format("parquet").partitionBy(by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(full)
    return spark.table(full)


def folder_digests(df: DataFrame, by: str) -> DataFrame:
    """For each value of ``by`` the number of rows and sums of the parts of row digests,
    which do not depend on the order of rows.  An empty string is null, as Spark stores both in one folder."""
    digest = row_digest(sorted(set(df.columns) - {by}))
    parts = [F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(20,0)") for start in (1, 16, 31, 46)]
    value = F.nullif(F.col(by).cast("string"), F.lit(""))
    rows = df.select(value.alias("_by"), *(p.alias(f"_h{i}") for i, p in enumerate(parts)))
    return rows.groupBy("_by").agg(F.count(F.lit(1)).alias("_n"), *(F.sum(f"_h{i}").alias(f"_h{i}") for i in range(len(parts))))


def same_columns(a: DataFrame, b: DataFrame) -> bool:
    return {(f.name, f.dataType) for f in a.schema} == {(f.name, f.dataType) for f in b.schema}


def publish_partitioned(df: DataFrame, table: str, by: str = "category") -> DataFrame:
    """Only the changed folders if the table is there with the same columns, else all of it."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table) and same_columns(df, spark.table(table)):
        replace_changed(df, table, by)
        return spark.table(table)
    return save_partitioned(df, table, by)


def replace_changed(df: DataFrame, table: str, by: str = "category") -> list[str | None]:
    """Give a partitioned table the rows of ``df``, writing only folders whose rows differ and
    dropping folders that have none any more; the files of other folders stay as they are.

    ``df`` must not read the table itself and is read twice, so it should be stored.  Returns the
    values of ``by`` whose folders were written or dropped.
    """
    spark = df.sparkSession
    stored = spark.table(table)
    if not same_columns(df, stored):
        raise ValueError(f"{table} has other columns: {stored.columns}")
    sums = ["_n", "_h0", "_h1", "_h2", "_h3"]
    old = folder_digests(stored, by).select(F.col("_by").alias("_was"), *(F.col(c).alias(f"_old{c}") for c in sums))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_old{c}")) for c in sums))
    both = folder_digests(df, by).join(old, F.col("_by").eqNullSafe(F.col("_was")), "full")
    differ = both.filter(~same).select(F.coalesce("_by", "_was").alias("_by"), F.col("_n").isNull().alias("_gone"))
    differ = stage(differ, "folders")
    changed = differ.filter("not _gone").select("_by")
    wanted = df.join(changed, F.nullif(F.col(by).cast("string"), F.lit("")).eqNullSafe(F.col("_by")), "left_semi")
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        wanted.select(*stored.columns).hint("rebalance", by).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, before)
    touched = differ.orderBy("_by").collect()  # one row for each changed folder, as the catalog's own list
    for row in touched:
        if row["_gone"]:
            value = "NULL" if row["_by"] is None else "'" + row["_by"].replace("\\", "\\\\").replace("'", "\\'") + "'"
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({by} = {value})")
    return [row["_by"] for row in touched]


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}")


def list_partitions(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {table}")


def describe(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE {table}")
