"""Star schema at review grain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

from plaudit.functions.rules import SENTIMENTS
from plaudit.operators.keys import content_key, dense_key
from plaudit.staging import stage

STAR_TABLES = ("dim_category", "dim_product", "dim_price_band", "dim_sentiment", "fact_reviews")

# declared types of the fact table
FACT_SCHEMA = StructType(
    [
        StructField("review_key", LongType()),
        StructField("product_key", IntegerType()),
        StructField("price_band_key", IntegerType()),
        StructField("sentiment_key", IntegerType()),
        StructField("rating", ShortType()),
        StructField("price", DecimalType(12, 2)),
        StructField("word_count", IntegerType()),
        StructField("review_text", StringType()),
    ]
)


def sentiment_dim(spark: SparkSession) -> DataFrame:
    """A relation of literals, whose size Spark knows when it plans a join."""
    rows = ", ".join(f"({key}, '{name}')" for key, name in enumerate(SENTIMENTS, start=1))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(sentiment_key, sentiment)")


def name_dim(df: DataFrame, column: str, key: str, name: str) -> DataFrame:
    """Distinct names numbered in name order."""
    names = df.select(F.col(column).alias(name)).distinct()
    return dense_key(names, [name], key).withColumn(key, F.col(key).cast("int"))


def product_dim(silver: DataFrame, dim_category: DataFrame) -> DataFrame:
    """Distinct (name, category) pairs numbered by name, then category."""
    pairs = silver.select("product_name", F.col("category").alias("category_name")).distinct()
    known = pairs.filter(F.col("product_name").isNotNull()).join(dim_category, "category_name")
    numbered = dense_key(known, ["product_name", "category_name"], "product_key")
    return numbered.select(F.col("product_key").cast("int").alias("product_key"), "product_name", "category_key")


def product_lookup(dim_product: DataFrame, dim_category: DataFrame) -> DataFrame:
    return dim_product.join(dim_category, "category_key").select("product_key", "product_name", "category_name")


def build_fact(silver: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Silver rows with surrogate keys.

    The dimensions are stored tables, so Spark sees their real size: small ones are
    broadcast, a large product dimension is joined by shuffle, where adaptive
    execution splits the partition of a very popular product.
    """
    lookup = product_lookup(dims["dim_product"], dims["dim_category"]).withColumnRenamed("category_name", "category")
    text = ["review_text"] if "review_text" in silver.columns else []
    return (
        silver.join(lookup, ["product_name", "category"])
        .join(dims["dim_price_band"], "price_band")
        .join(dims["dim_sentiment"], "sentiment")
        .select(
            "product_key",
            "price_band_key",
            "sentiment_key",
            F.col("rating").cast("int").alias("rating"),
            F.round("price", 2).alias("price"),
            F.col("word_count").cast("int").alias("word_count"),
            *text,
        )
    )


def build_dims(silver: DataFrame) -> dict[str, DataFrame]:
    """Dimensions from one pass over the reviews: their distinct names are written once."""
    names = stage(silver.select("product_name", "category", "price_band").distinct(), "names")
    category = stage(name_dim(names, "category", "category_key", "category_name"), "dim_category")
    return {
        "dim_category": category,
        "dim_product": product_dim(names, category),
        "dim_price_band": name_dim(names, "price_band", "price_band_key", "price_band"),
        "dim_sentiment": sentiment_dim(silver.sparkSession),
    }


def build_star(silver: DataFrame, unknown_product: str | None = None) -> dict[str, DataFrame]:
    """All star tables.  Rows without a product name have no dimension row and are
    left out, unless ``unknown_product`` names a member for them."""
    if unknown_product is not None:
        silver = silver.fillna(unknown_product, ["product_name"])
    dims = {name: df if name == "dim_sentiment" else stage(df, name) for name, df in build_dims(silver).items()}
    return {**dims, "fact_reviews": build_fact(silver, dims)}


def keyed_fact(fact: DataFrame) -> DataFrame:
    """The typed fact table with ``review_key``, equal for every layout of the input."""
    typed = StructType([f for f in FACT_SCHEMA if f.name != "review_key"])
    cast = fact.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in typed])
    return content_key(cast).select(*FACT_SCHEMA.fieldNames())


def fact_rules() -> dict:
    """Row rules of the fact table; key columns must also be present."""
    present = {f"{f.name} not null": F.col(f.name).isNotNull() for f in FACT_SCHEMA if f.name != "review_key"}
    return {**present, "rating 1..5": F.col("rating").between(1, 5), "price fits": F.abs(F.col("price")) < 1e10}
