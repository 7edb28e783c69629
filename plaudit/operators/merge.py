"""Aggregate warehouse: dimensions that keep their ids, and facts at cube grain.

Nothing here is updated in place.  A merge reads the old dimension and returns the
new one; the caller writes it to another path and then switches over.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from plaudit.functions.rounding import MONEY, mean_money, percent, ratio
from plaudit.operators.keys import dense_key

MART_DIMS = {
    "category": ("dim_category", "category_id", "category_name"),
    "price_band": ("dim_price_band", "price_band_id", "price_band_name"),
    "sentiment": ("dim_sentiment", "sentiment_id", "sentiment_name"),
}


def _highest(old: DataFrame, key: str) -> Column:
    return old.agg(F.coalesce(F.max(key), F.lit(0)).cast("long").alias("top")).scalar()


def upsert_dim(old: DataFrame, names: DataFrame, key: str, name: str) -> DataFrame:
    """Old rows unchanged; unseen names get the next ids in name order."""
    unseen = names.select(name).filter(F.col(name).isNotNull()).distinct().join(old, name, "left_anti")
    added = dense_key(unseen, [name], key, after=_highest(old, key))
    return old.select(F.col(key).cast("long").alias(key), name).unionByName(added.select(key, name))


def insert_ratings(old: DataFrame, cells: DataFrame) -> DataFrame:
    unseen = cells.select("rating").distinct().join(old, "rating", "left_anti")
    return old.select("rating").unionByName(unseen)


def leading_category(totals: DataFrame) -> DataFrame:
    """One category per product name: most reviews, then name order."""
    best = F.min(F.struct((-F.col("reviews")).alias("rank"), F.col("category")))
    return totals.groupBy("product_name").agg(best.alias("best")).select("product_name", F.col("best.category").alias("category"))


def merge_products(old: DataFrame, new: DataFrame) -> DataFrame:
    """``old`` holds product_id, product_name, category_id; ``new`` name and category_id.

    A known product takes the new category and keeps its id.
    """
    unseen = new.select("product_name").join(old, "product_name", "left_anti")
    added = dense_key(unseen, ["product_name"], "product_id", after=_highest(old, "product_id"))
    ids = old.select(F.col("product_id").cast("long").alias("product_id"), "product_name", F.col("category_id").alias("_old"))
    every = ids.unionByName(added.withColumn("_old", F.lit(None).cast("long")).select(*ids.columns))
    latest = new.select("product_name", F.col("category_id").alias("_new"))
    return every.join(latest, "product_name", "full_outer").select(
        "product_id", "product_name", F.coalesce("_new", "_old").alias("category_id")
    )


def load_aggregate_fact(cells: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Cube cells with dimension ids instead of names."""
    out = cells
    for column, (table, key, name) in MART_DIMS.items():
        out = out.join(dims[table].select(key, F.col(name).alias(column)), column)
    return out.select(
        "category_id",
        "price_band_id",
        F.col("rating").cast("int").alias("rating"),
        "sentiment_id",
        F.col("reviews").alias("review_count"),
        F.col("sum_price").cast(MONEY).alias("sum_price"),
        "sum_words",
    )


def load_product_fact(totals: DataFrame, dim_product: DataFrame) -> DataFrame:
    """One row per product; a product in several categories is summed up first."""
    sums = ("reviews", "sum_rating", "positive", "negative", "sum_price")
    whole = totals.groupBy("product_name").agg(*[F.sum(c).alias(c) for c in sums])
    n = F.col("reviews")
    return whole.join(dim_product.select("product_id", "product_name"), "product_name").select(
        "product_id",
        n.alias("review_count"),
        ratio(F.col("sum_rating"), n, 2).cast("decimal(4,2)").alias("average_rating"),
        percent(F.col("positive"), n).cast("decimal(5,2)").alias("positive_percent"),
        percent(F.col("negative"), n).cast("decimal(5,2)").alias("negative_percent"),
        mean_money(F.col("sum_price"), n).cast("decimal(12,2)").alias("average_price"),
    )


def named_cube(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """The aggregate fact with dimension names again, for serving."""
    out = fact
    for column, (table, key, name) in MART_DIMS.items():
        out = out.join(dims[table].select(key, F.col(name).alias(column)), key)
    return out.select(
        "category", "price_band", "rating", "sentiment", F.col("review_count").alias("reviews"), "sum_price", "sum_words"
    )


def named_products(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    return (
        fact.join(dims["dim_product"], "product_id")
        .join(dims["dim_category"], "category_id")
        .select(
            "product_name",
            F.col("category_name").alias("category"),
            F.col("review_count").alias("reviews"),
            "average_rating",
            "positive_percent",
            "negative_percent",
            "average_price",
        )
    )
