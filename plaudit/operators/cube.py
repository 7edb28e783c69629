"""Cubes, product totals, splits and replication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from plaudit.functions.rounding import MONEY, mean_money, percent, ratio

CUBE_DIMS = ("category", "price_band", "rating", "sentiment")


def cube(silver: DataFrame, dims: Sequence[str] = CUBE_DIMS) -> DataFrame:
    """Counts and exact sums at the grain of ``dims``."""
    return silver.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("reviews"),
        F.sum(F.col("price").cast(MONEY)).alias("sum_price"),
        F.sum(F.col("word_count").cast("long")).alias("sum_words"),
    )


def published_cube(cells: DataFrame) -> DataFrame:
    """The cube as shown: whole-unit price sums, sorted."""
    return cells.withColumn("sum_price", F.round("sum_price", 0).cast("double")).orderBy("category", "price_band", "rating")


def rollup_sets(dims: Sequence[str] = CUBE_DIMS) -> list[tuple[str, ...]]:
    return [tuple(dims[:n]) for n in range(len(dims), -1, -1)]


def cube_sets(dims: Sequence[str] = CUBE_DIMS) -> list[tuple[str, ...]]:
    return [kept for n in range(len(dims), -1, -1) for kept in combinations(dims, n)]


def lattice(cells: DataFrame, dims: Sequence[str] = CUBE_DIMS, sets: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """Totals at several grains (those of a rollup by default) from the cells of ``cube(..., dims)``.

    Each grain sums up the coarsest grain before it that holds its dimensions, so the reviews are
    not multiplied by the number of grains.  ``grouping_id`` has a bit for each dimension, the
    first one highest, set where the row is a total over it; so a null of the data and a total
    differ.  Store ``cells`` first, as every grain may read them.  No cells give no rows, the
    grand total included.
    """
    sets = [tuple(s) for s in (rollup_sets(dims) if sets is None else sets)]
    unknown = {name for kept in sets for name in kept} - set(dims)
    if unknown:
        raise ValueError(f"not dimensions of the cells: {sorted(unknown)}")
    types = {name: cells.schema[name].dataType for name in dims}
    sums = [F.sum("reviews").alias("reviews"), F.sum(F.col("sum_price").cast("decimal(38,2)")).alias("sum_price"), F.sum("sum_words").alias("sum_words")]
    done: dict[tuple[str, ...], DataFrame] = {tuple(dims): cells}
    levels = []
    for kept in sorted(dict.fromkeys(sets), key=len, reverse=True):
        finer = min((held for held in done if set(kept) <= set(held)), key=len)
        bits = sum(1 << len(dims) - 1 - i for i, name in enumerate(dims) if name not in kept)
        done[kept] = done[finer].groupBy(*kept, F.lit(bits).cast("long").alias("grouping_id")).agg(*sums)
        levels.append(done[kept].select(*(F.col(n) if n in kept else F.lit(None).cast(types[n]).alias(n) for n in dims), "grouping_id", "reviews", "sum_price", "sum_words"))
    return reduce(DataFrame.unionAll, levels)


def product_totals(silver: DataFrame, min_reviews: int = 100) -> DataFrame:
    """Exact sums per (product, category) with enough reviews."""
    return (
        silver.groupBy("product_name", "category")
        .agg(
            F.count(F.lit(1)).alias("reviews"),
            F.sum(F.col("rating").cast("long")).alias("sum_rating"),
            F.count_if(F.col("sentiment") == "positive").alias("positive"),
            F.count_if(F.col("sentiment") == "negative").alias("negative"),
            F.sum(F.col("price").cast(MONEY)).alias("sum_price"),
        )
        .filter(F.col("reviews") >= min_reviews)
    )


def rated(totals: DataFrame) -> DataFrame:
    """Totals turned into the averages and shares of the product table."""
    n = F.col("reviews")
    return totals.select(
        "product_name",
        "category",
        "reviews",
        ratio(F.col("sum_rating"), n, 2).alias("avg_rating"),
        percent(F.col("positive"), n).alias("pct_positive"),
        percent(F.col("negative"), n).alias("pct_negative"),
        mean_money(F.col("sum_price"), n).alias("avg_price"),
    )


def ordered(rated_products: DataFrame) -> DataFrame:
    return rated_products.orderBy(F.desc("reviews"), "product_name", "category")


def products(silver: DataFrame, min_reviews: int = 100) -> DataFrame:
    return ordered(rated(product_totals(silver, min_reviews)))


def split_by(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), *cols)


def count_and_mean(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("reviews"), F.avg(value).alias(f"avg_{value}"))


def replicate(df: DataFrame, n: int) -> DataFrame:
    """Every row ``n`` times, generated inside each task."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("_copy")
