"""Serving and dashboard answers from the cube and the product table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from plaudit.functions.rounding import mean_money, percent, ratio
from plaudit.functions.rules import SENTIMENTS
from plaudit.operators.clean import apply_filters

COUNT = "reviews"


def _total(column: str = COUNT) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("long")


def _stars() -> Column:
    return F.coalesce(F.sum(F.col("rating").cast("long") * F.col(COUNT)), F.lit(0)).cast("long")


def summary(cells: DataFrame, category=None, price_band=None) -> DataFrame:
    """Total, average rating and average price; zeros when nothing matches."""
    chosen = apply_filters(cells, category=category, price_band=price_band)
    sums = chosen.agg(_total().alias("reviews"), _stars().alias("_s"), F.coalesce(F.sum("sum_price"), F.lit(0)).alias("_p"))
    return sums.select(
        "reviews",
        ratio(F.col("_s"), F.col("reviews"), 4, empty=0).alias("average_rating"),
        mean_money(F.col("_p"), F.col("reviews"), 2, empty=0).alias("average_price"),
    )


def sentiments(cells: DataFrame, category=None, price_band=None) -> DataFrame:
    chosen = apply_filters(cells, category=category, price_band=price_band)
    return chosen.groupBy("sentiment").agg(_total().alias("reviews"))


def sentiment_shares(cells: DataFrame, category=None, price_band=None) -> DataFrame:
    """Counts and percent of the chosen reviews per sentiment."""
    counts = sentiments(cells, category, price_band)
    everything = F.sum("reviews").over(Window.partitionBy())  # one row per sentiment
    return counts.withColumn("share", percent(F.col("reviews"), everything))


def filters(lists: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Sorted filter values as (kind, name)."""
    parts = [df.select(F.lit(kind).alias("kind"), F.col(column).alias("name")) for kind, (df, column) in lists.items()]
    return reduce(DataFrame.unionByName, parts).distinct().orderBy("kind", "name")


def filter_values(cells: DataFrame, columns: Sequence[str] = ("category", "price_band")) -> DataFrame:
    return filters({c: (cells, c) for c in columns})


def product_list(products: DataFrame, category: str | None = None, limit: int = 20) -> DataFrame:
    if not 1 <= limit <= 100:
        raise ValueError("limit must be between 1 and 100")
    chosen = apply_filters(products, category=category)
    return chosen.orderBy(F.desc("reviews"), "product_name", "category").limit(limit)


def kpis(cells: DataFrame, category=None, price_band=None) -> DataFrame:
    chosen = apply_filters(cells, category=category, price_band=price_band)
    sums = chosen.agg(
        _total().alias("reviews"),
        _stars().alias("_s"),
        *[F.coalesce(F.sum(F.when(F.col("sentiment") == s, F.col(COUNT))), F.lit(0)).alias(f"_{s}") for s in SENTIMENTS],
        F.coalesce(F.sum("sum_price"), F.lit(0)).alias("_p"),
    )
    n = F.col("reviews")
    return sums.select(
        "reviews",
        ratio(F.col("_s"), n, 2, empty=0).alias("avg_rating"),
        percent(F.col("_positive"), n, empty=0).alias("pct_positive"),
        percent(F.col("_negative"), n, empty=0).alias("pct_negative"),
        mean_money(F.col("_p"), n, empty=0).alias("avg_price"),
    )


def distribution(cells: DataFrame, by: str) -> DataFrame:
    return cells.groupBy(by).agg(_total().alias("reviews")).orderBy(by)


def share_within(cells: DataFrame, part: str, by: str = "sentiment") -> DataFrame:
    """Percent of each ``by`` value among the reviews of its ``part``."""
    counts = cells.groupBy(part, by).agg(_total().alias("reviews"))
    whole = F.sum("reviews").over(Window.partitionBy(part))
    return counts.withColumn("share", percent(F.col("reviews"), whole, 2)).orderBy(part, by)


def weighted_rating(cells: DataFrame, by: str) -> DataFrame:
    sums = cells.groupBy(by).agg(_total().alias("reviews"), _stars().alias("_s"))
    return sums.select(by, "reviews", ratio(F.col("_s"), F.col("reviews"), 2).alias("avg_rating")).orderBy("avg_rating", by)


def ranked_products(products: DataFrame, by: str, n: int = 10, category=None) -> DataFrame:
    """Most reviewed (``by='reviews'``) or lowest rated (``by='avg_rating'``) products."""
    order = F.desc(by) if by == "reviews" else F.asc(by)
    chosen = apply_filters(products, category=category)
    columns = ("product_name", "category", "reviews", "avg_rating", "pct_positive", "avg_price")
    return chosen.select(*columns).orderBy(order, "product_name", "category").limit(n)
