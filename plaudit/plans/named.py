"""The named analyses over the star schema and over the partitioned review table.

Facts are summed up per surrogate key before any join, so a join moves one row per
product, band or sentiment instead of one per review, and a popular product is one
row like any other.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from plaudit.functions.rounding import MONEY, mean_money, percent, ratio
from plaudit.operators.star import STAR_TABLES
from plaudit.sources.tables import register

Star = Mapping[str, DataFrame]


def _n():
    return F.sum("n").alias("reviews")


def _per(fact: DataFrame, *keys: str) -> DataFrame:
    return fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("rating").cast("long")).alias("stars"),
        F.sum(F.col("word_count").cast("long")).alias("words"),
        F.sum(F.col("price").cast(MONEY)).alias("money"),
    )


def _avg_rating(n: str = "reviews"):
    return ratio(F.col("stars"), F.col(n), 2).alias("avg_rating")


def _with_products(per_product: DataFrame, star: Star) -> DataFrame:
    return per_product.join(star["dim_product"], "product_key").join(star["dim_category"], "category_key")


def _stars():
    return F.sum("stars").alias("stars")


def _share(sentiment: str):
    return F.sum(F.when(F.col("sentiment") == sentiment, F.col("n")).otherwise(F.lit(0))).alias(sentiment)


def q01(star: Star) -> DataFrame:
    """Reviews and average rating by category."""
    rows = _with_products(_per(star["fact_reviews"], "product_key"), star)
    return (
        rows.groupBy("category_name")
        .agg(_n(), _stars())
        .select("category_name", "reviews", _avg_rating())
        .orderBy(F.desc("reviews"), "category_name")
    )


def q02(star: Star) -> DataFrame:
    """Sentiment share by category."""
    rows = _with_products(_per(star["fact_reviews"], "product_key", "sentiment_key"), star)
    names = ("positive", "neutral", "negative")
    return (
        rows.join(star["dim_sentiment"], "sentiment_key")
        .groupBy("category_name")
        .agg(_n(), *[_share(s) for s in names])
        .select("category_name", *[percent(F.col(s), F.col("reviews")).alias(f"pct_{s}") for s in names])
        .orderBy(F.desc_nulls_last("pct_positive"), "category_name")
    )


def q03(star: Star) -> DataFrame:
    """Rating and review length by price band."""
    rows = _per(star["fact_reviews"], "price_band_key").withColumnRenamed("n", "reviews")
    return (
        rows.join(star["dim_price_band"], "price_band_key")
        .select("price_band", "reviews", _avg_rating(), ratio(F.col("words"), F.col("reviews"), 1).alias("avg_words"))
        .orderBy("price_band")
    )


def q04(star: Star) -> DataFrame:
    """Rating distribution with percent of all reviews."""
    counts = star["fact_reviews"].groupBy("rating").agg(F.count(F.lit(1)).alias("reviews"))
    # one row per rating
    everything = F.sum("reviews").over(Window.partitionBy())
    return counts.withColumn("pct", percent(F.col("reviews"), everything)).orderBy("rating")


def q05(star: Star, n: int = 10) -> DataFrame:
    """Most reviewed products."""
    rows = _with_products(_per(star["fact_reviews"], "product_key"), star)
    return (
        rows.groupBy("product_name", "category_name")
        .agg(_n(), _stars())
        .orderBy(F.desc("reviews"), "product_name", "category_name")
        .limit(n)
        .select(F.left("product_name", F.lit(60)).alias("product"), "category_name", "reviews", _avg_rating())
    )


def q06(star: Star, min_reviews: int = 200, n: int = 10) -> DataFrame:
    """Products with the highest share of negative reviews."""
    per_product = _per(star["fact_reviews"], "product_key", "sentiment_key")
    return (
        per_product.join(star["dim_product"], "product_key")
        .join(star["dim_sentiment"], "sentiment_key")
        .groupBy("product_name")
        .agg(_n(), _share("negative"))
        .filter(F.col("reviews") >= min_reviews)
        .withColumn("pct_negative", percent(F.col("negative"), F.col("reviews")))
        .orderBy(F.desc_nulls_last("pct_negative"), "product_name")
        .limit(n)
        .select(F.left("product_name", F.lit(60)).alias("product"), "reviews", "pct_negative")
    )


def q07(star: Star, min_reviews: int = 100) -> DataFrame:
    """Average rating by category and price band."""
    rows = _with_products(_per(star["fact_reviews"], "product_key", "price_band_key"), star)
    return (
        rows.join(star["dim_price_band"], "price_band_key")
        .groupBy("category_name", "price_band")
        .agg(_n(), _stars())
        .filter(F.col("reviews") >= min_reviews)
        .select("category_name", "price_band", "reviews", _avg_rating())
        .orderBy("category_name", "price_band")
    )


def q08(star: Star) -> DataFrame:
    """Review length and price by sentiment."""
    rows = _per(star["fact_reviews"], "sentiment_key").withColumnRenamed("n", "reviews")
    return (
        rows.join(star["dim_sentiment"], "sentiment_key")
        .select(
            "sentiment",
            "reviews",
            ratio(F.col("words"), F.col("reviews"), 1).alias("avg_words"),
            mean_money(F.col("money"), F.col("reviews")).alias("avg_price"),
        )
        .orderBy("sentiment")
    )


def q09(star: Star, min_reviews: int = 100) -> DataFrame:
    """Best rated products of each category, equals included."""
    rows = _with_products(_per(star["fact_reviews"], "product_key"), star)
    best = F.rank().over(Window.partitionBy("category_name").orderBy(F.desc("avg_rating"), F.desc("reviews")))
    return (
        rows.groupBy("category_name", "product_name")
        .agg(_n(), _stars())
        .filter(F.col("reviews") >= min_reviews)
        .withColumn("avg_rating", _avg_rating())
        .withColumn("_rank", best)
        .filter(F.col("_rank") == 1)
        .select("category_name", F.left("product_name", F.lit(55)).alias("product"), "reviews", "avg_rating")
        .orderBy("category_name", "product")
    )


def q10(star: Star) -> DataFrame:
    """Stored model metrics."""
    return star["gold_model_metrics"].select("model", "metric", "value").orderBy("model", "metric")


def _review_share(sentiment: str):
    return F.count_if(F.col("sentiment") == sentiment).alias(sentiment)


def _summed(reviews: DataFrame, *by: str) -> DataFrame:
    return reviews.groupBy(*by).agg(
        F.count(F.lit(1)).alias("reviews"),
        F.sum(F.col("rating").cast("long")).alias("stars"),
        _review_share("positive"),
        _review_share("negative"),
    )


def _pct(sentiment: str):
    return percent(F.col(sentiment), F.col("reviews")).alias(f"pct_{sentiment}")


def hive_q1(tables: Star) -> DataFrame:
    """Rating and sentiment share by category."""
    return (
        _summed(tables["reviews"], "category")
        .select("category", "reviews", _avg_rating(), _pct("positive"), _pct("negative"))
        .orderBy(F.desc("reviews"), "category")
    )


def hive_q2(tables: Star) -> DataFrame:
    """Rating and sentiment by price band."""
    return (
        _summed(tables["reviews"], "price_band")
        .select("price_band", "reviews", _avg_rating(), _pct("positive"))
        .orderBy("price_band")
    )


def hive_q3(tables: Star, n: int = 10) -> DataFrame:
    """Most reviewed products."""
    return (
        _summed(tables["reviews"], "product_name", "category")
        .select("product_name", "category", "reviews", _avg_rating())
        .orderBy(F.desc("reviews"), "product_name", "category")
        .limit(n)
    )


def hive_q4(tables: Star, category: str = "Appliances") -> DataFrame:
    """Reviews of one category; reads that partition only."""
    return tables["reviews"].filter(F.col("category") == category).agg(F.count(F.lit(1)).alias("reviews"))


NAMED: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f for f in (q01, q02, q03, q04, q05, q06, q07, q08, q09, q10, hive_q1, hive_q2, hive_q3, hive_q4)
}


def register_star(star: Star) -> None:
    """Make the star available as temp views, for ``run_named`` and for free SQL."""
    register(dict(star))


def run_named(spark: SparkSession, name: str, **params) -> DataFrame:
    """Run one named analysis over the registered tables."""
    if name.startswith("hive"):
        needed = ("reviews",)
    elif name == "q10":
        needed = ("gold_model_metrics",)
    else:
        needed = STAR_TABLES
    return NAMED[name]({table: spark.table(table) for table in needed}, **params)


def run_sql_catalogue(spark: SparkSession, text: str, marker: str = "-- name:") -> dict[str, DataFrame]:
    """Run a file of SQL statements, each introduced by a title line."""
    found: dict[str, list[str]] = {}
    title = None
    for line in text.splitlines():
        if line.startswith(marker):
            title = line[len(marker) :].strip()
            found[title] = []
        elif title is not None:
            found[title].append(line)
    return {title: spark.sql("\n".join(lines).strip().rstrip(";")) for title, lines in found.items()}
