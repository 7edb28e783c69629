"""Adapter: the generated test tables seen as review tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plaudit.functions.rules import band_of, sentiment_of
from plaudit.sources.raw import BRONZE_COLUMNS, CSV_OPTIONS, RAW_NAMES

# category rules that fit the product names of the test tables
TEST_RULES = (
    (r"\bplate\b|\bring\b", "Kitchen"),
    (r"bolt|rod|gear", "Hardware"),
    (r"^blue|gizmo|widget", "Gadgets"),
)

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(source: DataFrame, *columns: str) -> DataFrame:
    """Columns of a stored table in even partitions.  Files that are read in fewer partitions
    than there are cores, like the few row groups of the test files, are dealt out; larger input
    stays in the partitions it is read in, as dealing it out would move every text once more."""
    read = source.select(*columns)
    if read.rdd.getNumPartitions() > source.sparkSession.sparkContext.defaultParallelism:
        return read
    return read.hint("rebalance")


def numbered_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dirty review per document, with its ``doc_id``."""
    d, p, l = (table(spark, sf_dir, name) for name in ("documents", "part", "labels"))
    key = F.col("doc_id")
    # reviews go round all parts
    parts = p.agg(F.count(F.lit(1)).alias("n")).scalar()
    p = p.select(F.col("p_partkey").alias("_part"), F.concat_ws(" ", "p_name", "p_brand").alias("product_name"), "p_retailprice")
    factor = F.when(key % 12 == 0, F.lit(0.5)).otherwise((key % 12).cast("double"))
    amount = (F.col("p_retailprice") * factor).cast("decimal(12,2)").cast("string")
    rating = (
        F.when(F.col("toxic") == 1, F.lit(1))
        .when(F.col("quality") == 0, 2 + key % 2)
        .when(F.col("quality") == 1, 4 + key % 2)
        .otherwise(1 + key % 5)
    )
    return (
        spread(d, "doc_id", "text", "source")
        .withColumn("_part", key % parts)
        .join(p, "_part")
        .join(l, "doc_id", "left")
        .select(
            "doc_id",
            "product_name",
            F.when(key % 101 == 0, F.lit("N/A")).otherwise(F.concat(F.lit("?"), amount)).alias("price"),
            F.when(key % 97 == 0, F.lit("broken")).otherwise(rating.cast("string")).alias("rate"),
            F.when(key % 11 == 0, F.lit("Nan")).otherwise(F.col("source")).alias("review_title"),
            F.when(key % 89 == 0, F.lit("!!")).otherwise(F.col("text")).alias("summary"),
        )
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped reviews in which every eighth one was delivered twice."""
    deliveries = F.when(F.col("doc_id") % 8 == 0, F.lit(2)).otherwise(F.lit(1))
    return (
        numbered_reviews(spark, sf_dir)
        .withColumn("_delivery", F.explode(F.sequence(F.lit(1), deliveries)))
        .select(*BRONZE_COLUMNS)
    )


def malformed_csv(reviews: DataFrame, path: str, short: Column, surplus: Column) -> None:
    """CSV files in which the rows that meet ``short`` lack their last field and those that meet
    ``surplus`` have one more."""
    parts = int(reviews.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    options = {**CSV_OPTIONS, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    whole, cut = (F.to_csv(F.struct(*names), options) for names in (BRONZE_COLUMNS, BRONZE_COLUMNS[:-1]))
    line = F.when(short, cut).when(surplus, F.concat(whole, F.lit(",more"))).otherwise(whole)
    rows = reviews.select(line.alias("line"), F.pmod(F.monotonically_increasing_id(), F.lit(parts)).alias("part"), F.lit(1).alias("_order"))
    heads = reviews.sparkSession.range(parts).select(F.lit(",".join(RAW_NAMES)).alias("line"), F.col("id").alias("part"), F.lit(0).alias("_order"))
    dealt = rows.unionByName(heads).repartition(parts, "part").sortWithinPartitions("part", "_order")
    dealt.select("line", "part").write.partitionBy("part").text(path)


def line_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped numeric reviews, one per order line, with the date they arrived."""
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    rating = (1 + F.col("l_quantity").cast("int") % 5).cast("int")
    lines = spread(lines, "l_partkey", "l_quantity", "l_extendedprice", "l_linenumber", "l_shipdate")
    return lines.join(parts, F.col("p_partkey") == F.col("l_partkey")).select(
        F.concat_ws(" ", "p_name", "p_brand").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("l_extendedprice").alias("price"),
        band_of(F.col("l_extendedprice")).alias("price_band"),
        rating.alias("rating"),
        sentiment_of(rating).alias("sentiment"),
        (F.length("p_name") * F.col("l_linenumber")).cast("int").alias("word_count"),
        F.col("l_shipdate").alias("received_at"),
    )


def predictions(silver: DataFrame) -> DataFrame:
    """Deterministic class pairs for the metric operators."""
    guess = 1 + (F.col("rating") * 7 + F.col("word_count")) % 5
    return silver.select(F.col("sentiment").alias("actual"), sentiment_of(guess).alias("predicted"))


def timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event durations seen as timed runs of one configuration per event type."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("engine"),
        F.col("user_id").alias("rows"),
        F.col("value").alias("seconds"),
    )
