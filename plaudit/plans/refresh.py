"""The whole refresh, stage after stage in one session."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from plaudit.functions.rules import CATEGORY_RULES, SENTIMENTS
from plaudit.operators import cube as K
from plaudit.operators import merge as M
from plaudit.operators import words as W
from plaudit.operators.quality import assert_written, check_constraints, load_counts, orphans, quality_funnel
from plaudit.operators.star import STAR_TABLES, build_dims, build_fact, fact_rules, keyed_fact
from plaudit.plans import model as ML, named
from plaudit.plans.catalog import publish_partitioned
from plaudit.plans.silver import to_silver
from plaudit.sources.raw import BRONZE_COLUMNS
from plaudit.sources.rejects import MARKED_COLUMNS, kept, lost_records, raw_lines, rejects
from plaudit.sources.tables import read_table, read_tables, save_tables, write_table, write_tables
from plaudit.staging import stage
from plaudit.streaming.ingest import ingest_new

MART_DIM_SCHEMAS = {
    "dim_category": "category_id long, category_name string",
    "dim_price_band": "price_band_id long, price_band_name string",
    "dim_sentiment": "sentiment_id long, sentiment_name string",
    "dim_product": "product_id long, product_name string, category_id long",
    "dim_rating": "rating int",
}


@dataclass
class Refresh:
    """Where to read and write, and the thresholds of the marts."""

    raw: str
    out: str
    previous: str | None = None  # folder of an earlier refresh whose mart ids are kept
    rules: tuple = CATEGORY_RULES
    min_reviews: int = 100
    min_word_uses: int = 300
    model: dict = field(default_factory=dict)
    database: str | None = None  # catalog database of the gold tables and the partitioned reviews


class RefreshFailed(AssertionError):
    """A table that was just written breaks its rules."""


def checked(report: DataFrame) -> DataFrame:
    """The report (rule, violations), if nothing is violated."""
    broken = report.filter("violations > 0").collect()
    if broken:
        raise RefreshFailed("; ".join(f"{r['rule']}: {r['violations']}" for r in broken))
    return report


def bronze(spark: SparkSession, job: Refresh) -> DataFrame:
    """Append new raw files.  Bronze grows across refreshes, so it sits beside them.  The records
    that are no reviews are written to ``rejects``."""
    ingest_new(spark, job.raw, f"{job.raw.rstrip('/')}-bronze", f"{job.raw.rstrip('/')}-ingested")
    stored = marked_bronze(spark, job)
    if not set(BRONZE_COLUMNS) <= set(stored.columns) or stored.isEmpty():
        raise RefreshFailed(f"bronze holds no rows or lacks columns: {stored.columns}")
    write_table(rejects(stored), f"{job.out}/rejects")
    return kept(stored)


def marked_bronze(spark: SparkSession, job: Refresh) -> DataFrame:
    """All ingested records.  Files of a bronze table from before there were marks lack the
    columns of the marks, which are null then."""
    stored = read_table(spark, f"{job.raw.rstrip('/')}-bronze")
    if not set(BRONZE_COLUMNS) <= set(stored.columns):
        return stored
    return spark.read.schema(", ".join(f"{name} string" for name in MARKED_COLUMNS)).parquet(f"{job.raw.rstrip('/')}-bronze")


def silver(spark: SparkSession, job: Refresh, raw: DataFrame) -> DataFrame:
    write_table(quality_funnel(raw), f"{job.out}/quality_report", format="csv")
    clean = to_silver(raw, rules=job.rules)
    write_table(clean, f"{job.out}/silver")
    stored = read_table(spark, f"{job.out}/silver")
    assert_written(stored, clean)
    return stored


def gold(spark: SparkSession, job: Refresh, reviews: DataFrame) -> dict[str, DataFrame]:
    """Marts.  Texts are split once and products summed once; what several marts need
    is written first and read back."""
    folder = f"{job.out}/gold"
    bases = {
        "cube": K.cube(reviews),
        "product_totals": K.product_totals(reviews, job.min_reviews),
        "words": W.word_pivot(W.tokens(reviews)),
    }
    write_tables(bases, folder)
    bases = read_tables(spark, folder, bases)
    marts = {
        "products": K.ordered(K.rated(bases["product_totals"])),
        "top_words": W.top_words(W.counts_from_pivot(bases["words"])),
        "word_signals": W.word_signals(bases["words"], job.min_word_uses),
    }
    write_tables(marts, folder)
    return {**bases, **read_tables(spark, folder, marts)}


def models(spark: SparkSession, job: Refresh, reviews: DataFrame) -> dict[str, DataFrame]:
    three, predicted = ML.train_and_test(reviews, SENTIMENTS, **job.model)
    _, predicted_two = ML.train_and_test(reviews, ML.TWO_CLASSES, **job.model)
    tables = ML.evaluate(predicted, "3-class")
    two = ML.evaluate(predicted_two, "2-class", ML.TWO_CLASSES)
    tables["model_metrics"] = tables["model_metrics"].unionByName(two["model_metrics"])
    write_tables(tables, f"{job.out}/gold")
    ML.save_weights(*ML.export_weights(three, spark), f"{job.out}/gold")
    return read_tables(spark, f"{job.out}/gold", tables)


def star(spark: SparkSession, job: Refresh, reviews: DataFrame) -> dict[str, DataFrame]:
    """Dimensions are written first, so that the fact joins see their real size."""
    folder = f"{job.out}/star"
    dims = build_dims(reviews)
    write_tables(dims, folder)
    dims = read_tables(spark, folder, dims)
    write_table(keyed_fact(build_fact(reviews, dims)), f"{folder}/fact_reviews")
    return {**dims, **read_tables(spark, folder, ["fact_reviews"])}


def star_checks(star: dict[str, DataFrame], reviews: DataFrame) -> DataFrame:
    """Row rules, the key, rows without their dimension row, and reviews that the inner
    joins with the dimensions lost."""
    fact = star["fact_reviews"]
    report = check_constraints(fact, fact_rules(), ["review_key"])
    for table, key in (("dim_product", "product_key"), ("dim_price_band", "price_band_key"), ("dim_sentiment", "sentiment_key")):
        found = orphans(fact, star[table], [key])
        report = report.unionByName(found.select(F.lit(f"orphans of {table}").alias("rule"), F.col("orphans").alias("violations")))
    named_reviews = reviews.filter(F.col("product_name").isNotNull()).agg(F.count(F.lit(1)).alias("n")).scalar()
    lost = fact.agg((named_reviews - F.count(F.lit(1))).alias("violations"))
    return report.unionByName(lost.select(F.lit("reviews without a fact row").alias("rule"), "violations"))


def publish(spark: SparkSession, job: Refresh, gold_tables: dict[str, DataFrame], reviews: DataFrame) -> None:
    """Gold tables and the partitioned reviews in the catalog."""
    save_tables({f"gold_{name}": df for name, df in gold_tables.items() if name not in ("cube", "words", "product_totals")}, job.database)
    publish_partitioned(reviews, f"{job.database}.reviews")


def analyses(spark: SparkSession, job: Refresh, star: dict[str, DataFrame], metrics: DataFrame) -> None:
    """Answers of the ten named analyses."""
    named.register_star({name: star[name] for name in STAR_TABLES})
    metrics.createOrReplaceTempView("gold_model_metrics")
    for n in range(1, 11):
        write_table(named.run_named(spark, f"q{n:02d}"), f"{job.out}/analyses/q{n:02d}")


def old_marts(spark: SparkSession, previous: str | None) -> dict[str, DataFrame]:
    if previous:
        return read_tables(spark, f"{previous}/marts", MART_DIM_SCHEMAS)
    return {name: spark.createDataFrame([], schema) for name, schema in MART_DIM_SCHEMAS.items()}


def build_marts(old: dict[str, DataFrame], cells: DataFrame, totals: DataFrame) -> dict[str, DataFrame]:
    """New versions of the aggregate warehouse tables; ids in ``old`` are kept.

    Both inputs are small beside the reviews and read by several tables, so they are
    written once first.
    """
    cells, totals = stage(cells, "cells"), stage(totals, "totals")
    dims = {}
    for column, (table, key, name) in M.MART_DIMS.items():
        dims[table] = M.upsert_dim(old[table], cells.withColumnRenamed(column, name), key, name)
    led = M.leading_category(totals).withColumnRenamed("category", "category_name")
    new_products = led.join(dims["dim_category"], "category_name").select("product_name", "category_id")
    dims["dim_product"] = M.merge_products(old["dim_product"], new_products)
    dims["dim_rating"] = M.insert_ratings(old["dim_rating"], cells)
    return {
        **dims,
        "fact_review_aggregate": M.load_aggregate_fact(cells, dims),
        "fact_product_summary": M.load_product_fact(totals, dims["dim_product"]),
    }


def marts(spark: SparkSession, job: Refresh, cells: DataFrame, totals: DataFrame) -> dict[str, DataFrame]:
    tables = build_marts(old_marts(spark, job.previous), cells, totals)
    write_tables(tables, f"{job.out}/marts", stamp=("fact_review_aggregate", "fact_product_summary"))
    return read_tables(spark, f"{job.out}/marts", tables)


def refresh(spark: SparkSession, job: Refresh) -> dict[str, DataFrame]:
    """Bronze, silver, gold, models, warehouse; a failing stage ends the run."""
    reviews = silver(spark, job, bronze(spark, job))
    tables = {"silver": reviews}
    gold_tables = {**gold(spark, job, reviews), **models(spark, job, reviews)}
    tables.update(gold_tables)
    if job.database:
        publish(spark, job, gold_tables, reviews)
    stars = star(spark, job, reviews)
    delivered = lost_records(raw_lines(spark, job.raw), marked_bronze(spark, job))
    write_table(star_checks(stars, reviews).unionByName(delivered), f"{job.out}/checks")
    checks = checked(read_table(spark, f"{job.out}/checks"))
    analyses(spark, job, stars, tables["model_metrics"])
    tables.update({f"star.{k}": v for k, v in stars.items()})
    tables.update({f"mart.{k}": v for k, v in marts(spark, job, tables["cube"], tables["product_totals"]).items()})
    tables["load_counts"] = load_counts(dict(tables))
    tables["checks"] = checks
    return tables
