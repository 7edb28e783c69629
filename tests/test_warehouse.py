import pytest
from pyspark.sql import functions as F

from plaudit.operators import cube as K
from plaudit.operators import merge as M
from plaudit.operators import quality as Q
from plaudit.operators import star as S
from plaudit.plans import catalog, named
from plaudit.plans.refresh import build_marts, old_marts
from plaudit.plans.silver import to_silver
from plaudit.sources.tables import load_marts, read_table, open_inputs, save_tables, write_table
from plaudit.sources.testdata import TEST_RULES, line_reviews, raw_reviews
from plaudit.staging import stage

from .conftest import SMALL, plan


@pytest.fixture(scope="module")
def silver(spark):
    return stage(to_silver(raw_reviews(spark, SMALL), rules=TEST_RULES), "silver")


@pytest.fixture(scope="module")
def star(spark, silver):
    return {name: stage(df, name) for name, df in S.build_star(silver).items()}


def test_star_has_one_fact_per_review_and_no_orphans(silver, star):
    assert star["fact_reviews"].count() == silver.count()
    assert Q.orphans(star["fact_reviews"], star["dim_product"], ["product_key"]).first()["orphans"] == 0


def test_keys_do_not_depend_on_layout(silver, star, rows):
    again = S.build_star(silver.repartition(7, "rating"))
    for name in ("dim_category", "dim_product", "dim_price_band"):
        assert rows(again[name]) == rows(star[name])


def test_keyed_fact_is_typed_unique_and_passes_its_rules(star):
    fact = S.keyed_fact(star["fact_reviews"])
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in S.FACT_SCHEMA]
    report = Q.check_constraints(fact, S.fact_rules(), unique=["review_key"])
    assert report.filter("violations > 0").collect() == []


def test_missing_product_name_is_an_orphan_or_the_unknown_member(spark, silver):
    nameless = silver.withColumn("product_name", F.when(F.col("rating") == 5, None).otherwise(F.col("product_name")))
    lost = nameless.filter("product_name is null").count()
    assert lost > 0
    assert S.build_star(nameless)["fact_reviews"].count() == silver.count() - lost
    assert S.build_star(nameless, unknown_product="unknown")["fact_reviews"].count() == silver.count()


def test_named_queries_run_over_views(spark, star, rows):
    named.register_star({**star, "gold_model_metrics": spark.createDataFrame([("m", "accuracy", 0.5)], "model string, metric string, value double")})
    for name, params in {"q05": {"n": 3}, "q06": {"min_reviews": 1, "n": 2}, "q09": {"min_reviews": 1}, "q10": {}}.items():
        assert named.run_named(spark, name, **params).count() >= 1
    free = named.run_sql_catalogue(spark, "x\n-- name: 1. Rows\nSELECT count(*) AS n\nFROM fact_reviews;\n\n-- name: 2. One\nSELECT 1 AS one;\n")
    assert list(free) == ["1. Rows", "2. One"]
    assert free["1. Rows"].first()["n"] == star["fact_reviews"].count()


def test_best_products_keep_equals(spark):
    star = {
        "dim_category": spark.createDataFrame([(1, "c")], "category_key int, category_name string"),
        "dim_product": spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "z", 1)], "product_key int, product_name string, category_key int"),
        "fact_reviews": spark.createDataFrame([(k, r, 1, 1.0) for k, r in [(1, 5), (2, 5), (3, 1)]], "product_key int, rating int, word_count int, price double"),
    }
    assert [r["product"] for r in named.q09(star, min_reviews=1).collect()] == ["a", "b"]


def test_facts_are_summed_up_before_the_product_join(star):
    text = plan(named.q01(star))
    fact_side = text[text.index("fact_reviews") - 2000 : text.index("fact_reviews")] if "fact_reviews" in text else text
    assert "partial_count(1)" in fact_side
    assert text.index("Join") < text.index("partial_count(1)")


def test_upsert_keeps_ids_and_is_idempotent(spark, rows):
    empty = spark.createDataFrame([], "id long, name string")
    first = stage(M.upsert_dim(empty, spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "name string"), "id", "name"), "d")
    assert rows(first) == [(1, "a"), (2, "b")]
    second = stage(M.upsert_dim(first, spark.createDataFrame([("aa",), ("b",)], "name string"), "id", "name"), "d")
    assert rows(second) == [(1, "a"), (2, "b"), (3, "aa")]
    assert rows(M.upsert_dim(second, second, "id", "name")) == rows(second)


def test_product_merge_takes_the_new_category(spark, rows):
    old = spark.createDataFrame([(5, "p", 1), (6, "q", 1)], "product_id long, product_name string, category_id long")
    new = spark.createDataFrame([("p", 2), ("n", 3)], "product_name string, category_id long")
    assert rows(M.merge_products(old, new)) == [(5, "p", 2), (6, "q", 1), (7, "n", 3)]


def test_product_in_two_categories_has_one_summary(spark):
    data = [("p", "x", 5, "positive", 10.0)] * 3 + [("p", "y", 2, "negative", 30.0)] * 2 + [("q", "b", 3, "neutral", 1.0)] * 2 + [("q", "a", 3, "neutral", 1.0)] * 2
    df = spark.createDataFrame(data, "product_name string, category string, rating int, sentiment string, price double")
    totals = K.product_totals(df, 1)
    assert sorted(tuple(r) for r in M.leading_category(totals).collect()) == [("p", "x"), ("q", "a")]
    dim = spark.createDataFrame([(1, "p"), (2, "q")], "product_id long, product_name string")
    summary = {r["product_id"]: r for r in M.load_product_fact(totals, dim).collect()}
    assert (summary[1]["review_count"], float(summary[1]["average_rating"]), float(summary[1]["positive_percent"])) == (5, 3.8, 60.0)
    assert float(summary[1]["average_price"]) == 18.0


def test_marts_built_twice_keep_their_ids(spark, rows):
    lines = line_reviews(spark, SMALL)
    cells, totals = stage(K.cube(lines), "cells"), stage(K.product_totals(lines, 20), "totals")
    first = {n: stage(df, n) for n, df in build_marts(old_marts(spark, None), cells, totals).items()}
    again = build_marts(first, cells, totals)
    for name in first:
        assert rows(again[name]) == rows(first[name])
    assert first["fact_review_aggregate"].agg(F.sum("review_count")).first()[0] == lines.count()
    named_cells = M.named_cube(first["fact_review_aggregate"], first)
    assert rows(named_cells) == rows(cells.select(*named_cells.columns))


def test_rating_insert(spark, rows):
    old = spark.createDataFrame([(5,), (1,)], "rating int")
    cells = spark.createDataFrame([(1,), (3,), (3,)], "rating int")
    assert rows(M.insert_ratings(old, cells)) == [(1,), (3,), (5,)]


def folders_of(spark, table):
    files = spark.table(table).select("category", F.col("_metadata.file_path").alias("f")).distinct().collect()
    found = {}
    for r in files:
        found.setdefault(r["category"], set()).add(r["f"])
    return found


def test_only_changed_folders_are_written(spark, rows):
    schema = "name string, price double, category string"
    first = [("a", 1.0, "x"), ("a", 1.0, "x"), ("b", 2.0, "y"), ("c", 3.0, "it's"), ("d", None, None), ("e", 5.0, "gone")]
    stored = catalog.publish_partitioned(stage(spark.createDataFrame(first, schema), "first"), "review_db.changing")
    assert rows(stored) == sorted(first, key=repr)
    before = folders_of(spark, "review_db.changing")
    # y: another value; x: one copy less; it's: gone; null: same rows, written as an empty string; new: added
    second = [("a", 1.0, "x"), ("b", 2.5, "y"), ("d", None, ""), ("e", 5.0, "gone"), ("f", 6.0, "new")]
    df = stage(spark.createDataFrame(second, schema), "second")
    assert catalog.replace_changed(df, "review_db.changing") == ["it's", "new", "x", "y"]
    after = folders_of(spark, "review_db.changing")
    assert rows(spark.table("review_db.changing")) == sorted([("d", None, None) if r[0] == "d" else r for r in second], key=repr)
    assert after[None] == before[None] and after["gone"] == before["gone"]
    assert not after["x"] & before["x"] and not after["y"] & before["y"] and "it's" not in after
    assert catalog.replace_changed(df.select("category", "price", "name"), "review_db.changing") == []
    assert folders_of(spark, "review_db.changing") == after
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"
    assert catalog.replace_changed(df.limit(0), "review_db.changing") == [None, "gone", "new", "x", "y"]
    assert spark.table("review_db.changing").count() == 0
    with pytest.raises(ValueError, match="other columns"):
        catalog.replace_changed(df.drop("price"), "review_db.changing")


def test_partitioned_table(spark, silver):
    reviews = catalog.save_partitioned(silver.select(*catalog.REVIEW_COLUMNS), "review_db.reviews")
    assert reviews.count() == silver.count()
    folders = [r["partition"] for r in catalog.list_partitions(spark, "review_db.reviews").collect()]
    assert folders == ["category=Gadgets", "category=Hardware", "category=Kitchen", "category=Other"]
    assert "reviews" in [r["tableName"] for r in catalog.list_tables(spark, "review_db").collect()]
    assert "category" in [r["col_name"] for r in catalog.describe(spark, "review_db.reviews").collect()]
    one = named.hive_q4({"reviews": reviews}, category="Kitchen")
    assert one.first()[0] == silver.filter("category = 'Kitchen'").count()
    scan = [line for line in plan(one).splitlines() if "FileScan" in line][0]
    assert "PartitionFilters: [isnotnull(category" in scan and "ReadSchema: struct<>" in scan


def test_star_as_catalog_tables(spark, star, rows):
    save_tables(star, "star_db")
    save_tables(star, "star_db")
    for name, df in star.items():
        assert rows(spark.table(f"star_db.{name}")) == rows(df)


def test_tables_and_marts(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, "x")], "a int, b double, c string")
    write_table(df, f"{tmp_path}/t", stamp=True)
    back = read_table(spark, f"{tmp_path}/t", columns=["a", "refreshed_at"])
    assert back.first()["refreshed_at"] is not None
    with pytest.raises(FileNotFoundError, match="absent"):
        open_inputs(spark, [f"{tmp_path}/t", f"{tmp_path}/absent"])
    for name in ("products", "model_weights"):
        write_table(df, f"{tmp_path}/{name}", format="csv")
    assert load_marts(spark, str(tmp_path), ["products", "model_weights"]) == ["gold_products"]
    assert [f.dataType.simpleString() for f in spark.table("gold_products").schema] == ["int", "double", "string"]
