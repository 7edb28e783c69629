"""How often texts are moved and written: volumes that grow with the reviews."""

import os

import pytest

from plaudit.operators import features as X, words as W
from plaudit.plans import incremental as I, registry as Q
from plaudit.sources.raw import BRONZE_COLUMNS
from plaudit.sources.testdata import raw_reviews, spread
from plaudit.staging import fresh_path, staging_root, stage
from tests.conftest import SMALL, plan


def folders(spark) -> set[str]:
    return set(os.listdir(staging_root(spark)))


def with_column(spark, names, column) -> list[str]:
    """Those of the staged folders whose rows have the column."""
    root = staging_root(spark)
    tables = [n for n in names if any(f.endswith(".parquet") for f in os.listdir(f"{root}/{n}"))]
    return [n for n in tables if column in spark.read.parquet(f"{root}/{n}").columns]


@pytest.fixture
def small_splits(spark):
    """Files are read in more partitions than there are cores."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    spark.conf.set(names[0], "20000")
    spark.conf.set(names[1], "0")
    yield
    for name in names:
        spark.conf.unset(name)


def test_texts_of_large_input_are_not_dealt_out(spark, small_splits):
    found = raw_reviews(spark, SMALL).filter("length(summary) > 0")
    assert "Exchange rebalance" not in plan(found) and "REBALANCE" not in plan(found)


def test_few_partitions_are_dealt_out(spark):
    assert "REBALANCE" in plan(spread(spark.read.parquet(f"{SMALL}/documents.parquet"), "doc_id", "text"))


def test_staged_tables_are_packed_well(spark):
    before = folders(spark)
    assert stage(spark.range(5), "packed", "zstd").count() == 5
    (made,) = folders(spark) - before
    assert any(f.endswith(".zstd.parquet") or ".zstd" in f for f in os.listdir(f"{staging_root(spark)}/{made}"))


def test_fact_has_no_second_copy_of_the_texts(spark, monkeypatch):
    monkeypatch.setattr(Q, "_STORED", {})
    Q._silver(spark, SMALL)
    before = folders(spark)
    assert Q.dw_typed_fact(spark, SMALL).count() > 0
    assert with_column(spark, folders(spark) - before, "review_text") == []


def test_batch_writes_cleaned_texts_once(spark, tmp_path):
    raw = spark.createDataFrame(
        [(f"p{k}", "?10.0", str(1 + k % 5), "t", f"some words {k // 2}") for k in range(40)] * 2, ", ".join(f"{c} string" for c in BRONZE_COLUMNS)
    )
    root = fresh_path(spark, "batches")
    I.apply_batch(spark, root, raw.filter("rate < 4"), "first")
    before = folders(spark)
    version = I.apply_batch(spark, root, raw, "second")
    made = folders(spark) - before
    assert with_column(spark, made, "review_text") == []
    assert len(with_column(spark, made, "summary")) == 1
    silver = version.read("silver")
    assert silver.count() == 40 == silver.distinct().count()
    assert version.read("digests").count() == 40
    counts = {r["batch"]: (r["delivered"], r["distinct_rows"], r["added"], r["kept"]) for r in version.read("batches").collect()}
    assert counts == {"first": (48, 24, 24, 24), "second": (80, 40, 16, 16)}


def test_words_of_a_text_are_counted_in_small_partitions(spark):
    texts = spark.createDataFrame([(1, "a b a c"), (1, "a d"), (None, "b b"), (2, "c a")], "doc_id long, review_text string")
    weights = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 0.5)], "word string, idf double")
    dealt = X.by_text(texts, ["doc_id"])
    assert dealt.rdd.getNumPartitions() >= 16 * texts.rdd.getNumPartitions()
    found = X.tfidf(W.split_words(dealt, ["doc_id"]), weights, ["doc_id"])
    made = sorted((tuple(r) for r in found.collect()), key=repr)
    assert made == sorted([(1, "a", 3, 3.0), (1, "b", 1, 2.0), (1, "c", 1, 0.5), (None, "b", 2, 4.0), (2, "c", 1, 0.5), (2, "a", 1, 1.0)], key=repr)


def test_tfidf_moves_texts_and_not_their_words(spark):
    text = plan(Q.ml_tfidf(spark, SMALL))
    assert text.count("Exchange hashpartitioning(doc_id") == 1 and "word" not in text.split("Exchange hashpartitioning(doc_id")[1].split("\n")[0]
