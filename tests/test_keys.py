import random

import pytest
from pyspark.sql import functions as F

from plaudit import staging
from plaudit.operators.keys import content_key, dense_key
from plaudit.operators.star import build_fact, build_star

from .conftest import plan


@pytest.mark.parametrize("parts", [1, 7])
def test_dense_key_equals_a_global_row_number(spark, parts):
    # one prefix holds most names
    names = [f"men black shirt {i:05d}" for i in range(3000)] + ["", "a", "Zed", "éclair", "?x", "men"]
    random.Random(3).shuffle(names)
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(parts)
    got = {r["name"]: r["key"] for r in dense_key(df, ["name"], "key").collect()}
    assert got == {n: i for i, n in enumerate(sorted(names, key=lambda n: n.encode()), start=1)}


def test_dense_key_continues_after_a_given_number(spark, rows):
    df = spark.createDataFrame([("b",), ("a",)], "name string")
    old = spark.createDataFrame([(41,), (7,)], "id long")
    assert rows(dense_key(df, ["name"], "id", after=old.agg(F.max("id").alias("m")).scalar())) == [(42, "a"), (43, "b")]
    assert dense_key(df.filter("name > 'z'"), ["name"], "id").count() == 0


def test_dense_key_has_no_single_task_over_the_names(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("name"))
    text = plan(dense_key(df, ["name"], "key"))
    for branch in text.split("Exchange SinglePartition")[1:]:
        assert "_part" in branch and "name#" not in branch.split("HashAggregate(keys=[_groupingexpression")[0]


@pytest.mark.parametrize("chunk", [4, 100_000])
def test_content_key_numbers_every_row_once_in_any_layout(spark, rows, chunk):
    data = [("hot", 1.5)] * 50 + [("warm", None)] * 5 + [(f"x{i}", float(i)) for i in range(200)] + [(None, 2.0)]
    df = spark.createDataFrame(data, "t string, p double")
    one = content_key(df.repartition(1), name="k", bucket_chars=1, chunk=chunk)
    many = content_key(df.repartition(7, "p"), name="k", bucket_chars=1, chunk=chunk)
    assert rows(one) == rows(many)
    assert sorted(r["k"] for r in one.collect()) == list(range(1, len(data) + 1))
    assert rows(one.drop("k")) == sorted(data, key=repr)


def test_content_key_splits_only_the_crowded_buckets(spark, rows):
    plain = spark.range(300).select(F.col("id").cast("string").alias("t"))
    assert "Union" not in plan(content_key(plain, chunk=100))
    hot = plain.unionByName(spark.range(5000).select(F.lit("hot").alias("t")))
    keyed = content_key(hot, chunk=100)
    assert "LeftSemi" in plan(keyed)
    assert sorted(r["review_key"] for r in keyed.collect()) == list(range(1, 5301))
    hot_keys = sorted(r["review_key"] for r in keyed.filter("t = 'hot'").collect())
    assert hot_keys == list(range(hot_keys[0], hot_keys[0] + 5000))
    assert content_key(plain.filter("t = 'none'")).count() == 0


def test_staging_uses_the_folder_of_the_session(spark):
    assert staging.staging_root(spark) == spark.conf.get("spark.checkpoint.dir")
    df = spark.createDataFrame([(1, None)], "a int, b string")
    back = staging.stage(df, "case")
    assert back.collect() == df.collect() and back.schema == df.schema
    assert all(staging.staging_root(spark) in name for name in back.inputFiles())


def test_hot_product_is_split_in_the_fact_join(spark):
    """A third of all rows on one product, dimension too large to broadcast."""
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), (F.col("id") % 1000).cast("string")))
    silver = spark.range(60_000).select(
        hot.alias("product_name"), F.lit("c").alias("category"), F.lit(10.0).alias("price"), F.lit("b").alias("price_band"),
        F.lit(5).alias("rating"), F.lit("positive").alias("sentiment"), F.lit(1).alias("word_count"),
        F.sha2(F.col("id").cast("string"), 512).alias("review_text"),
    )
    silver = staging.stage(silver, "hot")
    star = {name: staging.stage(df, name) for name, df in build_star(silver).items() if name != "fact_reviews"}
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "5000",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        fact = build_fact(silver, star)
        assert len(fact.collect()) == 60_000
        assert "SortMergeJoin(skew=true)" in plan(fact)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


class _Session:
    """Settings of a session that was never started."""

    def __init__(self, folder=None, **settings):
        self.settings = {key.replace("_", "."): value for key, value in settings.items()}
        self.conf = self.sparkContext = self
        self.getCheckpointDir = lambda: folder

    def get(self, key, default=None):
        return self.settings.get(key, default)


@pytest.mark.parametrize("master", ["yarn", "local[2]", None])
def test_staging_needs_a_named_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.staging_root(_Session(spark_master=master))
    assert staging.staging_root(_Session(spark_master=master, spark_checkpoint_dir="hdfs:///shared/")) == "hdfs:///shared"
    assert staging.staging_root(_Session(spark_master=master, folder="hdfs:///own")) == "hdfs:///own"
