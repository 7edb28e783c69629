from pyspark.sql import functions as F

from plaudit.operators import quality as Q
from plaudit.plans.silver import to_silver
from plaudit.sources.testdata import TEST_RULES, raw_reviews

from .conftest import SMALL, plan


def test_funnel_counts_and_telescopes(spark):
    raw = raw_reviews(spark, SMALL)
    funnel = [tuple(r) for r in Q.quality_funnel(raw).orderBy("step").collect()]
    assert [n for _, n, _ in funnel] == [225, 200, 197, 196, 194]
    assert funnel[0][2] is None
    assert all(before[1] - after[2] == after[1] for before, after in zip(funnel, funnel[1:]))
    assert funnel[-1][1] == to_silver(raw, rules=TEST_RULES).count()


def test_funnel_shuffles_digests_and_not_texts(spark):
    text = plan(Q.quality_funnel(raw_reviews(spark, SMALL)))
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert any("digest" in line for line in exchanges)
    assert not any("summary" in line for line in exchanges)


def test_funnel_of_an_empty_table(spark):
    raw = raw_reviews(spark, SMALL).filter(F.lit(False))
    assert [r["rows"] for r in Q.quality_funnel(raw).collect()] == [0, 0, 0, 0, 0]


def test_digest_tells_null_from_empty_and_moved_separators(spark):
    raw = spark.createDataFrame(
        [("a", None, "5", "", "ok fine"), ("a", "", "5", None, "ok fine"), ("a1:", "b", "5", "", "ok fine"), ("a", "1:b", "5", "", "ok fine")],
        "product_name string, price string, rate string, review_title string, summary string",
    )
    assert Q.quality_funnel(raw).orderBy("step").collect()[1]["rows"] == 4


def test_constraints(spark, rows):
    df = spark.createDataFrame([(1, 5), (1, 6), (2, None)], "id int, rating int")
    got = rows(Q.check_constraints(df, {"rating 1..5": F.col("rating").between(1, 5)}, unique=["id"]))
    assert got == [("rating 1..5", 2), ("unique id", 1)]


def test_orphans(spark):
    fact = spark.createDataFrame([("a",)] * 5 + [("b",), (None,)], "k string")
    dim = spark.createDataFrame([("a",), ("a",), ("c",)], "k string")
    assert tuple(Q.orphans(fact, dim, ["k"]).first()) == (7, 5, 2)


def test_written_table_check(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert Q.assert_written(df, df) == 1
    try:
        Q.assert_written(df.withColumn("a", F.col("a").cast("long")), df)
    except AssertionError:
        return
    raise AssertionError("a changed type must be noticed")


def test_prices_no_column_can_hold_are_counted_rejects(spark):
    from plaudit.operators.clean import parse_price
    from plaudit.operators.quality import quality_funnel

    row = ("p", "5", "t", "fine words")
    raw = spark.createDataFrame([(*row, "10"), (*row, "100000000000000000")], "product_name string, rate string, review_title string, summary string, price string")
    assert [r["price"] for r in parse_price(raw).collect()] == [10.0]
    assert [(r["rows"], r["removed"]) for r in quality_funnel(raw).orderBy("step").collect()][3] == (1, 1)


def test_money_and_ratios_of_very_many_rows(spark):
    from pyspark.sql import functions as F

    from plaudit.functions.rounding import mean_money, percent, ratio

    big = spark.sql("SELECT CAST('123456789012345678.00' AS DECIMAL(28,2)) AS total, 1000000000000 AS n, 250000000000 AS part")
    r = big.select(mean_money(F.col("total"), F.col("n"), 2), percent(F.col("part"), F.col("n")), ratio(F.col("n") * 4, F.col("n"), 2)).first()
    assert tuple(r) == (123456.79, 25.0, 4.0)


def test_median_by_places_equals_numpy(spark):
    import numpy as np

    from plaudit.operators.timing import median_times

    rng = np.random.default_rng(0)
    rows = [("abc"[i % 3], float(v)) for i, v in enumerate(rng.random(301))] + [("d", None), ("one", 2.5)]
    out = {r["engine"]: (r["runs"], r["seconds"]) for r in median_times(spark.createDataFrame(rows, "engine string, seconds double").repartition(7)).collect()}
    for engine in "abc":
        mine = [v for e, v in rows if e == engine]
        assert out[engine] == (len(mine), np.floor(np.median(mine) * 1e4 + 0.5) / 1e4)
    assert out["d"] == (1, None) and out["one"] == (1, 2.5)
