import math

import pytest
from pyspark.ml.feature import IDF, CountVectorizer, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from plaudit.operators import cube as K
from plaudit.operators import features as X
from plaudit.operators import metrics as E
from plaudit.operators import timing
from plaudit.operators import words as W
from plaudit.plans import serving
from plaudit.plans.silver import to_silver
from plaudit.sources.testdata import TEST_RULES, line_reviews, raw_reviews

from .conftest import SMALL, plan


@pytest.fixture(scope="module")
def silver(spark):
    return to_silver(raw_reviews(spark, SMALL), rules=TEST_RULES).cache()


@pytest.fixture(scope="module")
def cells(spark):
    return K.cube(line_reviews(spark, SMALL)).cache()


def test_cube_covers_every_review(silver):
    assert K.cube(silver).agg(F.sum("reviews")).first()[0] == silver.count()


def test_cube_sums_money_exactly(spark):
    rows = [("c", "b", 5, "positive", 0.1, 1)] * 10
    df = spark.createDataFrame(rows, "category string, price_band string, rating int, sentiment string, price double, word_count int")
    assert str(K.cube(df).first()["sum_price"]) == "1.00"
    assert K.published_cube(K.cube(df)).first()["sum_price"] == 1.0


def test_lattice_equals_grouping_of_the_reviews(spark, rows):
    reviews = line_reviews(spark, SMALL).cache()
    reviews.createOrReplaceTempView("lattice_reviews")
    found = K.lattice(K.cube(reviews).cache(), sets=K.cube_sets())
    wanted = spark.sql(
        """SELECT category, price_band, rating, sentiment, grouping_id() AS grouping_id, count(*) AS reviews,
        CAST(sum(CAST(price AS DECIMAL(18, 2))) AS DECIMAL(38, 2)) AS sum_price, sum(CAST(word_count AS LONG)) AS sum_words
        FROM lattice_reviews GROUP BY CUBE(category, price_band, rating, sentiment)"""
    )
    assert found.columns == wanted.columns and rows(found) == rows(wanted)
    assert "Expand" in plan(wanted) and "Expand" not in plan(found)


def test_lattice_tells_nulls_from_totals_and_takes_any_sets(spark):
    data = [(None, "b", 1, "x", 1.0, 2), ("a", "b", 1, "x", 1.5, 3), ("a", None, 1, "x", 2.0, 4)]
    df = spark.createDataFrame(data, "category string, price_band string, rating int, sentiment string, price double, word_count int")
    cells = K.cube(df)
    by_category = {(r["category"], r["grouping_id"]): r["reviews"] for r in K.lattice(cells, sets=[("category",), (), ()]).collect()}
    assert by_category == {(None, 7): 1, ("a", 7): 2, (None, 15): 3}
    apart = {(r["grouping_id"], r["price_band"], r["rating"]): str(r["sum_price"]) for r in K.lattice(cells, sets=[["rating"], ["price_band"]]).collect()}
    assert apart == {(13, None, 1): "4.50", (11, "b", None): "2.50", (11, None, None): "2.00"}
    assert K.lattice(cells.limit(0)).count() == 0
    with pytest.raises(ValueError, match="colour"):
        K.lattice(cells, sets=[("colour",)])


def test_products_threshold_and_order(spark):
    data = [("p", "c", 5, "positive", 10.0)] * 3 + [("q", "c", 1, "negative", 1.0)] * 2 + [("r", "c", 3, "neutral", 2.0)] * 2
    df = spark.createDataFrame(data, "product_name string, category string, rating int, sentiment string, price double")
    got = [tuple(r) for r in K.products(df, min_reviews=2).collect()]
    assert got == [("p", "c", 3, 5.0, 100.0, 0.0, 10.0), ("q", "c", 2, 1.0, 0.0, 100.0, 1.0), ("r", "c", 2, 3.0, 0.0, 0.0, 2.0)]
    assert K.products(df).count() == 0


def test_replicate(spark):
    df = spark.range(5)
    assert K.replicate(df, 20).groupBy("id").count().filter("count <> 20").count() == 0
    assert "NestedLoop" not in plan(K.replicate(df, 20))


def test_top_words_ties_follow_the_word(spark):
    counts = spark.createDataFrame([("positive", w, 3) for w in "dbca"] + [("negative", "z", 1)], "sentiment string, word string, count long")
    assert [r["word"] for r in W.top_words(counts, 2).collect()] == ["z", "a", "b"]
    assert "WindowGroupLimit" in plan(W.top_words(counts, 2))


def test_word_signals(spark):
    found = spark.createDataFrame(
        [("negative", "bad")] * 2 + [("positive", "bad")] + [("positive", "good")] * 2, "sentiment string, word string"
    )
    wide = W.word_pivot(found)
    assert [tuple(r) for r in W.word_signals(wide, 3).collect()] == [("bad", 2, 0, 1, 3, 0.667, 0.333)]
    assert plan(wide).count("Exchange") == 1


def test_pivot_and_counts_hold_the_same(silver, rows):
    found = W.tokens(silver)
    assert rows(W.counts_from_pivot(W.word_pivot(found))) == rows(W.word_counts(found))


def test_tokens_drop_stop_words_and_short_words(spark):
    df = spark.createDataFrame([("positive", "not a very good tv the end")], "sentiment string, review_text string")
    assert [r["word"] for r in W.tokens(df).collect()] == ["good", "end"]


def test_frequencies_and_idf_match_mllib(silver):
    words = X.word_frequencies(silver)
    mine = {r["word"]: (r["count"], r["df"], r["idf"]) for r in X.idf(X.vocabulary(words), silver).collect()}
    kept = StopWordsRemover(inputCol="w", outputCol="k").transform(Tokenizer(inputCol="review_text", outputCol="w").transform(silver))
    vectorizer = CountVectorizer(inputCol="k", outputCol="tf", vocabSize=20000, minDF=3).fit(kept)
    idf = IDF(inputCol="tf", outputCol="x").fit(vectorizer.transform(kept)).idf.toArray()
    assert set(mine) == set(vectorizer.vocabulary)
    assert all(math.isclose(mine[w][2], i, abs_tol=1e-12) for w, i in zip(vectorizer.vocabulary, idf))
    by_use = [mine[w][0] for w in vectorizer.vocabulary]
    assert by_use == sorted(by_use, reverse=True)


def test_frequencies_clean_each_text_once(silver, spark):
    text = plan(X.word_frequencies(spark.createDataFrame([("a b",)], "t string").select(F.regexp_replace("t", "[^a-z]", " ").alias("review_text"))))
    assert text.count("regexp_replace") == 1


def test_repeated_texts_count_as_rows(spark):
    df = spark.createDataFrame([("good good day",)] * 3 + [("day",)], "review_text string")
    got = {r["word"]: (r["count"], r["df"]) for r in X.word_frequencies(df).collect()}
    assert got == {"good": (6, 3), "day": (4, 4)}


def test_tfidf(spark):
    words = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (2, "x")], "id int, word string")
    weights = spark.createDataFrame([("a", 0.5), ("b", 2.0)], "word string, idf double")
    assert sorted(tuple(r) for r in X.tfidf(words, weights, ["id"]).collect()) == [(1, "a", 2, 1.0), (2, "b", 1, 2.0)]


CONFUSION = [("negative", "negative", 8), ("negative", "positive", 2), ("positive", "negative", 1), ("positive", "positive", 9)]


def test_metrics_with_a_class_never_present_or_predicted(spark):
    cells = spark.createDataFrame(CONFUSION, "actual string, predicted string, reviews long")
    report = {r["class"]: tuple(r)[1:] for r in E.class_report(cells).collect()}
    assert report["neutral"] == (0.0, 0.0, 0.0, 0)
    assert report["negative"] == (0.889, 0.8, 0.842, 10)
    long = {r["metric"]: r["value"] for r in E.metrics(cells, "m").collect()}
    assert long["accuracy"] == 0.85
    assert long["f1_weighted"] == pytest.approx((10 * 16 / 19 + 10 * 18 / 21) / 20, abs=5e-5)
    assert [tuple(r) for r in E.confusion_grid(cells).collect()] == [("negative", 8, 0, 2), ("neutral", 0, 0, 0), ("positive", 1, 0, 9)]
    assert tuple(E.metrics_wide(E.metrics(cells, "m")).first()) == ("m", 0.85, long["f1_weighted"])


def test_metrics_of_nothing(spark):
    cells = spark.createDataFrame([], "actual string, predicted string, reviews long")
    assert [r["value"] for r in E.metrics(cells, "m").collect()] == [0.0, 0.0]


def test_class_weights(spark):
    df = spark.createDataFrame([(0.0,)] * 6 + [(1.0,)] * 2, "label double")
    assert {r["label"]: (r["n"], r["weight"]) for r in E.class_weights(df).collect()} == {0.0: (6, 8 / 12), 1.0: (2, 2.0)}


def test_summary_of_nothing_is_zero(cells):
    assert tuple(serving.summary(cells, category="none").first()) == (0, 0.0, 0.0)
    assert tuple(serving.kpis(cells, category=[]).first()) == (0, 0.0, 0.0, 0.0, 0.0)


def test_shares_sum_to_hundred(cells):
    sums = serving.share_within(cells, "category").groupBy("category").agg(F.sum("share").alias("s"))
    assert all(abs(r["s"] - 100) < 0.02 for r in sums.collect())
    total = serving.sentiment_shares(cells).agg(F.sum("share")).first()[0]
    assert abs(total - 100) < 0.2


def test_filtered_summary_equals_rows(cells, spark):
    lines = line_reviews(spark, SMALL).filter("category = 'PROMO' and price_band = '4. 3,000-9,999'")
    want = lines.agg(F.count("*"), F.round(F.avg("rating"), 4)).first()
    got = serving.summary(cells, "PROMO", "4. 3,000-9,999").first()
    assert (got["reviews"], got["average_rating"]) == (want[0], pytest.approx(want[1], abs=1e-9))


def test_product_list_limits(spark):
    df = spark.createDataFrame([("a", "c", 5), ("b", "c", 5), ("z", "d", 9)], "product_name string, category string, reviews long")
    assert [r[0] for r in serving.product_list(df, limit=2).collect()] == ["z", "a"]
    assert [r[0] for r in serving.product_list(df, category="c").collect()] == ["a", "b"]
    for limit in (0, 101):
        with pytest.raises(ValueError):
            serving.product_list(df, limit=limit)


def test_timings(spark):
    df = spark.createDataFrame([("x", 10, 1.0), ("x", 10, 3.0), ("x", 10, 2.0), ("y", 4, 0.0), ("y", 4, 1.0)], "engine string, rows long, seconds double")
    assert sorted(tuple(r) for r in timing.median_times(df).collect()) == [("x", 3, 2.0), ("y", 2, 0.5)]
    assert [r["rows_per_second"] for r in timing.throughput(df).collect()] == [10.0, 3.33, 5.0, 0.0, 4.0]
