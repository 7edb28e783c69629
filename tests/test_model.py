import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from plaudit.operators.metrics import confusion, metrics
from plaudit.operators.scoring import LONGEST_TEXT, score
from plaudit.plans import model as ML
from plaudit.plans.silver import to_silver
from plaudit.sources.testdata import TEST_RULES, raw_reviews
from plaudit.staging import fresh_path, stage

from .conftest import SMALL

ZERO = {"negative": 0.0, "neutral": 0.0, "positive": 0.0}
WEIGHTS = "word string, idf double, w_negative double, w_neutral double, w_positive double"


def scored(spark, texts, weights, intercepts=ZERO, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    table = spark.createDataFrame(weights, WEIGHTS)
    return [r for r in score(df, table, intercepts, ["id"], **options).orderBy("id").collect()]


def test_known_word(spark):
    (row,) = scored(spark, ["good"], [("good", 1.0, -1.0, 0.0, 2.0)])
    assert (row["status"], row["prediction"]) == ("ok", "positive")
    assert row["p_negative"] + row["p_neutral"] + row["p_positive"] == pytest.approx(1.0, abs=2e-6)


def test_unknown_blank_and_invalid_texts_get_no_prediction(spark):
    rows = scored(spark, ["unseenword", " ", "", None, "x" * 10_001], [("good", 1.0, -1.0, 0.0, 2.0)], max_chars=LONGEST_TEXT)
    assert [r["status"] for r in rows] == ["unknown", "unknown", "invalid", "invalid", "invalid"]
    assert all(r["prediction"] is None and r["p_positive"] is None for r in rows)


def test_length_limit_can_be_lifted(spark):
    (row,) = scored(spark, ["good " * 5000], [("good", 1.0, -1.0, 0.0, 2.0)], max_chars=None)
    assert row["prediction"] == "positive"


def test_repeated_words_and_case_count(spark):
    weights = [("good", 0.5, 0.0, 0.0, 1.0), ("bad", 1.0, 1.25, 0.0, 0.0)]
    rows = scored(spark, ["Good GOOD bad", "good, good; Good! bad"], weights)
    assert [r["prediction"] for r in rows] == ["negative", "positive"]


def test_ties_go_to_the_first_class(spark):
    rows = scored(spark, ["even", "even"], [("even", 1.0, 1.0, 1.0, 1.0)])
    assert [r["prediction"] for r in rows] == ["negative", "negative"]


@pytest.fixture(scope="module")
def fitted(spark):
    silver = stage(to_silver(raw_reviews(spark, SMALL), rules=TEST_RULES), "silver")
    model, predicted = ML.train_and_test(silver, max_iter=10)
    return silver, model, stage(predicted, "predicted")


def test_equal_texts_stay_on_one_side(fitted):
    rows = ML.training_rows(fitted[0])
    train, test = ML.hash_split(rows)
    assert train.count() + test.count() == rows.count()
    assert train.select("review_text").intersect(test.select("review_text")).count() == 0


def test_own_metrics_equal_mllib(fitted):
    _, _, predicted = fitted
    mine = {r["metric"]: r["value"] for r in metrics(confusion(predicted), "m").collect()}
    code = F.create_map(*[x for i, c in enumerate(ML.SENTIMENTS) for x in (F.lit(c), F.lit(float(i)))])
    pairs = predicted.select(code[F.col("actual")].alias("label"), code[F.col("predicted")].alias("prediction"))
    for name, key in (("accuracy", "accuracy"), ("f1", "f1_weighted")):
        theirs = MulticlassClassificationEvaluator(metricName=name).evaluate(pairs)
        assert mine[key] == pytest.approx(theirs, abs=5.1e-5)


def test_exported_weights_score_like_the_model(spark, fitted):
    _, model, predicted = fitted
    folder = fresh_path(spark, "weights")
    ML.save_weights(*ML.export_weights(model, spark), folder)
    weights, intercepts = ML.load_weights(spark, folder)
    result = ML.model_parity(predicted, weights, intercepts).first()
    assert result["texts"] == predicted.select("review_text").distinct().count()
    assert result["agree"] == result["scored"] > 0


def test_two_class_model_leaves_neutral_out(fitted):
    rows = ML.training_rows(fitted[0], ML.TWO_CLASSES)
    assert sorted(r[0] for r in rows.select("label").distinct().collect()) == [0.0, 1.0]
    assert rows.count() == fitted[0].filter("sentiment <> 'neutral'").count()


def test_bulk_scoring_takes_texts_of_any_length(spark):
    rows = scored(spark, ["good " * 6_000, "filler " * 6_000 + "good"], [("good", 1.0, -1.0, 0.0, 2.0)])
    assert [(r["status"], r["prediction"]) for r in rows] == [("ok", "positive")] * 2


def test_all_words_have_weights_unless_a_size_is_given(spark):
    from plaudit.operators import features as X

    texts = spark.range(3).selectExpr("array_join(transform(sequence(1, 20500), i -> 'w' || i), ' ') AS review_text")
    words = X.word_frequencies(texts)
    assert X.vocabulary(words).count() == 20_500 and X.vocabulary(words, 20_000).count() == 20_000


def test_training_counts_words_as_mllib_does(spark, fitted, monkeypatch):
    """Every text is cut into words twice at most, and model and vocabulary are MLlib's own."""
    rows = ML.training_rows(fitted[0])
    weighted = rows.join(F.broadcast(ML.class_weights(rows).select("label", "weight")), "label")
    theirs = ML.text_classifier(max_iter=5).fit(weighted)
    staged = []
    monkeypatch.setattr(ML, "stage", lambda df, *rest: staged.append(rest[0]) or stage(df, *rest))
    mine = ML.train(rows, max_iter=5)
    assert staged == ["counted"] and len(mine.stages) == len(theirs.stages) == 5
    assert set(mine.stages[2].vocabulary) == set(theirs.stages[2].vocabulary)
    for model in (mine, theirs):
        counts = dict(zip(model.stages[2].vocabulary, model.stages[3].docFreq))
        weights = model.stages[4].coefficientMatrix.toArray().T
        by_word = sorted(zip(model.stages[2].vocabulary, map(tuple, weights)))
        if model is mine:
            kept = counts, by_word
    assert kept[0] == counts
    for (word, w), (other, v) in zip(kept[1], by_word):
        assert word == other and w == pytest.approx(v, abs=1e-6)
