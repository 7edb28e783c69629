"""TF-IDF sentiment models with MLlib, trained on the review text only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizer, CountVectorizerModel, StopWordsRemover, Tokenizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plaudit.functions.rules import SENTIMENTS
from plaudit.operators import features as X
from plaudit.operators.clean import keep_nonempty, label
from plaudit.operators.metrics import class_report, class_weights, confusion, metrics
from plaudit.operators.scoring import parity, score
from plaudit.staging import stage

TWO_CLASSES = ("negative", "positive")


def split_bucket(column: str) -> Column:
    """0..99 from the text itself, so equal texts always fall on the same side."""
    return (F.conv(F.substring(F.md5(F.col(column)), 1, 6), 16, 10).cast("int") % 100).cast("int")


def hash_split(df: DataFrame, column: str = "review_text", percent: int = 80) -> tuple[DataFrame, DataFrame]:
    bucket = split_bucket(column)
    return df.filter(bucket < percent), df.filter(bucket >= percent)


def text_classifier(vocab_size: int = 20000, min_df: int = 3, max_iter: int = 30, reg: float = 0.02) -> Pipeline:
    words = Tokenizer(inputCol="review_text", outputCol="words")
    kept = StopWordsRemover(inputCol="words", outputCol="kept")
    counts = CountVectorizer(inputCol="kept", outputCol="counts", vocabSize=vocab_size, minDF=min_df)
    scaled = IDF(inputCol="counts", outputCol="features")
    classifier = LogisticRegression(labelCol="label", weightCol="weight", maxIter=max_iter, regParam=reg)
    return Pipeline(stages=[words, kept, counts, scaled, classifier])


def counter(texts: DataFrame, vectorizer: CountVectorizer) -> CountVectorizerModel:
    """``vectorizer`` fitted on cleaned texts: the most used words, ties in word order.

    The words are counted by hash aggregation, so no text becomes a map of Java objects.  Stop
    words are no part of the vocabulary.
    """
    found = X.vocabulary(X.word_frequencies(texts), vectorizer.getVocabSize(), int(vectorizer.getMinDF()))
    words = [row["word"] for row in found.select("word").collect()]
    if not words:
        raise ValueError("no word is in enough texts for a vocabulary")
    return CountVectorizerModel.from_vocabulary(words, vectorizer.getInputCol(), vectorizer.getOutputCol())


def train(labelled: DataFrame, **settings) -> PipelineModel:
    """Fit on rows with cleaned ``review_text`` and ``label``, every class weighing the same.

    The texts are read twice, for the vocabulary and for the word counts.  The counts are
    written once; inverse document frequencies, class weights and the classifier come from them.
    Cleaned texts are split as ``Tokenizer`` does, and stop words are not in the vocabulary.
    """
    words, kept, vectorizer, scaled, classifier = text_classifier(**settings).getStages()
    counts = counter(labelled, vectorizer)
    split = labelled.select("label", F.split("review_text", " ").alias(counts.getInputCol()))
    counted = stage(counts.transform(split).select("label", counts.getOutputCol()), "counted", "zstd")
    scaler = scaled.fit(counted)
    # one row per class
    weights = F.broadcast(class_weights(counted).select("label", "weight"))
    fitted = classifier.fit(scaler.transform(counted.join(weights, "label")))
    return PipelineModel([words, kept, counts, scaler, fitted])


def training_rows(silver: DataFrame, classes: Sequence[str] = SENTIMENTS) -> DataFrame:
    return label(keep_nonempty(silver), classes).select("review_text", "label")


def class_name(column: str, classes: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in classes]), F.col(column).cast("int") + 1)


def predict(model: PipelineModel, rows: DataFrame, classes: Sequence[str] = SENTIMENTS) -> DataFrame:
    out = model.transform(rows)
    return out.select("review_text", class_name("label", classes).alias("actual"), class_name("prediction", classes).alias("predicted"))


def train_and_test(silver: DataFrame, classes: Sequence[str] = SENTIMENTS, **settings) -> tuple[PipelineModel, DataFrame]:
    train_rows, test_rows = hash_split(training_rows(silver, classes))
    model = train(train_rows, **settings)
    return model, predict(model, test_rows, classes)


def evaluate(predicted: DataFrame, name: str, classes: Sequence[str] = SENTIMENTS) -> dict[str, DataFrame]:
    # a row per pair of classes; the model runs over the test rows once
    cells = stage(confusion(predicted), "confusion")
    return {
        "confusion_matrix": cells,
        "model_class_report": class_report(cells, classes),
        "model_metrics": metrics(cells, name, classes),
    }


def _six_digits(value: float) -> float:
    return float(f"{value:.6g}")


def export_weights(model: PipelineModel, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Word weights (6 significant digits) and intercepts of the three-class model.

    The vocabulary size bounds both tables.
    """
    _, _, vectorizer, scaler, classifier = model.stages
    by_class = classifier.coefficientMatrix.toArray()
    rows = [
        (word, _six_digits(weight), *(_six_digits(by_class[c][i]) for c in range(len(SENTIMENTS))))
        for i, (word, weight) in enumerate(zip(vectorizer.vocabulary, scaler.idf.toArray()))
    ]
    columns = ", ".join(f"w_{c} double" for c in SENTIMENTS)
    # stored, so that a scoring join knows its size
    weights = stage(spark.createDataFrame(rows, f"word string, idf double, {columns}"), "model_weights")
    start = [tuple(float(x) for x in classifier.interceptVector.toArray())]
    return weights, spark.createDataFrame(start, ", ".join(f"{c} double" for c in SENTIMENTS))


def save_weights(weights: DataFrame, intercepts: DataFrame, folder: str) -> None:
    weights.write.mode("overwrite").parquet(f"{folder}/model_weights")
    intercepts.write.mode("overwrite").json(f"{folder}/model_intercepts")


def load_weights(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[str, float]]:
    """Stored weights, whose file size Spark knows when it plans the scoring join."""
    weights = spark.read.parquet(f"{folder}/model_weights")
    schema = ", ".join(f"{c} double" for c in SENTIMENTS)
    return weights, spark.read.schema(schema).json(f"{folder}/model_intercepts").first().asDict()


def model_parity(predicted: DataFrame, weights: DataFrame, intercepts: dict[str, float]) -> DataFrame:
    """Score every distinct test text from the weight table and compare with MLlib."""
    texts = predicted.select("review_text", F.col("predicted").alias("prediction")).distinct()
    keyed = texts.withColumn("text_id", F.sha2("review_text", 256))
    scored = score(keyed, weights, intercepts, ["text_id"], text="review_text", max_chars=None)
    return parity(scored, keyed.select("text_id", "prediction"), ["text_id"])
