"""Class weights and classification metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from plaudit.functions.rounding import ratio, settle
from plaudit.functions.rules import SENTIMENTS


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``rows / (classes * rows of the class)`` per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # one row per class: the window holds class counts, not data
    every_class = Window.partitionBy()
    total, classes = F.sum("n").over(every_class), F.count(F.lit(1)).over(every_class)
    return counts.withColumn("weight", total.cast("double") / (classes * F.col("n")).cast("double"))


def confusion(pred: DataFrame) -> DataFrame:
    return pred.groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("reviews"))


def _by_class(cells: DataFrame, classes: Sequence[str]) -> DataFrame:
    """One row: hits, actual and predicted counts of every class."""
    sums = []
    for c in classes:
        is_actual, is_predicted = F.col("actual") == c, F.col("predicted") == c
        for prefix, condition in (("tp", is_actual & is_predicted), ("act", is_actual), ("prd", is_predicted)):
            sums.append(F.coalesce(F.sum(F.when(condition, F.col("reviews"))), F.lit(0)).alias(f"{prefix}_{c}"))
    return cells.agg(*sums)


def class_report(cells: DataFrame, classes: Sequence[str] = SENTIMENTS) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where a denominator is 0."""
    rows = [
        F.struct(
            F.lit(c).alias("class"),
            ratio(F.col(f"tp_{c}"), F.col(f"prd_{c}"), 3, empty=0).alias("precision"),
            ratio(F.col(f"tp_{c}"), F.col(f"act_{c}"), 3, empty=0).alias("recall"),
            ratio(2 * F.col(f"tp_{c}"), F.col(f"prd_{c}") + F.col(f"act_{c}"), 3, empty=0).alias("f1"),
            F.col(f"act_{c}").alias("reviews"),
        )
        for c in classes
    ]
    return _by_class(cells, classes).select(F.inline(F.array(*rows)))


def metrics(cells: DataFrame, model: str, classes: Sequence[str] = SENTIMENTS) -> DataFrame:
    """Accuracy and support-weighted F1 in long form."""
    hits = sum((F.col(f"tp_{c}") for c in classes), F.lit(0).cast("long"))
    total = sum((F.col(f"act_{c}") for c in classes), F.lit(0).cast("long"))
    weighted = F.lit(0.0)
    for c in classes:
        both = F.nullif(F.col(f"prd_{c}") + F.col(f"act_{c}"), F.lit(0).cast("long"))
        f1 = 2.0 * F.col(f"tp_{c}") / both
        weighted = weighted + F.coalesce(f1 * F.col(f"act_{c}"), F.lit(0.0))
    rows = F.array(
        F.struct(F.lit("accuracy").alias("metric"), ratio(hits, total, 4, empty=0).alias("value")),
        F.struct(
            F.lit("f1_weighted").alias("metric"),
            F.coalesce(settle(weighted / F.nullif(total, F.lit(0).cast("long")), 4), F.lit(0.0)).alias("value"),
        ),
    )
    return _by_class(cells, classes).select(F.lit(model).alias("model"), F.inline(rows))


def metrics_wide(long: DataFrame, names: Sequence[str] = ("accuracy", "f1_weighted")) -> DataFrame:
    return long.groupBy("model").pivot("metric", list(names)).agg(F.max("value"))


def confusion_grid(cells: DataFrame, classes: Sequence[str] = SENTIMENTS) -> DataFrame:
    """Dense grid in class order; cells that never occur are 0."""
    columns = [
        F.coalesce(F.sum(F.when(F.col("predicted") == c, F.col("reviews"))), F.lit(0)).alias(c) for c in classes
    ]
    filled = cells.groupBy("actual").agg(*columns)
    spark = cells.sparkSession
    order = spark.createDataFrame(list(enumerate(classes)), "position int, actual string")
    return (
        order.join(filled, "actual", "left")
        .fillna(0, list(classes))
        .orderBy("position")
        .select("actual", *classes)
    )
