"""Word statistics of cleaned texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, Window, functions as F

from plaudit.functions.rounding import ratio
from plaudit.functions.rules import SENTIMENTS


def english_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def split_words(df: DataFrame, keep: Sequence[str], src: str = "review_text") -> DataFrame:
    """One row per word occurrence with the ``keep`` columns."""
    return df.select(*keep, F.explode(F.split(F.col(src), " ")).alias("word"))


def remove_stop_words(words: DataFrame, stop_words: Sequence[str] | None = None) -> DataFrame:
    stop = english_stop_words() if stop_words is None else list(stop_words)
    return words.filter(~F.col("word").isin(*stop)) if stop else words


def tokens(
    df: DataFrame,
    min_len: int = 3,
    stop_words: Sequence[str] | None = None,
    keep: Sequence[str] = ("sentiment",),
    src: str = "review_text",
) -> DataFrame:
    found = remove_stop_words(split_words(df, keep, src), stop_words)
    return found.filter(F.length("word") >= min_len)


def word_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("sentiment", "word").agg(F.count(F.lit(1)).alias("count"))


def top_words(counts: DataFrame, n: int = 25) -> DataFrame:
    """The ``n`` most used words of each sentiment, ties in word order."""
    place = F.row_number().over(Window.partitionBy("sentiment").orderBy(F.desc("count"), "word"))
    return (
        counts.withColumn("_place", place)
        .filter(F.col("_place") <= n)
        .drop("_place")
        .orderBy("sentiment", F.desc("count"), "word")
    )


def word_pivot(found: DataFrame) -> DataFrame:
    """Uses of each word per sentiment, straight from the tokens with one shuffle."""
    return found.groupBy("word").agg(*[F.count_if(F.col("sentiment") == s).alias(s) for s in SENTIMENTS])


def counts_from_pivot(wide: DataFrame) -> DataFrame:
    """The pivot as (sentiment, word, count) rows again, without another look at the texts."""
    cells = F.array(*[F.struct(F.lit(s).alias("sentiment"), F.col(s).alias("count")) for s in SENTIMENTS])
    return (
        wide.select("word", F.inline(cells))
        .filter(F.col("count") > 0)
        .select("sentiment", "word", "count")
    )


def word_signals(wide: DataFrame, min_total: int = 300) -> DataFrame:
    total = F.col("negative") + F.col("neutral") + F.col("positive")
    return (
        wide.withColumn("total", total)
        .filter(F.col("total") >= min_total)
        .withColumn("neg_share", ratio(F.col("negative"), F.col("total"), 3))
        .withColumn("pos_share", ratio(F.col("positive"), F.col("total"), 3))
        .orderBy(F.desc("total"), "word")
    )


def leaning_words(signals: DataFrame, share: str, n: int = 15) -> DataFrame:
    return signals.select("word", share, "total").orderBy(F.desc(share), "word").limit(n)
