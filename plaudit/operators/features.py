"""Vocabulary, inverse document frequencies and TF-IDF in relational form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from plaudit.operators.words import remove_stop_words


def word_frequencies(texts: DataFrame, src: str = "review_text", stop_words: Sequence[str] | None = None) -> DataFrame:
    """Total uses and number of texts per word.

    Each text contributes its words twice inside its task, once as they stand and
    once without repeats.  So the only shuffle carries one row per word and task,
    and repeated texts need no key to be told apart.
    """
    words = F.split(F.col(src), " ")
    both = texts.select(F.posexplode(F.array(words, F.array_distinct(words))).alias("_kind", "_words"))
    each = remove_stop_words(both.select("_kind", F.explode("_words").alias("word")), stop_words)
    return each.groupBy("word").agg(
        F.count_if(F.col("_kind") == 0).alias("count"),
        F.count_if(F.col("_kind") == 1).alias("df"),
    )


def vocabulary(frequencies: DataFrame, size: int | None = None, min_df: int = 3) -> DataFrame:
    """The words found in at least ``min_df`` texts; with ``size``, only the most used of them."""
    known = frequencies.filter(F.col("df") >= min_df)
    return known if size is None else known.orderBy(F.desc("count"), "word").limit(size)


def idf(words: DataFrame, texts: DataFrame) -> DataFrame:
    """``ln((texts + 1) / (df + 1))`` for each word."""
    n = texts.agg(F.count(F.lit(1)).alias("n")).scalar()
    return words.withColumn("idf", F.log((n + 1) / (F.col("df") + 1)))


def by_text(texts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Texts dealt by ``keys`` into partitions of a sixteenth of those they are read in.  Their
    words need no shuffle then to be counted by text, and a task counts those of few texts."""
    return texts.repartition(16 * max(1, texts.rdd.getNumPartitions()), *keys)


def tfidf(words: DataFrame, weights: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Uses of each vocabulary word in each text, weighted by idf.

    ``words`` has one row per occurrence.  Other words drop out before the shuffle.
    """
    return (
        words.join(weights.select("word", "idf"), "word")
        .groupBy(*keys, "word", "idf")
        .agg(F.count(F.lit(1)).alias("tf"))
        .select(*keys, "word", "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))
    )
