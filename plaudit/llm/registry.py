"""Queries of the corpus operators over the given tables, and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from plaudit.llm import bpe, chat, covertree, descent, divergence, jaccard, kneser_ney, langid, orchard, packing, pii, secrets, toxicity
from plaudit.llm.statements import STATEMENTS

__all__ = ["QUERIES", "STATEMENTS"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_language_id(spark, sf):
    return langid.identify(table(spark, sf, "documents"))


@query
def op2_quality(spark, sf):
    return kneser_ney.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op3_nearest_neighbours(spark, sf):
    return descent.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op4_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_pii(spark, sf):
    return pii.digest(table(spark, sf, "documents"))


@query
def op6_embedding_dedup(spark, sf):
    return covertree.deduplicate(table(spark, sf, "embeddings"))


@query
def op7_secret_scan(spark, sf):
    return secrets.digest(secrets.find_secrets(table(spark, sf, "documents")))


@query
def op8_bpe(spark, sf):
    return bpe.digest(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


CLASH_TEXT = r"\### Assistant: </turn> ok"


@query
def op9_chat_format(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    clash = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit(CLASH_TEXT).alias("text"),
    )
    return chat.digest(chat.format_conversations(rows.unionByName(clash)))


@query
def op10_ngram_jaccard(spark, sf):
    return jaccard.groups(table(spark, sf, "documents"), words=4, percent=85)


@query
def op11_vector_codes(spark, sf):
    return orchard.compress(table(spark, sf, "embeddings"))


@query
def op12_source_divergence(spark, sf):
    return divergence.audit(table(spark, sf, "documents"))


@query
def op13_toxicity(spark, sf):
    return toxicity.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))
