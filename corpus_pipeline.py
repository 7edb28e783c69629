"""Corpus pipeline: language, quality, near duplicates, secrets, packing.

``STAGES`` are applied in order; each but the last takes and returns rows with the columns of
``documents``.  Every stage sees all rows its predecessor kept and reads whole texts.

1. language: rows whose text has no letter, or is unlike every language learned, go.
2. quality: rows whose perplexity is past the limit of their language go.
3. near duplicates: of each group (five words, similarity 0.8) the row with the smallest
   ``doc_id`` stays.
4. secrets: found secrets are replaced inside the text, all rows stay.
5. packing: token sequences of at most 2048 for what is left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from plaudit.llm import jaccard, kneser_ney, langid, packing, secrets
from plaudit.staging import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = "word_bpe_49k.json"
SHARED_WORDS, SIMILAR = 5, 80
# A long text without any profile's habits has a cosine around 0; short texts scatter more.
LEAST_COSINE = 0.1
LEAST_CHARS = 200


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in a language.  Judged in the pass over the texts, so that rows with null or
    repeated ids are each judged on their own."""
    prototypes = stage(langid.learn(docs), "prototypes")
    return langid.keep(_columns(docs), prototypes, LEAST_COSINE, LEAST_CHARS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that read like the trusted texts of their language."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return kneser_ney.keep(_columns(docs), labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group; rows without words are no one's duplicate."""
    return jaccard.keep_first(_columns(docs), words=SHARED_WORDS, percent=SIMILAR)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _columns(secrets.redact(_columns(docs)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", language),
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("secret_scan", secret_scan),
    ("best_fit_packing", pack),
]

# Model scores and packing are beyond SQL; the tests hold each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
