"""The DuckDB statements load without a session."""

import subprocess
import sys

from pyspark.ml.feature import StopWordsRemover

from checks.duckdb_sql import STOP_WORDS


def test_stop_words_are_those_of_spark(spark):
    assert STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_statements_load_without_jars_or_session():
    code = (
        "import pyspark; pyspark.__file__ = '/nowhere/pyspark/__init__.py'\n"
        "import __spark_entry__ as e; assert len(e.oracle_sql()) > 100\n"
        "from pyspark import SparkContext; assert SparkContext._gateway is None"
    )
    subprocess.run([sys.executable, "-c", code], check=True)
