import zlib

import numpy as np
from pyspark.sql import functions as F

from plaudit.llm import langid
from plaudit.llm.registry import QUERIES
from tests.conftest import SMALL


def brute(text):
    """Bundle of a text, window by window."""
    total = np.zeros(langid.DIMENSIONS)
    padded = "\n" + text.lower() + "\n"
    code = lambda c: ord(c) if c.isalpha() else 0
    for a, b, c in zip(padded, padded[1:], padded[2:]):
        if b.isalpha():
            va, vb, vc = (langid.letter_vector(code(x)).astype(float) for x in (a, b, c))
            total += np.roll(va, 2) * np.roll(vb, 1) * vc
    return total


def test_bundles_equal_the_plain_definition():
    texts = ["Hello, wörld", "", "İstanbul I", "漢字 12 x", "a", "!!", "Wörld wörld"]
    got = langid.Profiler().bundles(texts)
    assert np.array_equal(got, np.array([brute(t) for t in texts]))


def test_slices_of_a_long_text_add_up(monkeypatch):
    text = "some words that go on " * 50 + "x" * 300
    whole = langid.Profiler().bundles([text])
    monkeypatch.setattr(langid, "SLICE", 37)
    assert np.array_equal(langid.Profiler().bundles([text, "b"])[:1], whole)


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_nulls_repeats_ties_and_no_rows(spark):
    rows = [(1, "the cat", "b", ""), (1, "the cat", "a", ""), (2, None, "a", ""), (3, "123 !", "c", ""), (None, "the cat", None, ""), (4, "", None, "")]
    table = docs(spark, rows)
    out = langid.predict(table, langid.learn(table)).collect()
    assert sorted((str(r.doc_id), r.lang_pred) for r in out) == [("1", "a"), ("1", "a"), ("2", "und"), ("3", "und"), ("4", "und"), ("None", "a")]
    assert all(0 <= r.score <= 1 and (r.score > 0) == (r.lang_pred != "und") for r in out)
    unlabelled = table.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.predict(table, langid.learn(unlabelled)).collect()} == {"und"}
    assert langid.identify(table.limit(0)).collect() == []


def test_prototypes_do_not_depend_on_the_layout(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    one, many = (sorted(map(tuple, langid.learn(table.repartition(n)).collect())) for n in (1, 7))
    assert one == many


def test_query_learns_from_the_rest_and_finds_held_out_languages(spark, tmp_path):
    out = QUERIES["op1_language_id"](spark, SMALL)
    given = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = out.collect()
    assert len(rows) == len(given)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    tested = [r for r in rows if r.held_out and given[r.doc_id]]
    assert sum(r.lang_pred == given[r.doc_id] for r in tested) >= 0.95 * len(tested) > 20


def test_held_out_labels_have_no_effect(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    changed = table.withColumn("lang", F.when(langid.held_out(), F.lit("zz")).otherwise(F.col("lang")))
    key = lambda df: sorted(map(tuple, langid.identify(df).collect()))
    assert key(changed) == key(table)
