import re

import pytest

import corpus_pipeline as P
from plaudit.llm import kneser_ney, langid, secrets
from tests.conftest import SMALL
from tests.llm.test_jaccard import brute
from tests.llm.test_packing import check
from tests.llm.test_secrets import brute as plain_secrets

SF = SMALL.replace("0.001", "0.01")


@pytest.fixture(scope="module")
def kept(spark):
    """Rows after each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for name, function in P.STAGES:
        docs = P.stage(function(spark, docs, SF), name)
        out.append(docs)
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_all_but_the_last_stage_return_documents(kept):
    assert [name for name, _ in P.STAGES] == ["language_id", "quality_classifier", "ngram_jaccard_join", "secret_scan", "best_fit_packing"]
    for df in kept[:-1]:
        assert tuple(df.columns) == P.COLUMNS and df.schema == kept[0].schema


def test_language_keeps_what_has_a_language(kept):
    before = {r.doc_id: r.text for r in kept[0].collect()}
    scores = {r.doc_id: r for r in langid.predict(kept[0], langid.learn(kept[0])).collect()}
    want = [i for i, r in scores.items() if r.lang_pred != "und" and (len(before[i]) < P.LEAST_CHARS or r.score >= P.LEAST_COSINE)]
    assert ids(kept[1]) == sorted(want)


def test_quality_keeps_what_the_classifier_keeps(spark, kept):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert ids(kept[2]) == sorted(r.doc_id for r in kneser_ney.judge(kept[1], labels).collect() if r.kept)
    clean = {r.doc_id for r in labels.collect() if r.quality == 1 and not r.toxic} & set(ids(kept[1]))
    assert len(clean & set(ids(kept[2]))) >= 0.99 * len(clean)


def test_one_document_of_each_group_stays(kept):
    rows = kept[2].orderBy("doc_id").collect()
    want = [r.doc_id for i, (r, (n, c)) in enumerate(zip(rows, brute([r.text for r in rows], 5, 80))) if c == i or not n]
    assert ids(kept[3]) == want and len(want) < len(rows)


def test_secrets_go_and_all_else_stays(kept):
    before, after = ({r.doc_id: r for r in df.collect()} for df in kept[3:5])
    assert before.keys() == after.keys()
    changed = [i for i in before if before[i] != after[i]]
    assert changed and set(changed) == {i for i, r in before.items() if plain_secrets(r.text)}
    for i in changed:
        assert not plain_secrets(after[i].text) and secrets.REDACTED in after[i].text
        assert after[i].n_chars == len(after[i].text) and after[i].source == before[i].source


def test_all_that_is_left_is_packed(kept):
    used, least = check(kept[5].collect(), [(r.doc_id, r.text) for r in kept[4].collect()], 2048)
    assert used <= 1.02 * least + 1


def test_stages_take_nulls_repeats_clashes_and_no_rows(spark):
    text = "The quick brown fox jumps over the lazy dog again and again"
    rows = [
        (1, text, "en", "s", 5, "x", 1), (1, text, "en", "s", 5, "x", 1), (None, text, None, None, None, None, None),
        (2, None, "en", "s", 0, "x", 1), (3, "", "en", "s", 0, "x", 1), (4, "12 34 !!", "en", "s", 8, "x", 1),
        (5, "long words without an end " * 20_000, "en", None, 1, "x", 1),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _mark string, n int"
    docs = spark.createDataFrame(rows, schema)
    sizes = []
    for name, function in P.STAGES[:-1]:
        docs = P.stage(function(spark, docs, SMALL), name)
        sizes.append(docs.count())
        assert function(spark, spark.createDataFrame([], schema), SMALL).collect() == []
    assert sizes[0] == 4 and sizes[2] <= 2
    assert P.STAGES[-1][1](spark, spark.createDataFrame([], schema), SMALL).collect() == []


def test_near_duplicates_keeps_rows_without_words_and_the_smallest_id(spark):
    text = "one two three four five six seven"
    rows = [(7, text), (3, text), (3, text), (None, text), (None, "other words that stand alone here"), (9, None), (9, ""), (8, "zz")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = sorted(((r.doc_id, r.text) for r in P.near_duplicates(spark, docs, SMALL).collect()), key=str)
    assert out == sorted([(3, text), (None, rows[4][1]), (9, None), (9, ""), (8, "zz")], key=str)


def test_run_returns_the_last_stage(spark, kept):
    assert P.run(spark, SF).select("doc_id", "piece", "ids_crc32").exceptAll(kept[5].select("doc_id", "piece", "ids_crc32")).count() == 0
    assert P.ORACLE_SQL is None and re.match("Corpus pipeline", P.__doc__)
