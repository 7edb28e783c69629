import hashlib
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from plaudit.llm import secrets as S
from plaudit.llm.registry import QUERIES
from tests.conftest import SMALL, plan

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    kinds = ["assign", "access", "hex"]
    return sorted(found, key=lambda s: (s[1], kinds.index(s[0])))


TEXTS = [
    "a token = 'abcdefgh' " + "f" * 30 + " AKIA" + "B" * 16,
    "é😀 PassWord: ab secret=token: abcdefgh",
    "AKIA" + "A" * 15 + " AKIAAKIA" + "0" * 12,
    "api_key=" + "0123456789abcdef" * 3 + "\napikey : x",
    "e" * 23 + " " + "e" * 24 + "g" + "e" * 25,
    "",
    None,
    "token=" + "x" * 100_000,
    ("deadbeef" * 3 + " ") * 2_000,
]


def spans(rows):
    return {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in rows}


def test_equals_plain_search(spark):
    docs = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(TEXTS)], "doc_id long, text string, spans string, _kinds int")
    got = spans(S.find_secrets(docs).collect())
    assert got == {i: brute(t or "") for i, t in enumerate(TEXTS)}


def test_more_rules_add_spans(spark):
    text = "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 18 + " eyJabcdefgh1.eyJabcdefgh1.abcdefgh_1 xoxb-1234567890-x"
    got = spans(S.find_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect())[1]
    assert {"private_key", "bearer", "web_token", "chat_token"} <= {k for k, _, _ in got}


def test_null_and_repeated_ids_and_no_rows(spark):
    rows = [(None, "token: abcdefg"), (None, None), (5, "token: abcdefg"), (5, "token: abcdefg"), (5, "plain")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = S.digest(S.find_secrets(docs)).collect()
    assert sorted((str(r.doc_id), r.n_assign) for r in out) == [("5", 0), ("5", 1), ("5", 1), ("None", 0), ("None", 1)]
    assert S.find_secrets(docs.limit(0)).collect() == []


def test_redacts_values_and_nothing_else(spark):
    docs = spark.createDataFrame(
        [(1, "x token = abcdef1 y", "en", 3), (2, "clean\ntext", "en", 10), (3, None, None, None)],
        "doc_id long, text string, lang string, n_chars long",
    )
    out = {r.doc_id: r for r in S.redact(docs).collect()}
    assert out[1].text == "x <redacted> y" and out[1].n_chars == len(out[1].text)
    assert tuple(out[2]) == (2, "clean\ntext", "en", 10) and out[3].text is None and out[3].n_chars is None


@pytest.mark.parametrize("rule", S.BASE_RULES + S.MORE_RULES)
def test_trigram_queries_never_miss(rule):
    made = {
        "assign": ["password: abcdef", "PASSWD='abcdef", "Secret = a12345", "toKen:zzzzzz", "api_key=zzzzzz", "APIKEY=zzzzzz"],
        "access": ["AKIA" + "Q" * 16],
        "hex": ["a" * 24],
        "private_key": ["-----BEGIN PRIVATE KEY-----", "-----BEGIN EC PRIVATE KEY-----"],
        "bearer": ["ghs_" + "a" * 36],
        "chat_token": ["xoxp-" + "1" * 10],
        "web_token": ["eyJ12345678.eyJ12345678.12345678"],
    }[rule.kind]
    clauses = S.trigram_query(rule.pattern)
    assert bool(clauses) == (rule.kind != "hex")
    for text in made:
        assert re.search(rule.pattern, text)
        assert not clauses or any(all(g in text.lower() for g in clause) for clause in clauses)


@settings(max_examples=200, deadline=None)
@given(st.from_regex(r"(ab?c|[xy]d)+(foo|bar){2,3}[0-9]*(end)?q*", fullmatch=True))
def test_derived_queries_hold_for_any_match(text):
    clauses = S.trigram_query(r"(ab?c|[xy]d)+(foo|bar){2,3}[0-9]*(end)?q*")
    assert clauses and any(all(g in text for g in clause) for clause in clauses)


def test_query_over_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = QUERIES["op7_secret_scan"](spark, SMALL)
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan(got))
    want = {}
    for r in docs.collect():
        found = brute(r.text or "")
        listed = ",".join(f"{k}:{a}:{z}" for k, a, z in found)
        counts = [sum(k == kind for k, _, _ in found) for kind in ("assign", "access", "hex")]
        want[r.doc_id] = (*counts, hashlib.sha256(listed.encode()).hexdigest())
    assert {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got.collect()} == want


def test_running_sums(spark):
    arrays = [list(range(n)) for n in (0, 1, 2, 511, 512, 513, 1500)]
    df = spark.createDataFrame([(a,) for a in arrays], "a array<int>")
    assert [r[0] for r in df.select(S.running_sums(F.col("a"))).collect()] == [[sum(a[:i]) for i in range(len(a))] for a in arrays]
