import hashlib
import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from plaudit.llm import pii
from plaudit.llm.registry import QUERIES
from tests.conftest import SMALL

ANCHORS = pii.automaton()


def luhn(text):
    digits = [int(c) for c in reversed(re.sub("[ -]", "", text))]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def brute(text):
    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ips = re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
    found += [("ip", m) for m in ips if all(int(p) <= 255 for p in m[0].split("."))]
    cards = re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
    found += [("card", m) for m in cards if 14 <= len(re.sub("[ -]", "", m[0])) <= 19 and luhn(m[0])]
    phones = re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
    found += [("phone", m) for m in phones if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(((k, m.start(), m.end()) for k, m in found), key=lambda s: (s[1], pii.BASE.index(s[0])))


def base(text):
    return [s for s in pii.find(text, ANCHORS) if s[0] in pii.BASE]


CASES = [
    "a@b.c a@b a@b..c x@@y.z a.b%+-@c-d.e.f. @a.b a@b.c@d.e",
    "1.2.3.4.5.6.7.8 1.2.3 256.1.1.1 0001.2.3.4 1..2.3.4 1.2.3.4a",
    "4785 3805-9239 1139 4785380592391139 4785380592391138 1 2",
    "+1 (743) 555-3824 +1 +12 +1234567890123456 ++1 23 456 78 90 +1-- 5555555555) +3",
    "é😀 4785380592391139 😀 a@b.cc",
    "",
]


@pytest.mark.parametrize("text", CASES)
def test_base_spans_are_the_matches_of_the_patterns(text):
    assert base(text) == brute(text)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="a@.+-_ (1245é", max_size=60))
def test_base_spans_of_any_text(text):
    assert base(text) == brute(text)


def test_added_kinds():
    text = "see https://a.example/x?y=1. IBAN: DE89 3704 0044 0532 0130 00, account no. 12345678 accounting 1234567 the account is closed"
    assert [(k, text[s:e]) for k, s, e in pii.find(text, ANCHORS)] == [
        ("url", "https://a.example/x?y=1"),
        ("account", "DE89 3704 0044 0532 0130 00"),
        ("account", "12345678"),
    ]


def test_long_runs_stay_linear():
    for text in ("1" * 300_000, "1." * 200_000, "a" * 300_000 + "@", "+1 " * 100_000, "@a" * 100_000):
        pii.find(text, ANCHORS)


def test_null_empty_repeated_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a@b.c", 1), (1, None, 2), (1, "", 3), (1, "a@b.c", 4)], "doc_id long, text string, spans long")
    empty = hashlib.sha256(b"").hexdigest()
    rows = pii.digest(docs).collect()
    assert sorted((str(r.doc_id), r.n_email) for r in rows) == [("1", 0), ("1", 0), ("1", 1), ("None", 1)]
    assert {r.base_sha256 for r in rows if not r.n_email} == {empty}
    assert pii.digest(docs.limit(0)).collect() == []


def test_query_over_documents(spark):
    want = {}
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        found = brute(r.text or "")
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in found)
        want[r.doc_id] = (*(sum(k == kind for k, _, _ in found) for kind in pii.BASE), hashlib.sha256(listed.encode()).hexdigest())
    got = {r.doc_id: tuple(r)[1:6] for r in QUERIES["op5_pii"](spark, SMALL).collect()}
    assert got == want and any(sum(v[:4]) for v in got.values())
