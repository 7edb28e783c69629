"""Source audit against plain counting of all terms and pairs."""

import random
import re
from collections import Counter, defaultdict

import pytest

from plaudit.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, cells int, n string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def small(term):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in term)


def plain(docs):
    groups, counts, met = set(), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = [small(t) for t in TERM.findall(text or "")]
        counts[lang, source].update(terms)
        met[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in met[lang].items() if n >= 3]
        whole = Counter()
        for other in groups:
            if other[0] == lang:
                whole.update(counts[other])

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        def f(p, q):
            return (p - q) ** 2 // q

        p, q = shares(counts[lang, source]), shares(whole)
        pair = []
        for other in groups:
            if other[0] == lang and other[1] != source:
                o = shares(counts[other])
                pair.append((other[1], sum(f(p[t], o[t]) for t in kept)))
        term = [(t, f(p[t], q[t])) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, found in (("pair", pair), ("term", term)):
            found.sort(key=lambda r: (-r[1], r[0].encode()))
            out += [(lang, source, part, item, value, n) for n, (item, value) in enumerate(found, 1) if part == "pair" or n <= 200]
    return sorted(out, key=repr)


def table(spark, docs):
    return spark.createDataFrame([(None, *d, 1, "clash") for d in docs], SCHEMA).repartition(5)


def invented(seed, docs=150, words=60):
    r = random.Random(seed)
    names = ["wort%d" % i for i in range(words)] + ["Ünïon", "ünion", "KKelvin", "straße", "漢字", "a", "B", "b"]
    names = [re.sub(r"\d", lambda m: "abcdefghij"[int(m[0])], n) for n in names]
    out = []
    for _ in range(docs):
        text = "".join(r.choice(names) + r.choice([" ", "\n", "9", "[", "' ", "\x00", "   "]) for _ in range(r.randrange(40)))
        out.append((text, r.choice(["en", "en", "de", None, ""]), r.choice(["a", "a", "a", "b", "c", "é", None])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_plain_counting(spark, rows, seed, monkeypatch):
    monkeypatch.setattr(divergence, "SLICE_BYTES", 40)
    monkeypatch.setattr(divergence, "HELD_TERMS", 50)
    monkeypatch.setattr(divergence, "HELD_PAIRS", 30)
    docs = invented(seed)
    docs += [(None, "fr", "x"), ("", "fr", "y"), ("one two", "it", "x"), ("one", "it", "y")]  # languages that keep no term
    docs += docs[:30]
    assert rows(divergence.audit(table(spark, docs))) == plain(docs)


def test_equal_rows_and_long_texts(spark, rows):
    docs = [("same words here " * 50_000, "en", s) for s in ("a", "b")] + [("same words", "en", "c"), ("SAME other", "en", "c")] * 3
    assert rows(divergence.audit(table(spark, docs))) == plain(docs)


def test_more_terms_than_ranks(spark, rows):
    names = ["x" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(500)]
    docs = [(" ".join(names[:400]), "en", "a")] * 3 + [(" ".join(names[100:]), "en", "b")] * 4
    assert rows(divergence.audit(table(spark, docs))) == plain(docs)


def test_no_rows(spark):
    out = divergence.audit(table(spark, [("a", "b", "c")]).limit(0))
    assert out.count() == 0 and out.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_tree_counts_each_pair_of_counts(spark):
    cells = [[("a", 1), ("b", 2)], [("a", 1), ("b", 2), ("c", 1)], [("a", 1), ("c", 1)], [("b", 2), ("c", 1)], [("c", 4)]]
    paths = spark.createDataFrame([("en", path, n + 1) for n, path in enumerate(cells)], "lang string, cells array<struct<source:string,n:long>>, terms long")
    found = Counter()
    for r in divergence.tree_pairs(paths.coalesce(1)).collect():
        found[r["a"], r["a_n"], r["b"], r["b_n"]] += r["terms"]
    assert found == {("a", 1, "b", 2): 3, ("a", 1, "c", 1): 5, ("b", 2, "c", 1): 6}
