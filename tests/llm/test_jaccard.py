import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plaudit.llm import jaccard as J
from plaudit.llm.graph import components
from plaudit.llm.registry import QUERIES
from plaudit.llm.select import flagged
from tests.conftest import SMALL, plan

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) >= k:
        return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
    return {tuple(words)} if words else set()


def brute(texts, k, percent):
    """Component (smallest position) of each text, comparing all pairs."""
    sets, parent = [shingles(t, k) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= percent * len(x | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def near_copies(seed, groups, copies, length, shared):
    """Texts in groups of edited copies, with passages that unrelated texts share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    passage = [word() for _ in range(shared)]
    texts = []
    for _ in range(groups):
        own = [word() for _ in range(rng.randint(length // 2, length))] + passage * rng.randint(0, 1)
        for _ in range(rng.randint(1, copies)):
            made = list(own)
            for _ in range(rng.randint(0, 5)):
                made[rng.randrange(len(made))] = word()
            texts.append(" ".join(made))
    return texts


def got(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [tuple(r)[1:] for r in J.groups(docs, **options).orderBy("doc_id").collect()]


@pytest.mark.parametrize("percent, rare, long", [(85, 16, 400), (80, 1, 400), (85, 1, 30), (85, 0, 1)])
def test_equals_all_pairs(spark, monkeypatch, percent, rare, long):
    monkeypatch.setattr(J, "RARE", rare)
    monkeypatch.setattr(J, "LONG", long)
    texts = near_copies(3, 25, 8, 60, 40) + ["", None, "one two", "One TWO", "one", " \t\n", "a b c d", "a b c d e"]
    assert got(spark, texts, words=4, percent=percent) == brute(texts, 4, percent)


def test_frequent_class_keeps_to_its_bound(spark, monkeypatch):
    monkeypatch.setattr(J, "RARE", 1)
    monkeypatch.setattr(J, "MOST_FREQUENT", 50)
    texts = near_copies(5, 15, 6, 50, 20)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert 0 < len(J.frequent_shingles(docs, 4, 4)) <= 50
    assert got(spark, texts, words=4, percent=85) == brute(texts, 4, 85)


def test_large_group_stays_linear(spark, monkeypatch):
    """Copies with one edit each: all of them are pairs, but few are looked at."""
    rng = random.Random(1)
    own = [f"w{i}" for i in range(160)]
    texts = []
    for i in range(600):
        made = list(own)
        made[rng.randrange(160)] = f"x{i}"
        texts.append(" ".join(made))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, classes, links = J.link(docs, 4, 85)
    assert classes.count() == 600 and links.count() <= 600 * (J.NEIGHBOURS + 1)
    assert {r.component_id for r in J.groups(docs, 4, 85).collect()} == {0}


def test_nulls_repeats_clashing_columns_and_no_rows(spark):
    text = "a b c d e f g h"
    rows = [(None, text, 1, 1), (7, text, 1, 1), (7, text, 1, 1), (9, None, 1, 1), (None, None, 1, 1), (3, "solo " * 30_000, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long, keys long")
    out = sorted((tuple(r) for r in J.groups(docs).collect()), key=str)
    assert out == sorted([(None, 4, 7), (7, 4, 7), (7, 4, 7), (9, 0, 9), (None, 0, None), (3, 1, 3)], key=str)
    assert J.groups(docs.limit(0)).collect() == []


def test_bitmap_never_exceeds_the_difference():
    rng = np.random.default_rng(0)
    for _ in range(50):
        x, y = (np.unique(rng.integers(0, 500, n).astype(np.uint64) * J.MULTIPLIER) for n in rng.integers(1, 300, 2))
        bits = [np.frombuffer(J.bitmap(s), np.uint8) for s in (x, y)]
        assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= len(np.setxor1d(x, y))


def test_query_over_documents(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    want = brute([r.text for r in rows], 4, 85)
    out = QUERIES["op10_ngram_jaccard"](spark, SMALL).orderBy("doc_id")
    assert "Cartesian" not in plan(out)
    assert [tuple(r) for r in out.collect()] == [(r.doc_id, n, rows[c].doc_id) for r, (n, c) in zip(rows, want)]


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(501, 502), (502, 503), (503, 501), (7, 7)]
    out = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {out[i] for i in range(61)} == {0} and {out[1000 + i] for i in range(200)} == {1000}
    assert {out[i] for i in (501, 502, 503)} == {501} and len(out) == 61 + 200 + 3
    assert components(spark.createDataFrame([], "a long, b long")).select(F.col("id")).collect() == []


@pytest.mark.parametrize("texts", [["hello world"], ["a", "b"]])
def test_tables_with_fewer_words_than_a_shingle(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = [tuple(r)[1:] for r in J.groups(docs, words=4).orderBy("doc_id").collect()]
    assert found == brute(texts, 4, 80)


@pytest.mark.parametrize("words", [1, 4, 5])
def test_sets_of_chunks_with_few_words(words):
    for texts in (["hello world"], ["hello"], ["a b c"], ["a b", "c"], ["", "x"], [None], ["a b c d e", ""], []):
        sets = list(J.Shingler(words).sets(pa.array(texts, pa.string())))
        assert [len(s) for s in sets] == [len(shingles(t, words)) for t in texts]


def test_words_that_sums_of_powers_confuse():
    texts = []
    for length in (512, 1024, 2048):
        bits = [bin(i).count("1") & 1 for i in range(length)]
        texts += ["".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits), "".join("AB"[b] for b in bits)]
    sets = [s.tobytes() for s in J.Shingler(4).sets(pa.array(texts))]
    assert len(set(sets)) == 6 and sets[0] == sets[2] and sets[3] == sets[5]


def test_packed_numbers_come_back():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 3, 100, 5000):
        made = np.unique(rng.integers(0, 1 << 32, n, dtype=np.uint64)).astype(np.uint32)
        assert (J.unpacked(J.packed(made)) == made).all() and len(J.unpacked(J.packed(made))) == len(made)
    for ends in ([0], [2**32 - 1], [0, 2**32 - 1], list(range(9)), list(range(2**32 - 9, 2**32))):
        made = np.array(ends, np.uint32)
        assert J.unpacked(J.packed(made)).tolist() == ends


def test_texts_that_are_no_one_s_copy_stay_where_they_are(spark):
    texts = near_copies(9, 12, 4, 50, 0) + ["", None, "lone words that no other text has got"]
    rows = [(None if i == 5 else i, t) for i, t in enumerate(texts)]
    rows += [rows[0], rows[5], (7, texts[0]), rows[-1]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = J.keep_first(docs.withColumn("part", F.spark_partition_id()))
    # of the two sides of the union the one of unmoved rows has no exchange above the texts
    whole = kept._jdf.queryExecution().optimizedPlan().toString()
    assert whole.count("Deduplicate") + whole.count("first(part") == 1
    parent = brute([t for _, t in rows], 5, 80)
    names = {}
    for (n, c), (i, t) in zip(parent, rows):
        if n:
            names.setdefault(c, []).append((i is None, i or 0, i))
    want = sorted([str(min(ids)[2]) for ids in names.values()] + [str(i) for (n, _), (i, _) in zip(parent, rows) if not n])
    assert sorted(str(r.doc_id) for r in kept.collect()) == want
    stays = kept.withColumn("now", F.spark_partition_id()).filter("text like 'lone%' and doc_id is not null").count()
    assert stays == 1


def test_flags_miss_no_key(spark):
    keys = spark.range(-500, 500).select(F.xxhash64("id").alias("k"), (F.col("id") % 7 == 0).alias("some"))
    keys = keys.unionByName(spark.createDataFrame([(-(2**63), True), (2**63 - 1, True), (0, True), (1, False), (None, False)], "k long, some boolean"))
    told = flagged(keys, F.col("k"), keys.filter("some").select("k"), "flag").collect()
    assert len(told) == 1005 and all(r.flag for r in told if r.some)
    assert sum(r.flag for r in told if not r.some) < 10
    assert not any(r.flag for r in flagged(keys, F.col("k"), keys.limit(0).select("k"), "flag").collect())


def test_sets_move_for_few_pairs_of_a_group(spark, monkeypatch):
    """All pairs of a group of copies are near and up to six are looked up for each, but few are needed."""
    own = [f"w{i}" for i in range(200)]
    texts = [" ".join([*own[:i], f"x{i}", *own[i + 1 :]]) for i in range(0, 200, 10)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked = []
    exact = J.checked
    monkeypatch.setattr(J, "checked", lambda pairs, *rest: asked.append(pairs.count()) or exact(pairs, *rest))
    assert {r.component_id for r in J.groups(docs, 4, 85).collect()} == {0}
    assert len(texts) - 1 <= sum(asked) < 3 * len(texts)
