import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plaudit.llm import kneser_ney as K
from plaudit.llm.registry import QUERIES
from tests.conftest import SMALL, plan


class Plain:
    """The model by its definition, with dictionaries."""

    def __init__(self, texts):
        self.counts = {K.ORDER: Counter(g for t in texts for g in self.grams(t))}
        for size in range(K.ORDER - 1, 0, -1):
            self.counts[size] = Counter(g[1:] for g in self.counts[size + 1])
        self.d, self.context = {}, {}
        for size, counts in self.counts.items():
            n1, n2, n3, n4 = (max(1, sum(c == i for c in counts.values())) for i in (1, 2, 3, 4))
            y = n1 / (n1 + 2 * n2)
            raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
            self.d[size] = [0, *(min(max(d, 0.05), i - 0.05) for i, d in enumerate(raw, 1))]
            stats = defaultdict(lambda: [0, 0.0])
            for gram, c in counts.items():
                stats[gram[:-1]][0] += c
                stats[gram[:-1]][1] += self.d[size][min(c, 3)]
            self.context[size] = stats

    def letters(self, text):
        return [ord(c) + 1 for c in " ".join((text or "").split())]

    def grams(self, text):
        row = [0] * (K.ORDER - 1) + self.letters(text)
        return [tuple(row[i : i + K.ORDER]) for i in range(len(row) - K.ORDER + 1)]

    def p(self, gram):
        if not gram:
            return 1 / K.LETTERS
        size = len(gram)
        lower = self.p(gram[1:])
        if gram[:-1] not in self.context[size]:
            return lower
        total, taken = self.context[size][gram[:-1]]
        c = self.counts[size].get(gram, 0)
        return (max(c - self.d[size][min(c, 3)], 0) if c else 0) / total + taken / total * lower

    def nats(self, text):
        grams = self.grams(text)
        return -sum(math.log(self.p(g)) for g in grams) / len(grams) if grams else None


TRUSTED = ["the cat sat on the mat", "a dog, a log; the end.", "\u00e9t\u00e9 \u00e0 la mer \u6f22\u5b57", "HELLO World 12"]
TEXTS = ["the cat", "zzz!! ZZZ", "", None, "  \n ", "mer\n\n the   end", "\u6f22 \u00e9 \U0001f600", "the cat " * 40_000, "hello"]


@pytest.mark.parametrize("common, size", [(1, 40), (30, 300), (K.COMMON, K.CHUNK_BYTES)])
def test_scores_equal_the_plain_model(spark, monkeypatch, common, size):
    """With nearly all costs in the shards, with some, and with all at hand."""
    monkeypatch.setattr(K, "COMMON", common)
    monkeypatch.setattr(K, "CHUNK_BYTES", size)
    rows = [(i, t, "x", "n") for i, t in enumerate(TEXTS)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, nats string").repartition(3)
    trusted = spark.createDataFrame([(t,) for t in TRUSTED + [None, ""]], "text string").repartition(2)
    found = K.fit(docs, trusted)
    often, known = K.common(found)
    assert len(known[0]) <= common and (common > 1000) == (found.filter(~often).count() == 0)
    out = K.score(docs, found).collect()
    model = Plain(TRUSTED)
    assert len(out) == len(rows)
    for r in out:
        want = model.nats(TEXTS[r.doc_id])
        assert r.nats == (None if want is None else pytest.approx(want, rel=1e-5))


def test_more_letters_than_sixteen_bits(spark):
    """N-grams are the same whether places are taken at once or in slices."""
    text = "".join(map(chr, [*range(0x3400, 0xD800), *range(0x20000, 0x2A000)]))
    padded, at, lengths = K.windows([text, "abc"])
    made = [(int(c), int(w)) for (cs, ws), which, _ in K.distinct(padded, at) for c, w in zip(cs[which], ws[which])]
    letters = [0, 0, 0, *(ord(x) + 1 for x in text)]
    want = [(letters[i] << 42 | letters[i + 1] << 21 | letters[i + 2], letters[i + 3]) for i in range(len(text))]
    assert made[: len(text)] == want and len(made) == len(text) + 3 and lengths.tolist() == [len(text), 3]


def test_what_is_gathered_grows_with_the_corpus(spark):
    texts = spark.range(400).select("id", F.base64(F.unhex(F.sha2(F.col("id").cast("string"), 256))).alias("text"))
    sizes = [K.count_grams(texts.filter(F.col("id") < n)).count() for n in (100, 400)]
    assert sizes[0] > 1000 and sizes[1] > 3.5 * sizes[0]


def test_probabilities_sum_to_one():
    model = Plain(TRUSTED)
    letters = {c + 1 for t in TRUSTED for c in map(ord, t)} | {0}
    for context in [(0, 0, 0), (1, 2, 3), (117, 105, 102)]:
        unseen = model.p((*context, 9))
        assert sum(model.p((*context, w)) for w in letters) + (K.LETTERS - len(letters)) * unseen == pytest.approx(1)


def test_packed_numbers_come_back():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000):
        numbers = np.unique(rng.integers(0, 2**64 - 1, n, dtype=np.uint64, endpoint=True))
        assert (K.unplaned(K.planes(numbers)) == numbers).all()


def test_limits_shrink_towards_the_common_one(spark):
    """A language with few held-out texts has no switch of its own."""
    texts = ["w%d w%d w%d" % (i % 5, i % 7, i % 11) for i in range(300)]
    rows = [(i, t, "aa" if i % 30 else "bb") for i, t in enumerate(texts)] + [(1000, "w1 w2 w3", None), (1001, "w1 w2 w3", "cc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in K.judge(docs, labels).collect()}
    assert len(out) == 302 and out[1000].limit == pytest.approx(out[1001].limit)
    one, two, none = (math.log(out[i].limit) for i in (1, 30, 1000))
    assert abs(one - none) < 1 and abs(two - none) < 1


def test_quantiles_count_all_rows(spark):
    rng = np.random.default_rng(0)
    rows = [("ab"[i % 2], float(v) + i % 2) for i, v in enumerate(rng.random(2000))] + [(None, 5.0), ("a", None)]
    out = {r.lang: (r.limit, r.texts) for r in K.quantiles(spark.createDataFrame(rows, "lang string, nats double"), 0.9).collect()}
    for lang in ("a", "b"):
        mine = sorted(v for k, v in rows if k == lang and v is not None)
        assert out[lang][0] == pytest.approx(mine[int(0.9 * len(mine)) - 1], abs=2 * K.BIN) and out[lang][1] == 1000
    assert out[None][1] == 2001


def test_nulls_repeats_no_labels_and_no_rows(spark):
    rows = [(1, "some words here", "en"), (1, "some words here", "en"), (None, "other words", None), (2, None, "en"), (3, " ", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = sorted((str(r.doc_id), r.kept) for r in K.judge(docs, labels).collect())
    assert out == [("1", True), ("1", True), ("2", False), ("3", False), ("None", True)]
    assert K.keep(docs, labels).count() == 3
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (5, 1, None)], "doc_id long, quality int, toxic int")
    assert [r.doc_id for r in K.trusted_ids(labels).collect()] == [5]
    assert K.judge(docs.limit(0), labels).collect() == []


def test_query_separates_labelled_documents(spark):
    sf = SMALL.replace("0.001", "0.01")
    out = QUERIES["op2_quality"](spark, sf)
    assert "Cartesian" not in plan(out)
    kept = {r.doc_id: r.kept for r in out.collect()}
    assert len(kept) == 1000
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    clean = [kept[r.doc_id] for r in labels if r.quality == 1 and not r.toxic]
    junk = [kept[r.doc_id] for r in labels if r.quality == 0]
    assert np.mean(clean) >= 0.99 and np.mean(junk) <= 0.15


def test_other_scripts_and_gibberish_go_and_copies_stay(spark):
    sf = SMALL.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text"), spark.read.parquet(f"{sf}/labels.parquet")
    rng = random.Random(1)
    other = ["\u043f\u0440\u0438\u0432\u0435\u0442", "\u043c\u0438\u0440", "\u0434\u043e\u043c", "\u0441\u043b\u043e\u0432\u043e"]
    ids = {r.doc_id for r in labels.collect() if r.quality == 1 and not r.toxic}
    clean = [r for r in docs.filter("length(text) > 200").collect() if r.doc_id in ids][:50]
    planted = [(10_000 + i, r.lang, r.text) for i, r in enumerate(clean)]
    planted += [(20_000 + i, r.lang, " ".join(rng.choices(other, k=80))) for i, r in enumerate(clean)]
    planted += [(30_000 + i, r.lang, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz    ", k=500))) for i, r in enumerate(clean)]
    out = K.judge(docs.unionByName(spark.createDataFrame(planted, docs.schema)), labels).collect()
    kept = {kind: np.mean([r.kept for r in out if r.doc_id // 10_000 == kind]) for kind in (1, 2, 3)}
    assert kept[1] >= 0.98 and kept[2] <= 0.1 and kept[3] <= 0.1
