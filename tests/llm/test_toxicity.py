"""The clause grammar against its rules in words, counting against plain sets, and held-out rows."""

import random
import zlib

import pytest

from plaudit.llm import toxicity as T

LEXICON = {"idiot ": 3.0, "scu": 2.0}


def by_rules(text):
    """Clause weights from the positions of cues, without an automaton."""
    out = []
    for clause in T.CLAUSE.findall(text.lower()):
        words = T.WORD.findall(clause)
        kinds = [T.INSULT if w == "idiot" or w.startswith("scu") else T.CUES.get(w, T.OTHER) for w in words]
        found = []
        for i, (word, kind) in enumerate(zip(words, kinds)):
            aimed = T.TARGET in kinds[max(0, i - T.NEAR) : i]
            if kind == T.INSULT:
                weight = (3.0 if word == "idiot" else 2.0) * (T.AIMED if aimed else 1)
            elif kind == T.THREATENS and aimed:
                weight = T.THREAT * T.AIMED
            else:
                continue
            weight *= T.NEGATED if T.NEGATION in kinds[max(0, i - T.SCOPE) : i] else 1
            weight *= T.REPORTED if T.REPORT in kinds[:i] else 1
            found.append(weight)
        out.append(sum(sorted(found, reverse=True)[: T.BEST]))
    return sum(sorted(out, reverse=True)[: T.TOP])


def test_automaton_follows_the_rules():
    r = random.Random(5)
    words = ["you", "Idiot", "scumbag", "not", "said", "kill", "tree", "they", "nie", "call", "calls", "é", "scu9x"]
    scorer = T.Scorer(LEXICON)
    for _ in range(400):
        text = "".join(r.choice(words) + r.choice([" ", " ", " ", ", ", ". ", "\n", "! "]) for _ in range(r.randrange(40)))
        assert scorer.evidence(text) == pytest.approx(by_rules(text), abs=1e-12)


def test_context_changes_the_score():
    scorer = T.Scorer(LEXICON)
    plain, aimed, negated, reported = map(scorer.evidence, ("an idiot", "you idiot", "not an idiot", "he said an idiot"))
    assert negated < plain < aimed and reported < scorer.evidence("he an idiot")
    assert scorer.evidence("kill the process") == 0 < scorer.evidence("i will find you and kill")
    assert scorer.evidence("") == scorer.evidence("... 12 \n") == 0


def test_long_clauses_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(T, "SLICE_CHARS", 30)
    text = "tree " * 100 + "idiot " + "scumbag " * 30
    assert "".join(T.clauses(text)) == text and all(c.strip() for c in T.clauses("x" * 100 + " " + "y" * 100))
    assert T.Scorer(LEXICON).evidence(text) >= 3


def test_contexts_are_counted_once(spark, rows):
    texts = [(0, 1, "You idiot there. You idiot there."), (0, 1, "You idiot there"), (0, 0, "an idiot"), (1, 1, None)]
    df = spark.createDataFrame(texts, "half int, toxic int, text string").repartition(3)
    plain = {}
    for half, toxic, text in texts:
        words = T.WORD.findall((text or "").lower())
        for i, word in enumerate(words):
            near = (words[i - 1] if i else "", words[i + 1] if i + 1 < len(words) else "")
            for entry in T.entries_of(word):
                plain.setdefault((half, toxic, entry), set()).add((word, near))
    assert rows(T.count_contexts(df)) == sorted(((*k, len(v)) for k, v in plain.items()), key=repr)


def planted(n=900):
    r = random.Random(3)
    parts = "ra to le mi su da fo ke pu na".split()
    word = lambda: "".join(r.choice(parts) for _ in range(r.randrange(1, 5)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(r.randrange(20, 80))]
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(4):
                words.insert(r.randrange(len(words)), r.choice(["grobian", "lump", "depp"]))
        docs.append((i, " ".join(words) + ".", "clash", 1))
        labels.append((i, 1, toxic))
    return docs, labels


def tables(spark, docs, labels):
    return (
        spark.createDataFrame(docs, "doc_id long, text string, toxic string, half int").repartition(3),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_held_out_rows_are_told_apart(spark):
    docs, labels = planted()
    docs += [(None, "grobian lump", None, None), (5000, None, None, None), (5001, "", None, None)] + docs[:5]
    labels += [(None, 1, 1), (3, None, None), (999_999, 1, 1)]
    out = T.judge(*tables(spark, docs, labels)).collect()
    assert len(out) == len(docs)
    truth = {i: t for i, _, t in labels if t is not None}
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    known = [r for r in held if r["doc_id"] in truth]
    caught = [r["predicted"] for r in known if truth[r["doc_id"]]]
    clean = [r["predicted"] for r in known if not truth[r["doc_id"]]]
    assert sum(caught) >= 0.95 * len(caught) > 10 and sum(clean) <= 0.02 * len(clean)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    quiet = {r["doc_id"]: r["score"] for r in out if r["doc_id"] in (5000, 5001)}
    assert quiet[5000] == quiet[5001] < 0.5


def test_held_out_labels_teach_nothing(spark, rows):
    docs, labels = planted(300)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    assert rows(T.judge(*tables(spark, docs, labels))) == rows(T.judge(*tables(spark, docs, turned)))


def test_nothing_to_learn_from(spark):
    docs, labels = planted(20)
    for some in ([], [r for r in labels if r[2]], [(i, 1, None) for i, _, _ in labels]):
        out = T.judge(*tables(spark, docs, some)).collect()
        assert len(out) == 20 and all(r["score"] == T.UNKNOWN and r["predicted"] == 0 for r in out)
    docs_df, labels_df = tables(spark, docs, labels)
    assert T.judge(docs_df.limit(0), labels_df).count() == 0


def test_query_on_the_given_tables(spark):
    from plaudit.llm.registry import QUERIES
    from tests.conftest import SMALL

    out = QUERIES["op13_toxicity"](spark, SMALL)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert out.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
