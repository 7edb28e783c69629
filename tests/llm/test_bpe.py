import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from plaudit.llm import bpe
from plaudit.llm.registry import QUERIES
from tests.conftest import SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")
RULES = bpe.load(PATH)
LIBRARY = Tokenizer.from_file(PATH)

TEXTS = [
    "Hello WORLD's it'll 'llama ''s don't 12½Ⅷ٣ ",
    "<|startoftext|>Hi<|endoftext|><|endoftext|>x <| y",
    "aaaaaaaaaaaaaaaaaaaaaaaaa ababababab",
    "ααΑΣ ΑΣΑ Σ İı ǅ é é ﬁ",
    "",
    "\x00\x01\x1c\x85\xa0​　漢字がが😀",
    "'s's'tt 're'",
]


def encode(texts):
    parts = list(bpe.Encoder(RULES).encode(texts))
    ids = np.concatenate([p[0] for p in parts] or [np.zeros(0, int)])
    ends = np.cumsum(np.concatenate([p[1] for p in parts] or [np.zeros(0, int)]))
    return [ids[a:b].tolist() for a, b in zip([0, *ends], ends)]


def library(texts):
    return [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def test_equals_the_library():
    assert encode(TEXTS) == library(TEXTS)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aabcdetEé' \n1½.-ßΣ<|>l")), max_size=40), max_size=5))
def test_equals_the_library_on_any_text(texts):
    assert encode(texts) == library(texts)


def test_equals_the_library_on_documents_in_small_blocks(spark, monkeypatch):
    texts = [r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    monkeypatch.setattr(bpe, "ROW_CHARS", 5_000)
    monkeypatch.setattr(bpe, "WORDS_AT_ONCE", 700)
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 2_000)
    encoder, ids = bpe.Encoder(RULES), []
    for start in range(0, len(texts), 17):
        for flat, counts in encoder.encode(texts[start : start + 17]):
            ends = np.cumsum(counts)
            ids += [flat[a:b].tolist() for a, b in zip([0, *ends], ends)]
    assert ids == library(texts)


def test_refuses_merges_out_of_order(tmp_path):
    import json

    spec = json.load(open(PATH))
    spec["model"]["merges"].append(spec["model"]["merges"].pop(0))
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="ascending"):
        bpe.load(str(tmp_path / "t.json"))


def test_round_trip_of_rows(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, None, "x"), (3, "again " * 30_000, "x"), (3, "x" * 50_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encoded = bpe.encode(docs, PATH)
    key = lambda r: (str(r[0]), r[1])
    want = [(i, LIBRARY.encode(t or "", add_special_tokens=False).ids) for i, t, _ in rows]
    assert sorted((tuple(r) for r in encoded.collect()), key=key) == sorted(want, key=key)
    decoded = [(i, LIBRARY.decode(ids, skip_special_tokens=False)) for i, ids in want]
    assert sorted((tuple(r) for r in bpe.decode(encoded, PATH).collect()), key=key) == sorted(decoded, key=key)
    assert bpe.encode(docs.limit(0), PATH).collect() == []


def test_query_over_documents(spark):
    want = {}
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        ids = LIBRARY.encode(r.text or "", add_special_tokens=False).ids
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        want[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in QUERIES["op8_bpe"](spark, SMALL).collect()} == want


def test_words_that_sums_of_powers_confuse():
    """A word of two letters and its letter-swapped twin have equal sums of powers modulo 2**64."""
    texts = []
    for length in (512, 1024, 2048):
        bits = [bin(i).count("1") & 1 for i in range(length)]
        texts += ["".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)]
    texts += ["x" * 64 + "y", "y" + "x" * 64, "x" * 65, "ab", "ba"]
    assert encode(texts) == library(texts)
