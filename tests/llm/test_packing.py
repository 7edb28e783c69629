import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from plaudit.llm import packing as P
from plaudit.llm.registry import QUERIES
from tests.conftest import SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def check(rows, texts, size):
    """Rows against the pieces that the library's ids give; returns the number of sequences."""
    want = []
    for key, text in texts:
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), size)):
            part = np.array(ids[at : at + size], "<u4")
            want.append((key, k, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(want, key=str)
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(held), -(-sum(w[3] for w in want) // size)


def test_query_packs_all_documents(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    used, least = check(QUERIES["op4_packing"](spark, SMALL).collect(), texts, 2048)
    assert used <= 1.02 * least + 1


def test_nulls_repeats_long_texts_and_no_rows(spark):
    texts = [(1, "a b c"), (1, "a b c"), (None, None), (2, ""), (3, "word " * 30_000), (4, "word " * 2047), (None, "x")]
    docs = spark.createDataFrame([(k, t, "z", 7) for k, t in texts], "doc_id long, text string, item string, length int")
    used, least = check(P.pack(docs, PATH).collect(), texts, 2048)
    assert used == least
    assert P.pack(docs.limit(0), PATH).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_operators_keep_packings_valid(seed):
    rng = np.random.default_rng(seed)
    block = P.Block(rng.integers(1, 2048, 300), 2048, seed)
    packings = [block.first(noise) for noise in (0.0, 0.1, 0.3)]
    made = [*packings, block.crossover(packings[0], packings[1]), block.crossover(packings[2], packings[0]), block.mutation(packings[1])]
    for packing in made:
        fills = block.fills(packing)
        assert len(packing) == 300 and fills.min() > 0 and fills.max() <= 2048
    best = block.evolve(packings, 30)
    assert block.fitness(best[0]) >= max(map(block.fitness, packings))


def test_evolution_beats_best_fit_where_it_wastes_room():
    """Triples that fill a bin exactly; largest-first does not find them all."""
    rng = np.random.default_rng(3)
    lengths = []
    for _ in range(40):
        a, b = rng.integers(300, 900, 2)
        lengths += [a, b, 2048 - a - b]
    block = P.Block(np.array(lengths), 2048, 1)
    first = [block.first(noise) for noise in (0.0, 0.05, 0.1, 0.2)]
    assert block.fitness(block.evolve(first, 300)[0]) > max(map(block.fitness, first))


def test_blocks_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_ITEMS", 50)
    items = spark.range(1000).selectExpr("id as item", "1 + id * 37 % 1500 as length")
    out = P.pack_items(items).toPandas()
    assert sorted(out["item"]) == list(range(1000)) and out.groupby("block").size().max() < 150
    assert (out.groupby(["block", "bin"])["length"].sum() <= 2048).all()


def test_evolution_gets_enough_work_to_beat_best_fit(spark):
    """Pieces that fill sequences in threes, packed with the settings of the query."""
    rng = np.random.default_rng(3)
    lengths = []
    for _ in range(40):
        a, b = rng.integers(300, 900, 2).tolist()
        lengths += [a, b, 2048 - a - b]
    items = spark.createDataFrame(list(enumerate(lengths)), "item long, length long")
    plain = P.Block(np.array(lengths), 2048, 0)
    out = P.pack_items(items).toPandas()
    assert sorted(out["item"]) == list(range(120))
    assert len(out.groupby(["block", "bin"])) < -plain.fitness(plain.first(0.0))[0]


def test_evolution_goes_on_while_it_gains():
    """The number of children without a gain ends an epoch, not the number of children."""
    rng = np.random.default_rng(3)
    lengths = []
    for _ in range(40):
        a, b = rng.integers(300, 900, 2).tolist()
        lengths += [a, b, 2048 - a - b]
    block, made = P.Block(np.array(lengths), 2048, 1), []
    cross = block.crossover
    block.crossover = lambda *parents: made.append(1) or cross(*parents)
    block.evolve(block.beginning(P.POPULATION), 20)
    assert len(made) > 20
