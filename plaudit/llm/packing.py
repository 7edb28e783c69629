"""Best-fit packing of token sequences with a grouping genetic algorithm on islands.

Pieces of documents are dealt by hash into blocks of about ``BLOCK_ITEMS``, so a task's work
does not grow with the corpus.  Each block has ``ISLANDS`` populations of packings.  A
crossover injects whole well-filled bins of one packing into another, takes out the bins
that hold pieces twice, and places the displaced pieces best-fit, largest first.  An epoch of an
island ends when ``PATIENCE`` children in a row gave no better best packing, or at the lower
bound.  After each epoch the best packing of every island moves to the next island of its
block.  Bins that end poorly filled are dissolved and their pieces, from all blocks, packed once more.

Defined cases: a null text is an empty one and has only the closing token; null and repeated
``doc_id`` are kept, each input row is packed for itself; ties between packings go to the
island with the smaller number; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plaudit.llm import bpe
from plaudit.llm.chunks import released
from plaudit.staging import stage

SIZE = 2048
CLOSING = 0
BLOCK_ITEMS = 4096
ISLANDS = 4
POPULATION = 16
NOISES = (0.0, 0.02, 0.05, 0.1, 0.2)  # of the lengths by which first packings are ordered, in turn
PATIENCE = 100
EPOCHS = 4
WELL_FILLED = 0.99
POORLY_FILLED = 0.95

STATE = "block long, island int, items array<long>, lengths array<int>, population array<binary>, elite binary, bins int, squares double"


def pieces(docs: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32): each document's ids and the closing
    token, cut where they are longer than ``size``."""
    rules = bpe.load(path)

    def run(batches):
        for chunk, ids, offsets in bpe.encoded_chunks(batches, rules):
            row, piece, start, length, crc = [], [], [], [], []
            for n, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                own = np.append(ids[a:b], CLOSING).astype("<u4")
                for k, at in enumerate(range(0, len(own), size)):
                    part = own[at : at + size]
                    row.append(n)
                    piece.append(k)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(released(run), f"doc_id {key}, piece int, start long, length long, ids_crc32 long")


class Block:
    """Packings of the items of one block: for each item the number of its bin."""

    def __init__(self, lengths: np.ndarray, size: int, seed):
        self.lengths, self.size = lengths, size
        self.random = np.random.default_rng(seed)
        self.least = -(-int(lengths.sum()) // size)

    def fills(self, packing: np.ndarray) -> np.ndarray:
        return np.bincount(packing, self.lengths).astype(np.int64)

    def fitness(self, packing: np.ndarray) -> tuple[int, float]:
        """Few bins, then bins that are full rather than even."""
        fills = self.fills(packing)
        return -len(fills), float(np.square(fills / self.size).sum())

    def best_fit(self, packing: np.ndarray, loose: np.ndarray, fills: list[int]) -> None:
        """Put each loose item where it leaves the least room, or into a new bin."""
        gaps = sorted((self.size - fill, number) for number, fill in enumerate(fills) if fill < self.size)
        count = len(fills)
        lengths = self.lengths
        for item in loose.tolist():
            need = int(lengths[item])
            at = bisect.bisect_left(gaps, (need, -1))
            if at < len(gaps):
                gap, number = gaps.pop(at)
            else:
                gap, number = self.size, count
                count += 1
            packing[item] = number
            if gap > need:
                bisect.insort(gaps, (gap - need, number))

    def largest_first(self, items: np.ndarray, noise: float = 0.0) -> np.ndarray:
        weight = self.lengths[items] * (1 + noise * self.random.standard_normal(len(items)))
        return items[np.argsort(-weight, kind="stable")]

    def first(self, noise: float) -> np.ndarray:
        packing = np.zeros(len(self.lengths), np.int32)
        self.best_fit(packing, self.largest_first(np.arange(len(packing)), noise), [])
        return packing

    def beginning(self, most: int) -> list[np.ndarray]:
        """First packings, the plain best-fit one before others; none after one at the lower bound."""
        made = []
        for n in range(most):
            made.append(self.first(NOISES[n % len(NOISES)] if n else 0.0))
            if -self.fitness(made[-1])[0] <= self.least:
                break
        return made

    def without(self, packing: np.ndarray, gone: np.ndarray, injected: np.ndarray | None = None, donor: np.ndarray | None = None) -> np.ndarray:
        """Packing without the bins marked ``gone``; items ``injected`` go as ``donor`` has them,
        the others of those bins are placed again."""
        staying = ~gone[packing]
        child = np.full(len(packing), -1, np.int64)
        child[staying] = packing[staying]
        if injected is not None:
            child[injected] = donor[injected].astype(np.int64) + len(gone)
        placed = child >= 0
        child[placed] = np.unique(child[placed], return_inverse=True)[1]
        count = int(child.max(initial=-1)) + 1
        fills = np.bincount(child[placed], self.lengths[placed], minlength=count).astype(np.int64).tolist()
        made = child.astype(np.int32)
        self.best_fit(made, self.largest_first(np.flatnonzero(~placed), 0.02), fills)
        return made

    def crossover(self, into: np.ndarray, donor: np.ndarray) -> np.ndarray:
        fills = self.fills(donor)
        good = (fills >= WELL_FILLED * self.size) & (self.random.random(len(fills)) < self.random.uniform(0.05, 0.3))
        injected = good[donor]
        gone = np.zeros(int(into.max()) + 1, dtype=bool)
        gone[into[injected]] = True
        return self.without(into, gone, injected, donor)

    def mutation(self, packing: np.ndarray) -> np.ndarray:
        """Dissolve the emptier bins and a few others."""
        fills = self.fills(packing)
        gone = (fills < WELL_FILLED * self.size) | (self.random.random(len(fills)) < 0.03)
        return self.without(packing, gone)

    def evolve(self, population: list[np.ndarray], patience: int) -> list[np.ndarray]:
        """The population after ``patience`` children in a row without a better best one, best first."""
        ranked = sorted(((self.fitness(p), n, p) for n, p in enumerate(population)), key=lambda x: (x[0], -x[1]), reverse=True)
        ranked = [(fit, p) for fit, _, p in ranked][:POPULATION]
        idle = 0
        while idle < patience and -ranked[0][0][0] > self.least:
            best = ranked[0][0]
            mother, father = self.random.choice(len(ranked), 2, replace=len(ranked) < 2)
            child = self.crossover(ranked[mother][1], ranked[father][1])
            if self.random.random() < 0.5:
                child = self.mutation(child)
            made = self.fitness(child)
            if made > ranked[-1][0] and all(made != fit for fit, _ in ranked):
                ranked[-1] = (made, child)
                ranked.sort(key=lambda x: x[0], reverse=True)
            idle = 0 if ranked[0][0] > best else idle + 1
        return [p for _, p in ranked]


def evolve(state: DataFrame, epoch: int, size: int) -> DataFrame:
    """One epoch on every island."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(np.array(row["lengths"], np.int64), size, (row["block"], row["island"], epoch))
                population = [np.frombuffer(p, np.int32) for p in row["population"]]
                if not population:
                    population = block.beginning(POPULATION)
                population = block.evolve(population, PATIENCE)
                bins, squares = block.fitness(population[0])
                made = {**row, "population": [p.tobytes() for p in population], "elite": population[0].tobytes(), "bins": -bins, "squares": squares}
                yield pa.RecordBatch.from_pylist([made], batch.schema)

    return state.mapInArrow(released(run), STATE)


def pack_items(items: DataFrame, size: int = SIZE) -> DataFrame:
    """Rows (item, length, block, bin, offset, fill) for rows (item, length) of positive
    lengths up to ``size``."""
    blocks = max(1, -(-items.count() // BLOCK_ITEMS))
    dealt = items.groupBy(F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("length", "item"))).alias("_i")
    )
    state = dealt.select(
        "block",
        F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
        F.col("_i.item").alias("items"),
        F.col("_i.length").cast("array<int>").alias("lengths"),
        F.array().cast("array<binary>").alias("population"),
        F.lit(None).cast("binary").alias("elite"),
        F.lit(0).alias("bins"),
        F.lit(0.0).alias("squares"),
    )
    for epoch in range(EPOCHS):
        state = stage(evolve(state.repartition("block", "island"), epoch, size), "islands")
        if epoch + 1 < EPOCHS:
            movers = state.select("block", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("elite").alias("_guest"))
            joined = state.join(movers, ["block", "island"])
            state = joined.withColumn("population", F.concat("population", F.array("_guest"))).select(*state.columns)
    best = state.groupBy("block").agg(
        F.max_by(F.struct("items", "lengths", "elite"), F.struct(-F.col("bins"), "squares", -F.col("island"))).alias("_b")
    )

    def place(batches):
        for batch in batches:
            for row in batch.to_pylist():
                item, length = np.array(row["items"], np.int64), np.array(row["lengths"], np.int64)
                bins = np.frombuffer(row["elite"], np.int32).astype(np.int64)
                order = np.argsort(bins, kind="stable")
                item, length, bins = item[order], length[order], bins[order]
                before = np.cumsum(length) - length
                first = np.concatenate([[True], bins[1:] != bins[:-1]])
                offset = before - np.repeat(before[first], np.diff(np.flatnonzero(first), append=len(bins)))
                fill = np.bincount(bins, length).astype(np.int64)[bins]
                columns = [item, length, np.full(len(item), row["block"], np.int64), bins, offset, fill]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["item", "length", "block", "bin", "offset", "fill"])

    return best.select("block", "_b.*").mapInArrow(released(place), "item long, length long, block long, bin long, offset long, fill long")


def pack(docs: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """Pieces of all documents with their ``sequence_id`` and ``offset``."""
    cut = stage(pieces(docs, path, size).withColumn("item", F.monotonically_increasing_id()), "pieces")
    whole = cut.filter(F.col("length") == size).select("item", (F.col("item") * 3).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    # bin numbers stay below the number of items of a block
    number = lambda turn: (F.col("block") * (1 << 24) + F.col("bin")) * 3 + turn
    first = stage(pack_items(cut.filter(F.col("length") < size).select("item", "length"), size), "packed")
    poor = F.col("fill") < POORLY_FILLED * size
    again = pack_items(first.filter(poor).select("item", "length"), size)
    placed = whole.unionByName(first.filter(~poor).select("item", number(1).alias("sequence_id"), "offset")).unionByName(
        again.select("item", number(2).alias("sequence_id"), "offset")
    )
    return cut.join(placed, "item").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
