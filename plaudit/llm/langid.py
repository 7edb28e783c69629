"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, fixed by its code point.  A three-letter
window of a word (with a blank before and after the word) is bound into one vector: the
product of its letters' vectors, permuted by two, one and no steps.  A text is the bundle
(sum) of its windows; a language's prototype is the bundle of its labelled texts.  A text
gets the language whose prototype has the largest cosine with it.

Prototypes are sums of integers, added up by Spark per language and dimension, so they do
not depend on the layout.  All labelled texts count; nothing is sampled.  Only prototypes,
a row of ``DIMENSIONS`` numbers for each language, pass through the driver.

Defined cases: a text that is null or has no letter gets ``und`` and score 0, as do all
texts when nothing is labelled; ties go to the language first in order; languages that are
null or have no letters are not learned; null and repeated ``doc_id`` are kept, one output
row for each input row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plaudit.llm.chunks import LetterTable, released, text_chunks, texts_of

DIMENSIONS = 2048
UNKNOWN = "und"
CHUNK_BYTES = 1_000_000
SLICE = 1_000_000  # characters counted at once
TEXTS = 256  # texts with their bundles in memory
WINDOWS = 4096  # windows bound at once
SEED = 7


def letter_vector(code: int) -> np.ndarray:
    """Random signs of a letter; the blank around words (code 0) has one too."""
    return np.random.default_rng((SEED, code)).integers(0, 2, DIMENSIONS, dtype=np.int8) * 2 - 1


class Profiler:
    """Windows of texts, and the vectors they are bound to."""

    def __init__(self):
        self.is_letter = LetterTable(str.isalpha)
        self.vectors: dict[int, np.ndarray] = {}

    def letter(self, code: int) -> np.ndarray:
        if code not in self.vectors:
            self.vectors[code] = letter_vector(code)
        return self.vectors[code]

    def bind(self, windows: np.ndarray) -> np.ndarray:
        """Vectors of windows given as rows of three codes."""
        codes, at = np.unique(windows, return_inverse=True)
        letters = np.stack([self.letter(int(c)) for c in codes])
        a, b, c = at.reshape(windows.shape).T
        return np.roll(letters, 2, axis=1)[a] * np.roll(letters, 1, axis=1)[b] * letters[c]

    def windows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Window codes, packed into one number each, and the text that each is of."""
        joined = "\n" + "\n".join(texts) + "\n"
        lowered = joined.lower()
        if len(lowered) != len(joined):
            # a few letters become two: keep the texts apart
            texts = [text.lower() for text in texts]
            lowered = "\n" + "\n".join(texts) + "\n"
        codes = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        letter = self.is_letter[codes] == 1
        codes = np.where(letter, codes, 0)
        middle = np.flatnonzero(letter)
        packed = codes[middle - 1] << 42 | codes[middle] << 21 | codes[middle + 1]
        ends = np.cumsum([len(text) + 1 for text in texts])
        return packed, np.searchsorted(ends, middle - 1, side="right")

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct windows as rows of three codes, and the table texts x windows of counts."""
        packed, of = self.windows(texts)
        at, distinct = pd.factorize(packed)
        table = np.bincount(of * max(len(distinct), 1) + at, minlength=len(texts) * len(distinct))
        windows = np.stack([distinct >> 42, distinct >> 21 & 0x1FFFFF, distinct & 0x1FFFFF], axis=1)
        return windows, table.reshape(len(texts), len(distinct))

    def bundles(self, texts: list[str]) -> np.ndarray:
        """Sum of the window vectors of each text.  Sums stay exact: they are whole numbers,
        and a part has far fewer than 2**24 windows."""
        out = np.zeros((len(texts), DIMENSIONS), np.float64)
        for part, rows in self._parts(texts):
            windows, table = self.counts(part)
            for cut in range(0, len(windows), WINDOWS):
                made = self.bind(windows[cut : cut + WINDOWS]).astype(np.float32)
                np.add.at(out, rows, table[:, cut : cut + WINDOWS].astype(np.float32) @ made)
        return out

    def _parts(self, texts: list[str]) -> Iterator[tuple[list[str], list[int]]]:
        """Groups of texts for one table; a very long text goes in slices cut between words."""
        group: list[str] = []
        rows: list[int] = []
        size = 0
        for row, text in enumerate(texts):
            at = 0
            while at < len(text) or at == 0:
                end = self._cut(text, at)
                group.append(text[at:end])
                rows.append(row)
                size += end - at
                if size > SLICE or len(group) >= TEXTS:
                    yield group, rows
                    group, rows, size = [], [], 0
                at = max(end, 1)
        if group:
            yield group, rows

    def _cut(self, text: str, at: int) -> int:
        end = min(len(text), at + SLICE)
        while end < len(text) and text[end - 1].isalpha() and text[end].isalpha():
            end += 1
        return end


def row_chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for chunk in text_chunks(batch, most=CHUNK_BYTES):
        for at in range(0, chunk.num_rows, TEXTS):
            yield chunk.slice(at, TEXTS)


def learn(labelled: DataFrame) -> DataFrame:
    """Prototypes: rows (lang, dimension, value) from columns ``text`` and ``lang``."""

    def run(batches):
        profiler = Profiler()
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for chunk in text_chunks(batch, most=CHUNK_BYTES):
                langs = np.array(chunk.column("lang").to_pylist(), dtype=object)
                texts = texts_of(chunk)
                for lang in dict.fromkeys(langs):
                    mine = [texts[i] for i in np.flatnonzero(langs == lang)]
                    # texts of one language count together, in slices as for a single long text
                    total = profiler.bundles(["\n".join(mine)])[0]
                    sums[lang] = sums.get(lang, 0) + total
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * DIMENSIONS, pa.string()),
                    pa.array(np.arange(DIMENSIONS), pa.int32()),
                    pa.array(total.astype(np.int64)),
                ],
                ["lang", "dimension", "value"],
            )

    known = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    parts = known.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(released(run), "lang string, dimension int, value long")
    return parts.groupBy("lang", "dimension").agg(F.sum("value").alias("value"))


def collect_prototypes(prototypes: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and their unit prototypes; languages without letters are left out."""
    rows = prototypes.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("dimension", "value"))).alias("v")).orderBy("lang").collect()
    found = [(r["lang"], np.array([x["value"] for x in r["v"]], np.float64)) for r in rows]
    found = [(lang, v / np.linalg.norm(v)) for lang, v in found if v.any()]
    return [lang for lang, _ in found], np.array([v for _, v in found]).reshape(len(found), DIMENSIONS)


class Judge:
    """Language and cosine of the rows of a chunk."""

    def __init__(self, langs: list[str], units: np.ndarray):
        self.langs, self.units = np.array(langs, dtype=object), units
        self.profiler = Profiler()

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        bundles = self.profiler.bundles(texts)
        norms = np.linalg.norm(bundles, axis=1)
        has = (norms > 0) & bool(len(self.langs))
        names, scores = np.full(len(bundles), UNKNOWN, dtype=object), np.zeros(len(bundles))
        if has.any():
            cosine = (bundles[has] @ self.units.T) / norms[has, None]
            best = cosine.argmax(axis=1)
            names[has] = self.langs[best]
            scores[has] = cosine[np.arange(len(best)), best].clip(0, 1)
        return names, scores


def predict(docs: DataFrame, prototypes: DataFrame) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (cosine with the winner, 0 to 1)."""
    langs, units = collect_prototypes(prototypes)

    def run(batches):
        judge = Judge(langs, units)
        for batch in batches:
            for chunk in row_chunks(batch):
                names, scores = judge(texts_of(chunk))
                yield pa.RecordBatch.from_arrays(
                    [chunk.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"]
                )

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(released(run), f"doc_id {key}, lang_pred string, score double")


def keep(docs: DataFrame, prototypes: DataFrame, least_cosine: float, least_chars: int) -> DataFrame:
    """Rows whose text has letters and, from ``least_chars`` characters on, a cosine of at
    least ``least_cosine`` with some language.  Without any language, all rows with letters."""
    langs, units = collect_prototypes(prototypes)

    def run(batches):
        judge = Judge(langs, units)
        for batch in batches:
            for chunk in row_chunks(batch):
                texts = texts_of(chunk)
                names, scores = judge(texts)
                short = np.fromiter((len(t) < least_chars for t in texts), bool, len(texts))
                good = (names != UNKNOWN) & (short | (scores >= least_cosine))
                if not langs:
                    good = np.fromiter((any(map(str.isalpha, t)) for t in texts), bool, len(texts))
                yield chunk.filter(pa.array(good))

    return docs.mapInArrow(released(run), docs.schema)


def held_out(doc_id="doc_id"):
    """Rows whose label is kept from training."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the labelled rows that are not held out, and predict all rows."""
    found = predict(docs, learn(docs.filter(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
