"""Arrow batches of texts in pieces of bounded size, for functions in Python workers."""

from __future__ import annotations

import ctypes
import functools
import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 3_000_000
LONG_WORD = 64  # letters; longer words get a cryptographic hash


def text_chunks(batch: pa.RecordBatch, column: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch`` with about ``most`` bytes of text; a longer text is a
    chunk of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    # row i opens a chunk when its end passes into the next stretch of `most` bytes
    stretch = (np.cumsum(sizes) - 1).clip(0) // most
    cuts = [0, *(np.flatnonzero(np.diff(stretch)) + 1).tolist(), len(sizes)]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


class LetterTable:
    """A small number for each code point, worked out when the code point first occurs."""

    UNSEEN = 255

    def __init__(self, number):
        self.number = number
        self.table = np.full(sys.maxunicode + 1, self.UNSEEN, np.uint8)

    def __getitem__(self, codes: np.ndarray) -> np.ndarray:
        found = self.table[codes]
        if (found == self.UNSEEN).any():
            for code in np.unique(codes[found == self.UNSEEN]).tolist():
                self.table[code] = self.number(chr(code))
            found = self.table[codes]
        return found


def word_digest(word: bytes) -> int:
    """64 bits of a cryptographic hash: sums over letters can be made to collide in long words."""
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def released(run):
    """``run`` for batches that gives its freed memory back when the task ends, as workers are
    kept for later tasks and share the executor's memory."""

    @functools.wraps(run)
    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except AttributeError:  # another C library
            pass

    return wrapped


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts, null as empty."""
    return [text or "" for text in batch.column(column).to_pylist()]


def runs(batches, key: str, most: int | None = None):
    """Runs of rows with one value of ``key`` in sorted batches, also across batches; with
    ``most``, in pieces of that many rows."""
    held: list[pa.Table] = []
    value = None

    def whole():
        rows = pa.concat_tables(held)
        step = most or max(1, rows.num_rows)
        for at in range(0, rows.num_rows, step):
            yield value, rows.slice(at, step)

    for batch in batches:
        keys = batch.column(key).to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]])) if len(keys) else []
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and keys[a] != value:
                yield from whole()
                held = []
            value = keys[a]
            held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
            if most and sum(t.num_rows for t in held) >= 8 * most:
                yield from whole()
                held = []
    if held:
        yield from whole()
