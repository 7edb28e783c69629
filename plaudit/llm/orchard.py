r"""Vector codes: each vector's parts are named by their nearest codebook entries.

Components become integers ``floor(4096 * x)``, vectors are cut into eight parts, and each part
position has a codebook of 16 entries, improved in six rounds of assigning and averaging.  All
arithmetic is in integers, so codes, errors and codebooks do not depend on how rows are dealt.

*Nearest entries* come from Orchard's search.  For every entry the others are listed by their
distance from it.  A search looks at the list of its present entry, in order; a nearer entry
becomes the present one and its list is looked at; entries seen before are passed over.
An entry beyond twice the distance to the present one cannot be nearer, nor can any after it
in the list, so the search ends there.  Only strictly farther entries end it, so ties, which go
to the lower index, are all seen.

A round is one pass over the vectors: a task adds up, over all its rows, the parts of each entry,
and sends these sums, 16 times as many numbers as a vector has.  The sums of all tasks meet by
entry and component.  Only codebooks reach the driver: 16 vectors for each vector length.

Defined cases: vectors that are null or hold null or non-finite components are dropped; zero
and empty vectors stay.  Vectors of each length have codebooks of their own.  Lengths that are
no multiple of eight are filled up with zeros, which are in no codebook.  Entries start from the
smallest ``vec_id`` (null last, of equal ones the smaller bytes), or from all vectors if fewer.
Repeated rows count as often as they occur.  Components of any finite size are exact; an error
beyond a long is null, as is the sum of its label.  Other columns are ignored; no rows give none.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from plaudit.staging import stage

PARTS = 8
ENTRIES = 16
ROUNDS = 6
STEPS = 4096  # of a unit
LIMB_BITS = 32  # sums travel in pieces of so many bits
LARGEST = (1 << 63) - 1
SALTS = 256  # tasks that share the rows of one label

Codebooks = dict[int, list[list[list[int]]]]  # by vector length: part, entry, component


def width(size: int) -> int:
    """Components of a part."""
    return -(-size // PARTS)


def short(size: int) -> int:
    """Components up to this have squared distances that fit 64 bits."""
    return math.isqrt((1 << 60) // max(1, width(size))) // 2


def integers(rows: np.ndarray) -> np.ndarray:
    """Floors of ``STEPS`` times the components, as 64-bit or, for large ones, Python numbers."""
    if not rows.size or np.abs(rows).max() * STEPS < short(rows.shape[1]):
        return np.floor(rows * STEPS).astype(np.int64)
    exact = [int(x) * STEPS if abs(x) > 1 << 60 else math.floor(x * STEPS) for x in rows.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(rows.shape)


def in_parts(numbers: np.ndarray) -> np.ndarray:
    """Rows (vector, part) of integer components."""
    n, size = numbers.shape
    filled = np.zeros((n, PARTS * width(size)), numbers.dtype)
    filled[:, :size] = numbers
    return filled.reshape(n * PARTS, width(size))


def vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in the batch and rows of the vectors that take part, by length; those with large
    components come apart from the others."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    values = column.flatten()
    numbers = pc.cast(values, pa.float64()).to_numpy(zero_copy_only=False)
    bad = ~np.isfinite(numbers)
    taken = lengths.clip(0)
    owner = np.repeat(np.arange(len(lengths)), taken)
    starts = np.cumsum(taken) - taken
    wrong = np.bincount(owner[bad], minlength=len(lengths)) > 0
    for size in np.unique(lengths[(lengths >= 0) & ~wrong]).tolist():
        at = np.flatnonzero((lengths == size) & ~wrong)
        rows = numbers[starts[at][:, None] + np.arange(size)]
        large = (np.abs(rows) * STEPS >= short(size)).any(axis=1)
        for pick in (~large, large):
            if pick.any():
                yield at[pick], rows[pick]


class Lists:
    """Codebooks of one vector length with, for each entry, the others by distance."""

    def __init__(self, books: list[list[list[int]]], size: int):
        self.size = size
        small = max((abs(x) for book in books for entry in book for x in entry), default=0) < short(size)
        self.entries = np.array(books, dtype=np.int64 if small else object).reshape(PARTS, len(books[0]), width(size))
        self.count = len(books[0])
        gaps = squares(self.entries[:, :, None, :] - self.entries[:, None, :, :])
        self.order = np.argsort(gaps, axis=2, kind="stable")
        self.gaps = np.take_along_axis(gaps, self.order, axis=2)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry for rows (vector, part)."""
        n = len(points)
        part = np.arange(n) % PARTS
        at = np.zeros(n, np.int64)
        best = squares(points - self.entries[part, 0])
        seen = np.zeros((n, self.count), bool)
        seen[:, 0] = True
        place = np.zeros(n, np.int64)
        going = np.arange(n)
        while len(going):
            going = going[place[going] < self.count]
            here = part[going], at[going], place[going]
            within = self.gaps[here] <= 4 * best[going]
            going = going[within.astype(bool)]
            entry = self.order[part[going], at[going], place[going]]
            place[going] += 1
            new = ~seen[going, entry]
            row, entry = going[new], entry[new]
            seen[row, entry] = True
            far = squares(points[row] - self.entries[part[row], entry])
            nearer = ((far < best[row]) | ((far == best[row]) & (entry < at[row]))).astype(bool)
            moved = row[nearer]
            at[moved], best[moved], place[moved] = entry[nearer], far[nearer], 0
        return at, best


def squares(gaps: np.ndarray) -> np.ndarray:
    if gaps.dtype == object:
        return (gaps * gaps).sum(axis=-1) + np.zeros(gaps.shape[:-1], dtype=object)
    return np.einsum("...i,...i->...", gaps, gaps)


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """A whole number as signed pieces by place; few are needed unless it is huge."""
    at, sign = 0, -1 if value < 0 else 1
    value = abs(value)
    while value:
        yield at, sign * (value & ((1 << LIMB_BITS) - 1))
        value >>= LIMB_BITS
        at += 1


def first_entries(table: DataFrame) -> Codebooks:
    """Codebooks of the vectors with the smallest ids, for each length."""

    def run(batches):
        for batch in batches:
            ids = batch.column("vec_id")
            order = np.empty(len(ids), np.int64)
            order[pc.array_sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
            ranks = pc.rank(ids, null_placement="at_end", tiebreaker="min").to_numpy(zero_copy_only=False)
            for at, rows in vectors(batch.column("embedding")):
                # rows up to the id of the last place, with all that share it
                low = at[np.argsort(order[at])][:ENTRIES]
                pick = ranks[at] <= ranks[low[-1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(at[pick])),
                        pa.array(np.full(int(pick.sum()), rows.shape[1], np.int32)),
                        pa.array([row.astype(">f8").tobytes() for row in rows[pick]], pa.binary()),
                    ],
                    ["vec_id", "size", "vec"],
                )

    key = table.schema["vec_id"].dataType.simpleString()
    found = table.select("vec_id", "embedding").mapInArrow(run, f"vec_id {key}, size int, vec binary")
    order = W.partitionBy("size").orderBy(F.asc_nulls_last("vec_id"), "vec")
    # at most ENTRIES rows of a size leave a task, and reach the driver
    first = found.withColumn("_no", F.row_number().over(order)).filter(F.col("_no") <= ENTRIES)
    books: Codebooks = {}
    for row in first.orderBy("size", "_no").collect():
        parts = in_parts(integers(np.frombuffer(row["vec"], ">f8").astype(np.float64)[None, :]))
        for part, entry in zip(books.setdefault(row["size"], [[] for _ in range(PARTS)]), parts.tolist()):
            part.append(entry)
    return books


def improved(table: DataFrame, books: Codebooks) -> Codebooks:
    """Codebooks after a round: each entry the floor of the mean of its parts."""

    def run(batches):
        lists = {size: Lists(book, size) for size, book in books.items()}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, rows in vectors(batch.column("embedding")):
                size = rows.shape[1]
                points = in_parts(integers(rows))
                at, _ = lists[size].nearest(points)
                slot = np.arange(len(at)) % PARTS * ENTRIES + at
                made = np.zeros((PARTS * ENTRIES, width(size) + 1), points.dtype)
                np.add.at(made, slot, np.concatenate([points, np.ones((len(points), 1), points.dtype)], axis=1))
                # Python numbers, so that no sum of a task overflows
                sums[size] = sums.get(size, 0) + made.astype(object)
        out = [
            (size, slot, place, limb, piece)
            for size, made in sums.items()
            for slot, row in enumerate(made.tolist())
            for place, value in enumerate(row)
            for limb, piece in limbs(value)
        ]
        if out:
            yield _sum_batch(out)

    parts = table.select("embedding").mapInArrow(run, "size int, slot int, place int, limb int, total long")
    sums: dict[tuple[int, int], dict[int, int]] = {}
    for row in parts.groupBy("size", "slot", "place", "limb").agg(F.sum("total").alias("total")).collect():
        places = sums.setdefault((row["size"], row["slot"]), {})
        places[row["place"]] = places.get(row["place"], 0) + (row["total"] << LIMB_BITS * row["limb"])
    out: Codebooks = {}
    for size, parts in books.items():
        out[size] = []
        for p, part in enumerate(parts):
            rows = []
            for e, entry in enumerate(part):
                places = sums.get((size, p * ENTRIES + e), {})
                count = places.get(width(size), 0)
                rows.append([places.get(i, 0) // count for i in range(width(size))] if count else entry)
            out[size].append(rows)
    return out


def _sum_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["size", "slot", "place", "limb", "total"]
    kinds = [pa.int32()] * 4 + [pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def train(table: DataFrame, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks from all vectors of ``table`` (vec_id, embedding)."""
    books = first_entries(table)
    for _ in range(rounds if books else 0):
        books = improved(table, books)
    return books


def digest_of(book: list[list[list[int]]], size: int) -> str:
    """Digest of all components by part, entry and position, fill left out."""
    w = width(size)
    shown = (entry[i] for p, part in enumerate(book) for entry in part for i in range(w) if p * w + i < size)
    return hashlib.sha256(",".join(map(str, shown)).encode()).hexdigest()


def encode(table: DataFrame, books: Codebooks) -> DataFrame:
    """Rows (vec_id, label, size, code, error, codebooks_sha256) of the vectors whose length has codebooks."""

    def run(batches):
        lists = {size: Lists(book, size) for size, book in books.items()}
        names = {size: digest_of(book, size) for size, book in books.items()}
        digits = np.array([f"{e:02x}" for e in range(ENTRIES)])
        for batch in batches:
            for at, rows in vectors(batch.column("embedding")):
                size = rows.shape[1]
                if size not in lists:
                    continue
                entry, far = lists[size].nearest(in_parts(integers(rows)))
                errors = [e if e <= LARGEST else None for e in far.reshape(-1, PARTS).astype(object).sum(axis=1).tolist()]
                codes = ["".join(row) for row in digits[entry].reshape(-1, PARTS).tolist()]
                place = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(place),
                        batch.column("label").take(place),
                        pa.array(np.full(len(at), size, np.int32)),
                        pa.array(codes, pa.string()),
                        pa.array(errors, pa.int64()),
                        pa.array([names[size]] * len(at), pa.string()),
                    ],
                    ["vec_id", "label", "size", "code", "error", "codebooks_sha256"],
                )

    key, label = (table.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    return table.select("vec_id", "label", "embedding").mapInArrow(
        run, f"vec_id {key}, label {label}, size int, code string, error long, codebooks_sha256 string"
    )


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """Rows (vec_id, embedding): what the codes (vec_id, size, code) stand for."""

    def run(batches):
        for batch in batches:
            made = []
            for size, code in zip(batch.column("size").to_pylist(), batch.column("code").to_pylist()):
                entries = [books[size][p][int(code[2 * p : 2 * p + 2], 16)] for p in range(PARTS)]
                made.append([x / STEPS for entry in entries for x in entry][:size])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(made, pa.list_(pa.float64()))], ["vec_id", "embedding"])

    key = codes.schema["vec_id"].dataType.simpleString()
    return codes.select("vec_id", "size", "code").mapInArrow(run, f"vec_id {key}, embedding array<double>")


def with_label_sums(rows: DataFrame, name: str = "label_error") -> DataFrame:
    """``rows`` with the error summed over equal labels, nulls together.  A label's rows are dealt
    to ``SALTS`` groups, which are summed up first; the join is by label and group, so a label
    with most of the rows is many tasks' work."""
    salt = F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS))
    amount: Column = F.col("error").cast("decimal(38,0)")
    salted = rows.withColumn("_salt", salt)
    groups = salted.groupBy("label", "_salt").agg(F.sum(amount).alias("_sum"), F.count_if(F.col("error").isNull()).alias("_lost"))
    whole = W.partitionBy("label")  # at most SALTS rows of a label
    total = F.when(F.sum("_lost").over(whole) == 0, F.expr("try_cast(sum(_sum) over (partition by label) as bigint)"))
    sums = groups.select(F.col("label").alias("_label"), F.col("_salt").alias("_group"), total.alias(name))
    met = F.col("label").eqNullSafe(F.col("_label")) & (F.col("_salt") == F.col("_group"))
    return salted.join(sums, met).drop("_label", "_group", "_salt")


def compress(table: DataFrame) -> DataFrame:
    """Rows (vec_id, code, error, label_error, codebooks_sha256) for ``table`` (vec_id, embedding, label)."""
    coded = stage(encode(table, train(table)), "codes")
    return with_label_sums(coded).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
