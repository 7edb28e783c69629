"""Vector codes against plain definitions in Python numbers."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from plaudit.llm import orchard

SCHEMA = "vec_id long, embedding array<double>, label int, code string, size int"


def plain(rows, rounds=orchard.ROUNDS):
    """Codes, errors and codebooks of rows (vec_id, embedding) of one length, by full search."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0))
    size = len(kept[0][1])
    w = -(-size // 8)
    cut = []
    for _, vector, *_ in kept:
        numbers = [math.floor(Fraction(x) * 4096) for x in vector] + [0] * (8 * w - size)
        cut.append([tuple(numbers[p * w : p * w + w]) for p in range(8)])
    books = [[c[p] for c in cut[:16]] for p in range(8)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        new = []
        for p, book in enumerate(books):
            held = [[] for _ in book]
            for c in cut:
                held[nearest(c[p], book)[1]].append(c[p])
            new.append([tuple(sum(x) // len(h) for x in zip(*h)) if h else e for h, e in zip(held, book)])
        books = new
    found = [[nearest(c[p], books[p]) for p in range(8)] for c in cut]
    flat = [x for p, book in enumerate(books) for entry in book for i, x in enumerate(entry) if p * w + i < size]
    sha = hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()
    out = []
    for row, f in zip(kept, found):
        error = sum(d for d, _ in f)
        out.append((row[0], "".join(f"{e:02x}" for _, e in f), error if error < 1 << 63 else None, row[2], sha))
    return out


def with_sums(rows):
    sums = {}
    for _, _, error, label, _ in rows:
        sums[label] = None if error is None or sums.get(label, 0) is None else sums.get(label, 0) + error
    return sorted(((i, c, e, sums[label], s) for i, c, e, label, s in rows), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "clash", 9) for i, v, label in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("size", [16, 8, 13, 3])
def test_codes_equal_full_search(spark, rows, size):
    random = np.random.default_rng(size)
    vectors = random.integers(-3, 4, (90, size)) / 7 + random.integers(0, 2, (90, 1)) * 2
    made = [(int(i) * 3 + 1, v.tolist(), None if i % 5 == 0 else int(i) % 3) for i, v in enumerate(vectors)]
    made += made[:9]  # repeated rows
    made += [(500, None, 1), (501, [None] * size, 1), (502, [float("nan")] * size, 2), (503, [math.inf] * size, 2), (504, [0.0] * size, 1)]
    made += [(None, [1.0] * size, 2), (0, [0.25] * size, 0)]
    assert rows(orchard.compress(table(spark, made))) == with_sums(plain(made))


def test_fewer_vectors_than_entries_and_large_components(spark, rows):
    made = [(i, [x, -x / 3, 0.1, 2.0, 5.0, -1e-9, 0.0, 1.0, x], 1) for i, x in enumerate([1e9, 3e17, -2.5, 1e300, 7.0])]
    assert rows(orchard.compress(table(spark, made))) == with_sums(plain(made))


def test_each_length_has_its_own_codebooks(spark, rows):
    random = np.random.default_rng(4)
    short = [(i, random.random(8).tolist(), 1) for i in range(40)]
    long = [(i + 100, random.random(24).tolist(), 2) for i in range(40)]
    empty = [(900, [], 7)]
    found = rows(orchard.compress(table(spark, short + long + empty)))
    assert found == sorted(with_sums(plain(short)) + with_sums(plain(long)) + with_sums(plain(empty)), key=repr)


def test_no_rows(spark):
    out = orchard.compress(table(spark, [(1, None, 1)]))
    assert out.count() == 0 and out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert orchard.compress(table(spark, [(1, None, 1)]).limit(0)).count() == 0


def test_search_looks_at_fewer_entries_than_all_and_errs_never():
    random = np.random.default_rng(1)
    books = random.integers(-9000, 9000, (8, 16, 2)).tolist()
    lists = orchard.Lists(books, 16)
    points = random.integers(-9000, 9000, (8 * 500, 2))
    at, far = lists.nearest(points)
    gaps = ((points[:, None, :] - lists.entries[np.arange(len(points)) % 8]) ** 2).sum(axis=2)
    assert (at == gaps.argmin(axis=1)).all() and (far == gaps.min(axis=1)).all()


def test_decoded_vectors_are_as_near_as_the_error_says(spark):
    random = np.random.default_rng(2)
    made = [(i, (random.integers(-4000, 4000, 16) / 4096).tolist(), 1) for i in range(200)]
    df = table(spark, made)
    books = orchard.train(df)
    codes = orchard.encode(df, books)
    back = {r["vec_id"]: r["embedding"] for r in orchard.decode(codes, books).collect()}
    for row in codes.collect():
        gap = (np.array(made[row["vec_id"]][1]) - back[row["vec_id"]]) * 4096
        assert round(float(gap @ gap)) == row["error"]
