import numpy as np
import pytest

from plaudit.llm import covertree as C, descent as D
from plaudit.llm.registry import QUERIES
from tests.conftest import SMALL, plan

BAD = [None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0]]


def planted(seed, labels=2, groups=12, copies=6, size=16):
    """Vectors in tight groups, some of them equal."""
    rng = np.random.default_rng(seed)
    rows = []
    for label in range(labels):
        for _ in range(groups):
            centre = rng.standard_normal(size)
            for _ in range(rng.integers(1, copies)):
                rows.append([float(x) for x in centre + rng.standard_normal(size) * rng.choice([0, 0.05, 0.2, 0.4])])
                rows[-1] = (len(rows) - 1, rows[-1], label)
    return rows


def brute(rows, limit):
    """n_links and component of each row, comparing all pairs."""
    good = [i for i, (_, v, label) in enumerate(rows) if label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = {i: [] for i in range(len(rows))}
    for i in good:
        for j in good:
            if i != j and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                x, y = np.array(rows[i][1]), np.array(rows[j][1])
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= limit:
                    links[i].append(j)
    out, seen = {}, {}
    for i in range(len(rows)):
        if i not in seen:
            work, found = [i], {i}
            while work:
                for j in links[work.pop()]:
                    if j not in found:
                        found.add(j)
                        work.append(j)
            ids = [rows[j][0] for j in found if rows[j][0] is not None]
            seen.update(dict.fromkeys(found, min(ids, default=None)))
        out[i] = (len(links[i]), seen[i])
    return out


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("cell, depth, leaf", [(1024, 3, 8), (5, 3, 2), (5, 0, 2)])
def test_dedup_equals_all_pairs(spark, monkeypatch, cell, depth, leaf):
    monkeypatch.setattr(C, "CELL", cell)
    monkeypatch.setattr(C, "DEPTH", depth)
    monkeypatch.setattr(C, "LEAF", leaf)
    rows = planted(4)
    rows += [(1000 + i, v, 0) for i, v in enumerate(BAD)] + [(2000, rows[0][1], None), (2001, [1.0, 2.0], 0), (2002, [2.0, 4.0], 0)]
    out = C.deduplicate(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute(rows, C.LIMIT)
    assert sorted(tuple(r) for r in out) == sorted((r[0], *want[i], r[0] == want[i][1]) for i, r in enumerate(rows))
    assert any(n for n, _ in want.values())


def test_links_are_the_exact_pairs(spark):
    rows = planted(6, labels=1)
    pairs, members = C.links(spark.createDataFrame(rows, SCHEMA), 0.9)
    cid = {r.vec_id: r.cid for r in members.collect()}
    got = {tuple(sorted((r.a, r.b))) for r in pairs.collect()}
    unit = [np.array(v) / np.linalg.norm(v) for _, v, _ in rows]
    want = {tuple(sorted((cid[i], cid[j]))) for i in range(len(rows)) for j in range(i) if cid[i] != cid[j] and unit[i] @ unit[j] >= 0.9}
    assert got == want and want


def test_tree_halves_radii_and_covers():
    rng = np.random.default_rng(1)
    points = rng.standard_normal((300, 8))
    points /= np.linalg.norm(points, axis=1)[:, None]
    tree = C.Tree(points)
    for node, children in enumerate(tree.children):
        rows = tree.rows(node)
        assert np.linalg.norm(points[rows] - points[tree.centre[node]], axis=1).max() <= tree.radius[node] + 1e-12
        if children:
            assert sorted(np.concatenate([tree.rows(c) for c in children])) == sorted(rows)
            assert tree.centre[children[0]] == tree.centre[node]
    assert sorted(tree.order) == list(range(300))


def test_dedup_repeats_null_ids_and_no_rows(spark):
    rows = [(None, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (None, None, 1), (7, [0.0, 1.0], 1)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", cid string, n int")
    out = sorted((tuple(r) for r in C.deduplicate(table).collect()), key=str)
    want = [(None, 2, 5, False), (5, 2, 5, True), (5, 2, 5, True), (None, 0, None, True), (7, 0, 7, True)]
    assert out == sorted(want, key=str)
    assert C.deduplicate(table.limit(0)).collect() == []


def test_dedup_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    out = QUERIES["op6_embedding_dedup"](spark, SMALL)
    assert "Cartesian" not in plan(out)
    want = brute(rows, 0.93)
    assert sorted(tuple(r)[:3] for r in out.collect()) == sorted((r[0], *want[i]) for i, r in enumerate(rows))


def exact(rows, query, k):
    _, q, _ = rows[query]
    scored = [(-float(np.dot(q, v)), i) for i, v, _ in rows if i != rows[query][0] and len(v) == len(q)]
    return [i for _, i in sorted(scored)[:k]]


def test_search_finds_the_nearest(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.standard_normal(16) * rng.uniform(0.5, 2)], 0) for i in range(1500)]
    out = D.nearest(spark.createDataFrame(rows, SCHEMA.replace("float", "double")), "vec_id % 20 = 0").collect()
    by = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append(r)
    hits = 0
    for q, found in by.items():
        assert [r.rank for r in found] == list(range(1, 21)) and len({r.vec_id for r in found}) == 20
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        assert all(r.score == float(np.dot(rows[q][1], rows[r.vec_id][1])) for r in found[:3])
        hits += len(set(exact(rows, q, 20)) & {r.vec_id for r in found})
    assert len(by) == 75 and hits >= 0.9 * 20 * 75


def test_search_few_equal_and_unusable_vectors(spark):
    rows = [(i, [1.0, 0.0], 0) for i in range(0, 30)] + [(40, [0.5, 0.5], 0), (60, [0.0, 2.0, 1.0], 0), (80, None, 0), (None, [1.0, 0.0], 0)]
    rows += [(100 + i, v, 0) for i, v in enumerate(BAD)] + [(40, [0.5, 0.5], 1)]
    out = D.nearest(spark.createDataFrame(rows, SCHEMA), "vec_id % 20 = 0").collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {0: list(range(1, 21)), 20: [i for i in range(21) if i != 20], 40: list(range(20))}
    assert D.nearest(spark.createDataFrame([], SCHEMA), "vec_id % 20 = 0").collect() == []
