"""Near-duplicate vectors by dual traversal of cover trees: exact pairs over a cosine limit.

Vectors are only compared within a label (and a number of components).  Unit vectors with a
cosine of at least c lie at most ``sqrt(2 - 2c)`` apart, so pairs are searched in a tree of
nested balls.  The top levels are made by Spark: cells with too many vectors are dealt to
the nearest of a few pivots, level by level, until cells are of bounded size (one that does not
part this way is split by hash).  In each cell a cover tree is built: levels of halving
radii, whose centres stay centres further down.  The traversal starts with each label's root
paired with itself and goes down both sides at once, dropping pairs of nodes whose centres
are further apart than their covering radii and the limit allow; pairs of cells that
are left go to a task each, which goes on inside the two trees.

Equal vectors are one class.  A task reports how many vectors each vector links to and a
forest of the links that connects the same vectors; ``links`` gives every pair of classes.

Defined cases: rows whose label is null or whose vector is null, empty, zero, or holds null or
non-finite components link with nothing; repeated rows link with each other; a null ``vec_id``
names no component but its own; each input row gives one row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from plaudit.llm.graph import components
from plaudit.llm.vectors import unit, usable
from plaudit.staging import stage

LIMIT = 0.93
CELL = 1024  # vectors of a cell
FAN = 32  # most pivots of a cell
DEPTH = 3  # levels dealt by pivots
LEAF = 8
ROUNDING = 1e-9


def reach(limit: float) -> float:
    return float(np.sqrt(max(0.0, 2 - 2 * limit)))


def prepare(table: DataFrame) -> DataFrame:
    """Rows (vec_id, label, size, vec): unit vectors as bytes, null where they take no part."""

    def run(batches):
        for batch in batches:
            rows, sizes = usable(batch.column("embedding"))
            vecs = [None if r is None else unit(r).tobytes() for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(sizes), pa.array(vecs, pa.binary())],
                ["vec_id", "label", "size", "vec"],
            )

    kinds = {c: table.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    return table.select("vec_id", "label", "embedding").mapInArrow(
        run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, size int, vec binary"
    )


def _rows(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, size)


def nearest(pairs: DataFrame) -> DataFrame:
    """Columns cell, cid, vec, pivots (bytes of all pivots of the cell) to the number of the
    nearest pivot and its distance."""

    def run(batches):
        for batch in batches:
            at, far = [], []
            for vec, pivots in zip(batch.column("vec"), batch.column("pivots")):
                v = np.frombuffer(vec.as_buffer(), np.float64)
                d = np.linalg.norm(np.frombuffer(pivots.as_buffer(), np.float64).reshape(-1, len(v)) - v, axis=1)
                at.append(int(d.argmin()))
                far.append(float(d.min()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("cell"), batch.column("cid"), batch.column("vec"), pa.array(at, pa.int32()), pa.array(far, pa.float64())],
                ["cell", "cid", "vec", "pivot", "far"],
            )

    return pairs.mapInArrow(run, "cell string, cid long, vec binary, pivot int, far double")


def top_levels(classes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Cells of bounded size, rows (cell, cid, vec), and for each level the nodes (node,
    parent, centre, radius); a cell that is small enough is its own child further down."""
    rows = classes.select(F.concat_ws("/", F.col("label").cast("string"), F.col("size").cast("string")).alias("cell"), "cid", "vec")
    roots = rows.groupBy("cell").agg(F.min_by("vec", "cid").alias("centre"))
    levels = [stage(roots.select(F.col("cell").alias("node"), F.lit(None).cast("string").alias("parent"), "centre", F.lit(2.0).alias("radius")), "nodes")]
    done = []
    rows = stage(rows, "cells")
    for depth in range(DEPTH + 1):
        counts = rows.groupBy("cell").agg(F.count("*").alias("_n"))
        large = counts.filter(F.col("_n") > CELL)
        if large.isEmpty():
            break
        known = levels[-1].select(F.col("node").alias("cell"), "centre", "radius")
        done.append(rows.join(large.select("cell"), "cell", "left_anti"))
        open_rows = rows.join(large, "cell")
        if depth < DEPTH:
            order = W.partitionBy("cell").orderBy(F.xxhash64("cid", F.lit(depth)), "cid")
            picked = open_rows.withColumn("_no", F.row_number().over(order)).filter(
                F.col("_no") <= F.least(F.lit(FAN), F.ceil(F.col("_n") * 1.5 / CELL) + 1)
            )
            listed = picked.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("_no", "vec"))).alias("_p"))
            pivots = listed.select("cell", F.col("_p.vec").alias("_p"))
            joined = open_rows.select("cell", "cid", "vec").join(pivots.select("cell", _bytes(F.col("_p")).alias("pivots")), "cell")
            dealt = stage(
                nearest(joined).select("cid", "vec", "cell", "far", "pivot", F.concat_ws(".", "cell", F.col("pivot").cast("string")).alias("_cell")), "cells"
            )
            nodes = dealt.groupBy("_cell").agg(F.first("cell").alias("cell"), F.first("pivot").alias("pivot"), F.max("far").alias("radius"))
            nodes = nodes.join(pivots, "cell").select(
                F.col("_cell").alias("node"), F.col("cell").alias("parent"), F.get("_p", F.col("pivot")).alias("centre"), "radius"
            )
        else:
            # too close together for pivots: split by hash, all parts with the ball of the whole
            part = F.pmod(F.xxhash64("cid"), F.ceil(F.col("_n") / CELL) + 1)
            dealt = stage(open_rows.select("cid", "vec", "cell", F.concat_ws(".", "cell", part.cast("string")).alias("_cell")), "cells")
            nodes = dealt.select("_cell", "cell").distinct().join(known, "cell").select(
                F.col("_cell").alias("node"), F.col("cell").alias("parent"), "centre", "radius"
            )
        same = known.join(large.select("cell"), "cell", "left_anti").select(F.col("cell").alias("node"), F.col("cell").alias("parent"), "centre", "radius")
        levels.append(stage(nodes.unionByName(same), "nodes"))
        rows = dealt.select(F.col("_cell").alias("cell"), "cid", "vec")
    for part in done:
        rows = rows.unionByName(part)
    return rows, levels


def _bytes(vecs):
    """Joined bytes of an array of byte strings."""
    return F.unhex(F.array_join(F.transform(vecs, lambda v: F.hex(v)), ""))


def near_nodes(levels: list[DataFrame], limit: float) -> DataFrame:
    """Pairs (a, b), a <= b, of nodes of the last level that may hold linked vectors."""
    gap = reach(limit) + ROUNDING
    pairs = levels[0].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for nodes in levels[1:]:
        side = lambda s: nodes.select(F.col("parent").alias(s), F.col("node").alias(f"_{s}"), F.col("centre").alias(f"c{s}"), F.col("radius").alias(f"r{s}"))
        joined = pairs.join(side("a"), "a").join(side("b"), "b").filter("a <> b or _a <= _b")

        def run(batches):
            for batch in batches:
                kept = []
                for x, y, reach_xy in zip(batch.column("ca"), batch.column("cb"), batch.column("r").to_pylist()):
                    x, y = np.frombuffer(x.as_buffer(), np.float64), np.frombuffer(y.as_buffer(), np.float64)
                    kept.append(float(np.linalg.norm(x - y)) <= reach_xy)
                yield batch.filter(pa.array(kept, pa.bool_())).select(["a", "b"])

        close = joined.select(F.col("_a").alias("a"), F.col("_b").alias("b"), "ca", "cb", (F.col("ra") + F.col("rb") + gap).alias("r"))
        found = close.mapInArrow(run, "a string, b string")
        pairs = stage(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "near")
    return pairs


class Tree:
    """Cover tree over rows of unit vectors.  Nodes stand in arrays: the row that is the
    centre, the covering radius, the rows below (a range of ``order``), and the children."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.order = np.arange(len(points))
        self.centre, self.radius, self.range, self.children = [0], [0.0], [(0, len(points))], [[]]
        away = self._away(0, self.order)
        self.radius[0] = float(away.max())
        work = [(0, away, self.radius[0] / 2)]
        while work:
            node, away, radius = work.pop()
            start, end = self.range[node]
            if end - start <= LEAF or self.radius[node] <= ROUNDING:
                continue
            work += self._divide(node, start, end, away, radius)

    def _away(self, centre: int, rows: np.ndarray) -> np.ndarray:
        return np.linalg.norm(self.points[rows] - self.points[centre], axis=1)

    def _divide(self, node: int, start: int, end: int, away: np.ndarray, radius: float):
        """Children of half the radius: the node's own centre first, then rows not covered yet."""
        rows, work, at = self.order[start:end].copy(), [], start
        centre = self.centre[node]
        while len(rows):
            near = away <= radius
            mine, far = rows[near], away[near]
            self.order[at : at + len(mine)] = mine
            child = len(self.centre)
            self.centre.append(centre)
            self.radius.append(float(far.max()))
            self.range.append((at, at + len(mine)))
            self.children.append([])
            self.children[node].append(child)
            work.append((child, far, radius / 2))
            at += len(mine)
            rows = rows[~near]
            if len(rows):
                centre = int(rows[0])
                away = self._away(centre, rows)
        return work

    def rows(self, node: int) -> np.ndarray:
        return self.order[slice(*self.range[node])]


def dual(x: Tree, y: Tree, limit: float, same: bool):
    """Linked rows (i, j, cosine) of two trees; each pair once if they are the same tree."""
    gap = reach(limit) + ROUNDING
    found = []
    work = [(0, 0)]
    while work:
        a, b = work.pop()
        if not x.children[a] and not y.children[b]:
            i, j = x.rows(a), y.rows(b)
            cosine = x.points[i] @ y.points[j].T
            at = np.nonzero(cosine >= limit)
            i, j, cosine = i[at[0]], j[at[1]], cosine[at]
            if same:
                once = i < j if a == b else np.ones(len(i), dtype=bool)
                i, j, cosine = i[once], j[once], cosine[once]
            found.append((i, j, cosine))
            continue
        left, right = np.array(x.children[a] or [a]), np.array(y.children[b] or [b])
        cx, cy = x.points[np.array(x.centre)[left]], y.points[np.array(y.centre)[right]]
        apart = np.sqrt(np.maximum(0, 2 - 2 * (cx @ cy.T)))
        bound = np.array(x.radius)[left][:, None] + np.array(y.radius)[right][None, :] + gap + 1e-7
        near = apart <= bound
        if same and a == b:
            near &= left[:, None] <= right[None, :]
        for i, j in zip(*np.nonzero(near)):
            work.append((int(left[i]), int(right[j])))
    return tuple(np.concatenate(c) if found else np.zeros(0, k) for c, k in zip(zip(*found) if found else [(), (), ()], (int, int, float)))


def cell_pairs(table: DataFrame, limit: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Prepared rows, classes of equal vectors, and pairs of cells with their vectors."""
    rows = stage(prepare(table).withColumn("digest", F.md5("vec")), "vectors")
    held = rows.filter("vec is not null and label is not null")
    classes = held.groupBy("label", "size", "digest").agg(F.first("vec").alias("vec"), F.count("*").alias("n"), F.min("vec_id").alias("rep"))
    classes = stage(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    cells, levels = top_levels(classes)
    sized = cells.join(classes.select("cid", "n", "size"), "cid")
    packed = stage(
        sized.groupBy("cell").agg(F.first("size").alias("size"), F.sort_array(F.collect_list(F.struct("cid", "n", "vec"))).alias("_m")).select(
            "cell", "size", F.col("_m.cid").alias("cids"), F.col("_m.n").alias("ns"), _bytes(F.col("_m.vec")).alias("vecs")
        ),
        "packed",
    )
    side = lambda s: packed.select(F.col("cell").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("size", "cids", "ns", "vecs")))
    return rows, classes, near_nodes(levels, limit).join(side("a"), "a").join(side("b"), "b").drop("size_b")


def search(pairs: DataFrame, limit: float, every: bool) -> DataFrame:
    """Rows (a, b, value).  With ``every``: all linked classes and their cosine.  Without: for each
    class (b is null) how many vectors of other classes it links to, and a forest of links."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                x, y = (np.frombuffer(row[f"vecs_{s}"], np.float64).reshape(-1, row["size_a"]) for s in "ab")
                same = row["a"] == row["b"]
                tree = Tree(x)
                i, j, cosine = dual(tree, tree if same else Tree(y), limit, same)
                left, right = np.array(row["cids_a"], np.int64), np.array(row["cids_b"], np.int64)
                if every:
                    yield _batch(left[i], right[j], cosine)
                    continue
                n_left, n_right = np.array(row["ns_a"], np.int64), np.array(row["ns_b"], np.int64)
                sums = np.concatenate([np.bincount(i, n_right[j], len(left)), np.bincount(j, n_left[i], len(right))])
                ids = np.concatenate([left, right])
                yield _batch(ids[sums > 0], None, sums[sums > 0])
                at = forest(i, j + (0 if same else len(left)), len(ids))
                yield _batch(left[i[at]], right[j[at]], cosine[at])

    return pairs.mapInArrow(run, "a long, b long, value double")


def _batch(a, b, value) -> pa.RecordBatch:
    b = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b, pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), b, pa.array(value, pa.float64())], ["a", "b", "value"])


def forest(i: np.ndarray, j: np.ndarray, size: int) -> list[int]:
    """Numbers of links that join all that the links join, without a cycle."""
    parent = list(range(size))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for n, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
        a, b = find(a), find(b)
        if a != b:
            parent[a] = b
            kept.append(n)
    return kept


def links(table: DataFrame, limit: float = LIMIT) -> tuple[DataFrame, DataFrame]:
    """All pairs (a, b, value) of linked classes, and the members (vec_id, cid) of classes."""
    rows, classes, pairs = cell_pairs(table, limit)
    members = rows.join(classes.select("label", "size", "digest", "cid"), ["label", "size", "digest"]).select("vec_id", "cid")
    return search(pairs, limit, every=True), members


def deduplicate(table: DataFrame, limit: float = LIMIT) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    rows, classes, pairs = cell_pairs(table, limit)
    found = stage(search(pairs, limit, every=False), "found")
    counts = found.filter("b is null").groupBy("a").agg(F.sum("value").cast("long").alias("_links"))
    named = components(found.filter("b is not null").select("a", "b"))
    whole = (
        classes.join(counts, classes["cid"] == counts["a"], "left").join(named, classes["cid"] == named["id"], "left")
        .select("label", "size", "digest", "rep", (F.col("n") - 1 + F.coalesce("_links", F.lit(0))).alias("n_links"), F.coalesce("component", "cid").alias("_c"))
    )
    whole = stage(whole, "named")
    least = whole.groupBy("_c").agg(F.min("rep").alias("component_id"))
    known = whole.join(least, "_c").select("label", "size", "digest", "n_links", "component_id")
    linked = rows.join(known, ["label", "size", "digest"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("vec is null or label is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
