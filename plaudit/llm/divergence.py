r"""Differences between the sources of a language, from a frequent-pattern tree of term rows.

Every (lang, source) group gives each kept term of its language the share
``p = 1 + floor(10**9 * (count + 1) / (N + V))``; two groups differ by the sum over the V kept
terms of ``f(p, q) = floor((p - q)**2 / q)``.

A term's row is the list of its nonzero counts, ordered by source.  Equal rows are one path with a
multiplicity, and paths that begin alike share nodes of a prefix tree.  A node knows how many terms
pass through it, so each combination of a node with one of its ancestors is counted once
for all these terms: it says in how many terms these two sources have these two counts.
With p0 and q0 the shares of a count of zero, the sum over all terms is

    V f(p0, q0)                                                   as if no term occurred
    + sum over counts of one group   [f(p, q0) - f(p0, q0)]
    + sum over counts of the other   [f(p0, q) - f(p0, q0)]
    + sum over pairs from the tree   [f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)]

so zeros, the bulk of the table of terms and sources, are never visited.  The paths are sorted
across the cluster; each task builds the part of the tree its paths make, holding one path at a
time, and a node that two tasks share is counted in both, in parts.

Defined cases: null text, lang and source are ''; groups without terms take part; a language
that keeps no term has value 0 for all its pairs and no term rows; repeated rows are documents of
their own; ``doc_id`` and other columns are ignored; no rows give none.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from plaudit.staging import stage

LEAST_DOCS = 3  # of a language, for a term to be kept
TERM_RANKS = 200
UNIT = 1_000_000_000
SLICE_BYTES = 2_000_000  # of a text cut into terms at once
HELD_TERMS = 150_000  # counted terms that a task holds
HELD_PAIRS = 1_000_000  # node and ancestor pairs that a task holds
SALTS = 32  # tasks that share the pairs of one language

# ASCII letters, small, and all bytes of other letters; the rest parts terms.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def slices(text: bytes):
    """Terms of a text, by slices that end between terms."""
    clean = text.translate(LETTERS)
    at = 0
    while at < len(clean):
        end = clean.find(b" ", at + SLICE_BYTES) if len(clean) - at > SLICE_BYTES else -1
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


def count_terms(docs: DataFrame) -> DataFrame:
    """Rows (lang, source, term, n, docs): occurrences and documents; a term of a group may have
    several rows, to be added up."""

    def run(batches):
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def rows():
            for (lang, source), (times, met) in held.items():
                terms = list(times)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(terms), np.int32)), pa.array([lang])).dictionary_decode(),
                        pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(terms), np.int32)), pa.array([source])).dictionary_decode(),
                        pa.array(terms, pa.binary()).cast(pa.string()),
                        pa.array([times[t] for t in terms], pa.int64()),
                        pa.array([met[t] for t in terms], pa.int64()),
                    ],
                    ["lang", "source", "term", "n", "docs"],
                )

        for batch in batches:
            groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            for group, text in zip(groups, batch.column("text")):
                times, met = held.setdefault(group, (Counter(), Counter()))
                before = len(times)
                distinct: set[bytes] = set()
                for terms in slices(text.as_buffer().to_pybytes()):
                    times.update(terms)
                    distinct.update(terms)
                met.update(distinct)
                size += len(times) - before
                if size > HELD_TERMS:
                    yield from rows()
                    held, size = {}, 0
        yield from rows()

    return plain(docs).mapInArrow(run, "lang string, source string, term string, n long, docs long")


def plain(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])


def term_rows(docs: DataFrame) -> DataFrame:
    """Rows (lang, term, cells) of the kept terms; cells are (source, n), ordered by source."""
    counted = count_terms(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # a row has no more cells than its language has sources
    rows = counted.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("source", "n"))).alias("cells"), F.sum("docs").alias("docs"))
    return rows.filter(F.col("docs") >= LEAST_DOCS).select("lang", "term", "cells")


def tree_pairs(paths: DataFrame) -> DataFrame:
    """Rows (lang, a, a_n, b, b_n, terms): in how many terms source a has a_n and the later
    source b has b_n, from paths (lang, cells, terms) by a prefix tree."""

    def run(batches):
        names: dict[tuple[str, int], int] = {}
        items: list[tuple[str, int]] = []
        stack: list[int] = []  # the present path: item and terms of each node
        through: list[int] = []
        keys: list[np.ndarray] = []
        times: list[np.ndarray] = []
        held = 0

        def leave(depth: int) -> None:
            """Close the nodes below ``depth``: pair each with its ancestors."""
            nonlocal held
            path = np.array(stack, np.int64)
            for at in range(len(stack) - 1, depth - 1, -1):
                if at:
                    keys.append(path[:at] << 32 | path[at])
                    times.append(np.full(at, through[at], np.int64))
                    held += at
                if at:
                    through[at - 1] += through[at]
            del stack[depth:], through[depth:]

        def rows(lang: str):
            nonlocal held
            if not held:
                return
            pairs, place = np.unique(np.concatenate(keys), return_inverse=True)
            sums = np.zeros(len(pairs), np.int64)
            np.add.at(sums, place, np.concatenate(times))
            keys.clear(), times.clear()
            held = 0
            sources = pa.array([s for s, _ in items], pa.string())
            counts = pa.array([n for _, n in items], pa.int64())
            a, b = pa.array(pairs >> 32), pa.array(pairs & 0xFFFFFFFF)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(pairs), pa.string()), sources.take(a), counts.take(a), sources.take(b), counts.take(b), pa.array(sums)],
                ["lang", "a", "a_n", "b", "b_n", "terms"],
            )

        present = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["lang"] != present:
                    leave(0)
                    yield from rows(present)
                    names.clear(), items.clear()
                    present = row["lang"]
                path = []
                for cell in row["cells"]:
                    item = cell["source"], cell["n"]
                    if item not in names:
                        names[item] = len(items)
                        items.append(item)
                    path.append(names[item])
                same = 0
                while same < min(len(path), len(stack)) and path[same] == stack[same]:
                    same += 1
                leave(same)
                stack += path[same:]
                through += [0] * (len(path) - same)
                through[-1] += row["terms"]
                if held > HELD_PAIRS:
                    yield from rows(present)
        leave(0)
        yield from rows(present)

    ordered = paths.repartitionByRange("lang", "cells").sortWithinPartitions("lang", "cells")
    return ordered.select("lang", "cells", "terms").mapInArrow(run, "lang string, a string, a_n long, b string, b_n long, terms long")


def share(n: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(UNIT * (n + 1) / (total + kept))``, exact."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", F.lit(UNIT).cast("decimal(10,0)") * wide(n + 1), wide(total + kept)) + 1


def gap(p: Column, q: Column) -> Column:
    """``floor((p - q)**2 / q)``; shares are at most UNIT + 1, so a long holds the square."""
    return F.call_function("div", (p - q) * (p - q), q)


def group_table(docs: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows (lang, source, total, kept, zero): each group's counts of kept terms, its language's
    number of them, and the share of a term that the group lacks."""
    groups = plain(docs).select("lang", "source").distinct()
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    kept = cells.groupBy("lang").agg(F.count_if("first").alias("kept"))
    made = groups.join(totals, ["lang", "source"], "left").join(kept, "lang", "left").fillna(0, ["total", "kept"])
    zero = F.when(F.col("kept") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("kept")))
    return made.withColumn("zero", zero)


def source_pairs(groups: DataFrame) -> DataFrame:
    """Both orders of all pairs of sources of a language, which the report lists; dealt by a hash of
    the first source, so that one language is many tasks."""
    left = groups.select("lang", *[F.col(c).alias(f"g_{c}") for c in ("source", "total", "zero")], "kept")
    left = left.withColumn("_salt", F.pmod(F.xxhash64("g_source"), F.lit(SALTS)).cast("int"))
    right = groups.select("lang", *[F.col(c).alias(f"o_{c}") for c in ("source", "total", "zero")])
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, ["lang", "_salt"]).filter("g_source <> o_source").drop("_salt")


def pair_part(groups: DataFrame, cells: DataFrame, paths: DataFrame) -> DataFrame:
    """Rows (lang, source, item, value) for all ordered pairs of sources of a language."""
    pairs = stage(source_pairs(groups), "source-pairs")
    kept = F.col("kept")
    g_zero, o_zero = F.col("g_zero"), F.col("o_zero")
    base = gap(g_zero, o_zero)
    of = ["lang", F.col("g_source").alias("source"), F.col("o_source").alias("item")]
    nothing = pairs.select(*of, F.coalesce(kept * base, F.lit(0)).alias("value"))

    counts = stage(cells.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("terms")), "counts")
    one = pairs.join(counts.withColumnRenamed("source", "g_source"), ["lang", "g_source"])
    p = share(F.col("n"), F.col("g_total"), kept)
    ours = one.select(*of, (F.col("terms") * (gap(p, o_zero) - base)).alias("value"))
    other = pairs.join(counts.withColumnRenamed("source", "o_source"), ["lang", "o_source"])
    q = share(F.col("n"), F.col("o_total"), kept)
    theirs = other.select(*of, (F.col("terms") * (gap(g_zero, q) - base)).alias("value"))

    met = tree_pairs(paths).groupBy("lang", "a", "a_n", "b", "b_n").agg(F.sum("terms").alias("terms"))
    both = met.select(
        "lang",
        "terms",
        F.explode(
            F.array(
                F.struct(F.col("a").alias("g_source"), F.col("a_n").alias("g_n"), F.col("b").alias("o_source"), F.col("b_n").alias("o_n")),
                F.struct(F.col("b").alias("g_source"), F.col("b_n").alias("g_n"), F.col("a").alias("o_source"), F.col("a_n").alias("o_n")),
            )
        ).alias("_p"),
    ).select("lang", "terms", "_p.*")
    both = both.join(pairs, ["lang", "g_source", "o_source"])
    p, q = share(F.col("g_n"), F.col("g_total"), kept), share(F.col("o_n"), F.col("o_total"), kept)
    mixed = both.select(*of, (F.col("terms") * (gap(p, q) - gap(p, o_zero) - gap(g_zero, q) + base)).alias("value"))

    parts = nothing.unionByName(ours).unionByName(theirs).unionByName(mixed)
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_part(groups: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows (lang, source, item, value) of terms more usual in the group than in its language."""
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    known = stage(groups.join(langs, "lang"), "groups")
    p = share(F.col("n"), F.col("total"), F.col("kept"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    return (
        cells.join(known, ["lang", "source"])
        .withColumn("_p", p)
        .withColumn("_q", q)
        .filter("_p > _q")
        .select("lang", "source", F.col("term").alias("item"), gap(F.col("_p"), F.col("_q")).alias("value"))
    )


def ranked(rows: DataFrame, part: str, most: int | None = None) -> DataFrame:
    """Rows with their rank in the group, largest value first, ties by the bytes of the item."""
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = rows.withColumn("rank", F.row_number().over(order))
    out = out.filter(F.col("rank") <= most) if most else out
    return out.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(docs: DataFrame) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for ``docs`` (text, lang, source)."""
    rows = stage(term_rows(docs), "term-rows")
    lang_n = F.aggregate("cells", F.lit(0).cast("long"), lambda sum, cell: sum + cell["n"])
    cells = rows.select("lang", "term", lang_n.alias("lang_n"), F.posexplode("cells").alias("_at", "_c")).select(
        "lang", "term", "lang_n", (F.col("_at") == 0).alias("first"), "_c.source", "_c.n"
    )
    groups = stage(group_table(docs, cells), "groups")
    paths = rows.groupBy("lang", "cells").agg(F.count(F.lit(1)).alias("terms"))
    pairs = ranked(pair_part(groups, cells, paths), "pair")
    return pairs.unionByName(ranked(term_part(groups, cells), "term", TERM_RANKS))
