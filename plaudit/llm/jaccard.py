r"""Similarity join of documents on word shingles, with token-combination prefixes.

Two documents link when ``100 * |x & y| >= percent * |x | y|`` for their sets of shingles.
If they do, at most ``e(n) = n - ceil(percent * n / 100)`` of the n shingles of either are
missing in the other.  Shingles are put in one global order, rare class first, and

- a document with more than e(n) rare shingles is indexed under the first e(n) + 1 of them;
- otherwise under all its rare shingles, and its prefix is extended by frequent ones.  These
  fall into ``CLASSES`` classes by hash, and the prefix goes on until its rare shingles and all
  but one of each class are e(n) + 1 together: two linked documents then share a rare shingle
  of their prefixes or at least two of one class, so pairs within a class are indexed;
- pairs of n shingles grow with n * n, and small sets have too few for the classes, so documents
  below ``SMALL`` and from ``LONG`` shingles on use single frequent shingles; around these
  sizes documents have both forms.  So do all documents where ``percent`` is low.

Any fixed split into classes gives the same links, so it only has to be good for speed.  All
shingles of all documents are counted; those in more than ``RARE`` documents are frequent,
and where these are more than ``MOST_FREQUENT`` (the bound of what is broadcast) only the
most frequent of them.

Documents with equal sets are one class.  A parity bitmap of each set bounds the difference of
two sets from below.  Short lists of classes under a key are checked whole; of long ones each
class with a few whose bitmaps allow a link.  Then, in the lists whose classes are still in
different components, all pairs between components whose bitmaps allow a link are checked.  Pairs
inside a component need no check, so a large group of near copies never becomes all its pairs.

Defined cases: a text that is null or without words has an empty set and links with nothing;
fewer words than a shingle make one shingle of all; repeated rows link with each other; a null
``doc_id`` is a document that never names a component unless it is alone (then the name is
null); each input row gives one row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from plaudit.llm.chunks import LONG_WORD, released, runs, text_chunks, word_digest
from plaudit.llm.graph import components
from plaudit.llm.select import flagged
from plaudit.staging import stage

RARE = 16
MOST_FREQUENT = 1 << 20
LONG = 400
BITMAP_BITS = 1024
NEIGHBOURS = 6  # partners of each class of long lists that are checked first
SHORT_LIST = 6  # lists up to this size are checked whole at once
LIST_BLOCK = 2048
CLASSES = 8  # of frequent shingles
SMALL = 32
COUNTED_BYTES = 4_000_000  # of texts whose shingles a task counts at once
LEAST_FOR_PAIRS = 60
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def missing(n, percent: int):
    """How many of n shingles a linked document may lack."""
    return n - (percent * n + 99) // 100


class Shingler:
    """Sets of hashed shingles of whole texts."""

    def __init__(self, words: int):
        self.words = words
        self.blank = np.zeros(256, dtype=bool)
        self.blank[[32, 9, 10, 11, 12, 13]] = True
        # a number for each letter at each place of a word
        number = np.arange(256 * LONG_WORD, dtype=np.uint64).reshape(LONG_WORD, 256)
        self.letter = mix(mix((number + np.uint64(1)) * MULTIPLIER))
        self.letter[:, 65:91] = self.letter[:, 97:123]
        self.letter[:, self.blank] = 0

    def word_hashes(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash and start of each word in the bytes."""
        blank = self.blank[data]
        starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
        if not len(starts):
            return np.zeros(0, np.uint64), starts
        lead = starts[0]
        within = np.arange(len(data) - lead) - np.repeat(starts - lead, np.diff(starts, append=len(data)))
        np.minimum(within, LONG_WORD - 1, out=within)
        hashes = np.add.reduceat(self.letter.ravel()[within << 8 | data[lead:]], starts - lead)
        ends = np.flatnonzero(~blank & np.concatenate([blank[1:], [True]])) + 1
        for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
            hashes[i] = word_digest(data[starts[i] : ends[i]].tobytes().lower())
        return mix(hashes), starts

    def sets(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ascending distinct shingles of each text."""
        encoded = [(t or "").encode() for t in texts.to_pylist()]
        hashes, starts = self.word_hashes(np.frombuffer(b"\n".join([*encoded, b""]), np.uint8))
        ends = np.cumsum([len(t) + 1 for t in encoded])
        bounds = np.concatenate([[0], np.searchsorted(starts, ends)])
        rolled = np.zeros(len(hashes), np.uint64)
        k = self.words
        for i in range(k):
            whole = max(0, len(hashes) - i)  # fewer words than a shingle leave none
            rolled[:whole] = rolled[:whole] * MULTIPLIER + hashes[i:]
        rolled = mix(rolled)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= k:
                made = np.sort(rolled[a : b - k + 1])
                yield made[np.concatenate([[True], made[1:] != made[:-1]])]
            elif b > a:
                whole = np.uint64(b - a)
                with np.errstate(over="ignore"):
                    for h in hashes[a:b]:
                        whole = whole * MULTIPLIER + h + np.uint64(k)
                yield mix(np.array([whole], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def packed(ascending: np.ndarray) -> bytes:
    """Distinct ascending 32-bit numbers in about 2 + log2(2^32 / how many) bits each: the low
    bits as they are, the high ones as gaps in a row of bits."""
    n = len(ascending)
    low = max(0, 32 - max(1, n).bit_length())
    tails = (ascending[:, None] >> np.arange(low, dtype=np.uint32)) & np.uint32(1)
    marks = np.zeros(n + (1 << 32 - low), np.uint8)
    marks[(ascending >> np.uint32(low)).astype(np.int64) + np.arange(n)] = 1
    return np.array([n], "<u4").tobytes() + np.packbits(tails.astype(np.uint8)).tobytes() + np.packbits(marks).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    """The numbers that ``packed`` took."""
    n = int(np.frombuffer(data, "<u4", 1)[0])
    low = max(0, 32 - max(1, n).bit_length())
    bits = np.frombuffer(data, np.uint8, offset=4)
    cut = (n * low + 7) // 8
    tails = np.unpackbits(bits[:cut], count=n * low).reshape(n, low).astype(np.uint32)
    heads = np.flatnonzero(np.unpackbits(bits[cut:])) - np.arange(n)
    return heads.astype(np.uint32) << np.uint32(low) | (tails << np.arange(low, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


def class_key(tokens: np.ndarray, ranges: int) -> np.ndarray:
    """What a shingle is counted under: the range that counts it, and 32 bits.  Ranges follow
    the size of the input, so few shingles meet by chance."""
    return (tokens >> np.uint64(32)) % np.uint64(ranges) << np.uint64(32) | tokens & np.uint64(0xFFFFFFFF)


def frequent_shingles(docs: DataFrame, words: int, ranges: int) -> np.ndarray:
    """Keys of the frequent class, ascending.  A map task sends each range one block of the
    shingles of its documents, already counted."""

    def count(batches):
        shingler = Shingler(words)
        for batch in batches:
            for chunk in text_chunks(batch, "text", COUNTED_BYTES):
                sets = list(shingler.sets(chunk.column("text")))
                keys, counts = np.unique(class_key(np.concatenate(sets), ranges), return_counts=True)
                cuts = np.searchsorted(keys >> np.uint64(32), np.arange(ranges + 1))
                low = keys.astype(np.uint32)
                counts = counts.astype(np.uint32)
                rows = [(r, packed(low[a:b]), counts[a:b].tobytes()) for r, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
                yield pa.RecordBatch.from_pylist(
                    [{"part": r, "keys": k, "counts": c} for r, k, c in rows],
                    pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]),
                )

    def total(batches):
        kept: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                parts = kept.setdefault(row["part"], [])
                parts.append((unpacked(row["keys"]), np.frombuffer(row["counts"], np.uint32)))
        for part, blocks in kept.items():
            keys = np.concatenate([k for k, _ in blocks])
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sums = np.add.reduceat(np.concatenate([c for _, c in blocks]).astype(np.int64)[order], first)
            often = sums > RARE
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[first][often].astype(np.int64) + (part << 32)), pa.array(sums[often])], ["key", "n"]
            )

    blocks = docs.select("text").mapInArrow(released(count), "part int, keys binary, counts binary")
    found = stage(blocks.repartition(ranges, "part").mapInArrow(released(total), "key long, n long"), "frequent")
    # the least count with which the frequent class keeps to its bound
    steps = found.groupBy(F.floor(F.log2("n") * 8).cast("int").alias("step")).count().orderBy(F.desc("step")).collect()
    taken, least = 0, None
    for row in steps:
        if taken + row["count"] > MOST_FREQUENT:
            break
        taken, least = taken + row["count"], row["step"]
    if least is None:
        return np.zeros(0, np.uint64)
    rows = found.filter(F.floor(F.log2("n") * 8) >= least).select("key").toPandas()
    return np.sort(rows["key"].to_numpy(np.uint64))


def index_keys(tokens: np.ndarray, frequent: np.ndarray, ranges: int, percent: int) -> np.ndarray:
    """Keys under which a document with these shingles is indexed."""
    n = len(tokens)
    if not n:
        return tokens
    e = missing(n, percent)
    keys = class_key(tokens, ranges)
    at = np.searchsorted(frequent, keys)
    at[at == len(frequent)] = 0
    often = frequent[at] == keys if len(frequent) else np.zeros(n, dtype=bool)
    rare = tokens[~often]
    if len(rare) > e:
        return rare[: e + 1]
    common = tokens[often]
    if percent < LEAST_FOR_PAIRS:
        return np.concatenate([rare, common[: e + 1 - len(rare)]])
    # each class lets one shingle pass without a pair
    classes = (common >> np.uint64(17)) % np.uint64(CLASSES)
    first = np.zeros(len(common), dtype=bool)
    first[np.unique(classes, return_index=True)[1]] = True
    enough = int(np.searchsorted(np.cumsum(~first), e + 1 - len(rare))) + 1
    extra, classes = common[:enough], classes[:enough]
    made = [rare]
    if SMALL * percent <= n * 100 and n * percent <= LONG * 100:
        left, right = np.nonzero(np.triu(classes[:, None] == classes[None, :], 1))
        made.append(mix(extra[left] * MULTIPLIER + extra[right]))
    if n * percent <= SMALL * 100 or n * 100 >= LONG * percent:
        made.append(extra)
    return np.concatenate(made)


def bitmap(tokens: np.ndarray) -> bytes:
    """For each bit, whether an odd number of shingles falls on it."""
    odd = np.bincount((tokens % np.uint64(BITMAP_BITS)).astype(np.int64), minlength=BITMAP_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def describe(docs: DataFrame, words: int, percent: int, frequent: np.ndarray, ranges: int) -> DataFrame:
    """One row per document: size of its set, digest of the set, bitmap and index keys."""

    def run(batches):
        shingler = Shingler(words)
        for batch in batches:
            for chunk in text_chunks(batch):
                sets = list(shingler.sets(chunk.column("text")))
                keys = [signed(index_keys(s, frequent, ranges, percent)) for s in sets]
                offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
                digests = [digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        chunk.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.array([bitmap(s) if len(s) else None for s in sets], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(keys))),
                    ],
                    ["doc_id", "n", "digest", "bits", "keys"],
                )

    return docs.select("doc_id", "text").mapInArrow(released(run), f"doc_id {_id_type(docs)}, n long, digest binary, bits binary, keys array<long>")


def digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def may_link(n_a, n_b, percent: int):
    """Sizes that allow a link."""
    return (F.least(n_a, n_b) * 100) >= (F.greatest(n_a, n_b) * percent)


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links among the pairs (a, b) of classes: those that join whatever the pairs that link
    join.  Sets are moved for the pair of each class with its smallest partner first, then only
    for pairs that are still between components."""
    sized = classes.select("cid", "n", "bits", "digest")
    joined = (
        pairs.join(sized.select(F.col("cid").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"), F.col("digest").alias("x")), "a")
        .join(sized.select(F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"), F.col("digest").alias("y")), "b")
        .select("a", "b", "x", "y", "n_a", "n_b", "bits_a", "bits_b")
    )

    def near(batches):
        for batch in batches:
            n = sum(batch.column(c).to_numpy().astype(np.int64) for c in ("n_a", "n_b"))
            rows = batch.num_rows
            bits = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(rows, -1) for c in ("bits_a", "bits_b")]
            differ = np.bitwise_count(bits[0] ^ bits[1]).sum(axis=1, dtype=np.int64)
            # |x ^ y| <= (100 - percent) / (100 + percent) * (|x| + |y|)
            yield batch.filter(pa.array(differ * (100 + percent) <= n * (100 - percent))).select(["a", "b", "x", "y"])

    close = stage(joined.mapInArrow(released(near), "a long, b long, x binary, y binary"), "close")
    first = close.groupBy("b").agg(F.min(F.struct("a", "x", "y")).alias("_p")).select("_p.a", "b", "_p.x", "_p.y")
    links = checked(first, classes, docs, words, percent)
    named = components(links).select(F.col("id"), F.col("component"))
    between = (
        close.join(named.select(F.col("id").alias("a"), F.col("component").alias("_a")), "a", "left")
        .join(named.select(F.col("id").alias("b"), F.col("component").alias("_b")), "b", "left")
        .filter(F.coalesce("_a", "a") != F.coalesce("_b", "b"))
        .join(first.select("a", "b"), ["a", "b"], "left_anti")
    )
    rest = stage(between.select("a", "b", "x", "y"), "between")
    return links if rest.isEmpty() else links.unionByName(checked(rest, classes, docs, words, percent))


def checked(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) of classes with the digests x and y that link."""
    wanted = pairs.select(F.explode(F.array("x", "y")).alias("digest")).distinct()
    reps = stage(classes.select("rep", "digest").join(wanted, "digest"), "reps")
    # texts of the wanted documents, then sets with a wanted digest, told where they are
    id_hash = F.xxhash64(F.col("doc_id").cast("string"))
    ids = reps.select(F.xxhash64(F.col("rep").cast("string")).alias("_key"))
    few = flagged(docs.select("doc_id", "text"), id_hash, ids, "_few").filter("_few").select("doc_id", "text")

    def made(batches):
        shingler = Shingler(words)
        for batch in batches:
            for chunk in text_chunks(batch):
                sets = list(shingler.sets(chunk.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["digest", "tokens"],
                )

    made_sets = few.mapInArrow(released(made), "digest binary, tokens binary")
    keys = reps.select(F.xxhash64("digest").alias("_key"))
    sets = flagged(made_sets, F.xxhash64("digest"), keys, "_set").filter("_set").select("digest", "tokens").dropDuplicates(["digest"])
    # both joins read the sets as they were dealt by digest once
    both = (
        pairs.join(sets.select(F.col("digest").alias("x"), F.col("tokens").alias("s")), "x")
        .join(sets.select(F.col("digest").alias("y"), F.col("tokens").alias("t")), "y")
        .select("a", "b", "s", "t")
    )

    def check(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("s"), batch.column("t")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.filter(pa.array(good, pa.bool_())).select(["a", "b"])

    return stage(both.mapInArrow(released(check), "a long, b long"), "links")


def link(docs: DataFrame, words: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, n, digest) of all documents, classes (cid, digest, rep, n) of equal sets,
    and links (a, b) between classes that join all classes of a component."""
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frequent = frequent_shingles(docs, words, ranges)
    described = describe(docs, words, percent, frequent, ranges)
    rows = stage(described.withColumn("row", F.monotonically_increasing_id()), "shingles")
    grouped = rows.filter("n > 0").groupBy("digest").agg(F.min("row").alias("cid"), F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    classes = stage(grouped, "classes")
    # a class is named by a row of it, whose keys stay where they are; only rows that may be copies move
    keys = rows.filter("n > 0").select(F.col("row").alias("cid"), "n", "keys")
    copies = keys.select("cid").join(classes.select("cid"), "cid", "left_anti").select(F.xxhash64("cid"))
    told = flagged(keys, F.xxhash64("cid"), copies, "_maybe")
    only = told.filter("_maybe").join(classes.select("cid"), "cid", "left_semi")
    keyed = told.filter("not _maybe").unionByName(only).select("cid", "n", F.explode("keys").alias("key"))
    sized = keyed.withColumn("m", F.count("*").over(W.partitionBy("key")))
    lists = stage(sized.filter("m > 1").select("key", "cid", "n", "m"), "lists")
    few = neighbours(lists.filter(F.col("m") <= SHORT_LIST), percent)
    long_lists = lists.filter(F.col("m") > SHORT_LIST).withColumn("comp", F.col("cid"))
    first = stage(few.unionByName(near_pairs(long_lists, classes, percent, NEIGHBOURS)).distinct(), "pairs")
    links = verify(first, classes, docs, words, percent)
    # what is left between components
    rest = near_pairs(divided(long_lists.drop("comp"), links), classes, percent, None).distinct()
    more = verify(stage(rest.join(first, ["a", "b"], "left_anti"), "pairs"), classes, docs, words, percent)
    return rows, classes, links.unionByName(more)


def neighbours(lists: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of short lists that sizes allow."""
    order = W.partitionBy("key").orderBy("cid")
    steps = range(1, SHORT_LIST)
    near = lists.select("cid", "n", F.array(*(F.struct(F.lag("cid", k).over(order).alias("a"), F.lag("n", k).over(order).alias("n_a")) for k in steps)).alias("_l"))
    pairs = near.select("cid", "n", F.explode("_l").alias("_p")).select(F.col("_p.a").alias("a"), F.col("cid").alias("b"), "_p.n_a", "n")
    return pairs.filter("a is not null and a <> b").filter(may_link(F.col("n_a"), F.col("n"), percent)).select("a", "b")


def near_pairs(lists: DataFrame, classes: DataFrame, percent: int, most: int | None) -> DataFrame:
    """Pairs (a, b) of classes under one key and of different components whose bitmaps allow a
    link: all of them, or for each class ``most`` of them.  Lists are compared in blocks, each
    pair of blocks in one go, and only pairs that are left are rows."""
    held = lists.join(classes.select("cid", "bits"), "cid")
    blocks = F.ceil(F.col("m") / LIST_BLOCK)
    mine = F.pmod(F.xxhash64("cid"), blocks)
    dealt = held.select("key", "cid", "n", "comp", "bits", mine.alias("_b"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("_o"))
    group = F.xxhash64("key", F.least("_b", "_o"), F.greatest("_b", "_o"))
    rows = dealt.select(group.alias("group"), "cid", "n", "comp", "bits")

    def run(batches):
        for _, rows in runs(batches, "group"):
            cid, n, comp = (rows[c].to_numpy() for c in ("cid", "n", "comp"))
            if (comp == comp[0]).all():
                continue
            bits = np.frombuffer(b"".join(rows["bits"].to_pylist()), np.uint64).reshape(len(cid), -1)
            left, right = [], []
            for start in range(0, len(cid), 64):
                here = slice(start, start + 64)
                differ = np.bitwise_count(bits[here, None, :] ^ bits[None, :, :]).sum(axis=2, dtype=np.int64)
                total = n[here, None] + n[None, :]
                good = (differ * (100 + percent) <= total * (100 - percent)) & (comp[here, None] != comp[None, :])
                good &= np.minimum(n[here, None], n[None, :]) * 100 >= np.maximum(n[here, None], n[None, :]) * percent
                if most is None:
                    good &= cid[here, None] < cid[None, :]
                else:
                    # chance partners tie a group together; nearest ones would leave it in clusters
                    chance = mix(cid[here, None].astype(np.uint64) * MULTIPLIER + cid[None, :].astype(np.uint64)) >> np.uint64(24)
                    cost = np.where(good, chance.astype(np.int64), 1 << 40)
                    if cost.shape[1] > most:
                        bound = np.partition(cost, most - 1, axis=1)[:, most - 1 : most]
                        good &= (cost < bound) | ((cost == bound) & (np.cumsum(cost == bound, axis=1) <= most - (cost < bound).sum(axis=1, keepdims=True)))
                i, j = np.nonzero(good)
                left.append(cid[i + start])
                right.append(cid[j])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (left, right)], ["a", "b"])

    found = rows.repartition("group").sortWithinPartitions("group").mapInArrow(released(run), "a long, b long").dropDuplicates(["a", "b"])
    if most is not None:
        order = W.partitionBy("a").orderBy(F.xxhash64("a", "b"), "b")
        found = found.withColumn("_no", F.row_number().over(order)).filter(F.col("_no") <= most)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def divided(lists: DataFrame, links: DataFrame) -> DataFrame:
    """Lists whose classes are in several components, with each one's ``comp``."""
    named = components(links).select(F.col("id").alias("cid"), F.col("component").alias("_known"))
    held = stage(lists.join(named, "cid", "left").select("key", "cid", "n", "m", F.coalesce("_known", "cid").alias("comp")), "held")
    mixed = held.groupBy("key").agg(F.min("comp").alias("_x"), F.max("comp").alias("_y")).filter("_x <> _y").select("key")
    return held.join(mixed, "key", "left_semi")


def named_groups(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Rows (doc_id, n_shingles, digest, component_id) of all documents."""
    rows, classes, links = link(docs, words, percent)
    named = components(links).select(F.col("id").alias("cid"), F.col("component").alias("_c"))
    joined = stage(classes.select("cid", "digest", "rep").join(named, "cid", "left").select("digest", "rep", F.coalesce("_c", "cid").alias("_c")), "named")
    least = joined.groupBy("_c").agg(F.min("rep").alias("component_id"))
    found = joined.join(least, "_c").select("digest", "component_id", "_c")
    whole = rows.filter("n > 0").select("doc_id", F.col("n").alias("n_shingles"), "digest").join(found, "digest")
    empty = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), "digest", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("_c"))
    return whole.select(*empty.columns).unionByName(empty)


def groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles`` and ``component_id``, the smallest
    ``doc_id`` that links reach from it."""
    return named_groups(docs, words, percent).select("doc_id", "n_shingles", "component_id")


def keep_first(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest ``doc_id``, null last.  Rows are
    told apart by ``doc_id`` and set, so rows equal in both are one.  Rows without words stay."""
    found = stage(named_groups(docs, words, percent), "groups")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("_no"), "doc_id", "digest"))
    worded = found.filter("n_shingles > 0").select("doc_id", "digest", "_c")
    firsts = worded.groupBy("_c").agg(best.alias("_k"))
    kept = firsts.select(F.col("_k.doc_id").alias("_id"), F.col("_k.digest").alias("_digest"))
    # rows that go or come several times; all others are kept where they are
    is_first = F.col("doc_id").eqNullSafe(F.col("_k.doc_id")) & (F.col("digest") == F.col("_k.digest"))
    keyed = worded.join(firsts, "_c").groupBy("doc_id", "digest").agg(F.count("*").alias("_rows"), F.bool_or(is_first).alias("_first"))
    doubtful = keyed.filter("_rows > 1 or not _first").select(F.xxhash64("doc_id", "digest"))

    def run(batches):
        shingler = Shingler(words)
        for batch in batches:
            for chunk in text_chunks(batch):
                sets = list(shingler.sets(chunk.column("text")))
                marks = pa.array([digest(s) if len(s) else None for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([*chunk.columns, marks], [*chunk.schema.names, "_mark"])

    schema = T.StructType([*docs.schema.fields, T.StructField("_mark", T.BinaryType())])
    marked = flagged(docs.mapInArrow(released(run), schema), F.xxhash64("doc_id", "_mark"), doubtful, "_maybe")
    moved = F.col("_maybe") & F.col("_mark").isNotNull()
    same = (F.col("_mark") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    first = marked.filter(moved).join(kept, same).dropDuplicates(["doc_id", "_mark"])
    return first.select(*docs.columns).unionByName(marked.filter(~moved).select(*docs.columns))
