"""Quality by perplexity under an interpolated modified Kneser-Ney model of letters.

The model counts n-grams of ``ORDER`` letters of trusted texts.  Letters are code points as they
are written, nothing is folded: an n-gram is a pair (c, w) of its context, ``ORDER - 1`` letters of
21 bits each, and its last letter.  Its tables grow with the n-grams of the corpus.  Counts,
continuation counts, statistics of contexts and probabilities are tables keyed by n-gram that
only meet in joins on it, each shard of keys in its own task.  The model is asked for the
n-grams that the documents hold.

Texts stay where they are: a task over documents sends, for each piece of its texts, the distinct
n-grams of a shard with the documents they are in as one packed row; the shard joins them with
their costs and sends back one sum for each document, and the sums meet per document.  A shard
takes about ``SHARD_GRAMS`` n-grams, so there are more shards for a larger corpus.  N-grams that
make up at least one part in ``COMMON`` of all letters are at most ``COMMON`` (21 MB); their costs
go to every task, so no shard gets the lists of a frequent n-gram.

Limits are language-specific: a quantile of the log-perplexity of trusted texts that were kept
out of training, found with exact counts over narrow bins, plus ``SLACK``.  A language's quantile
is drawn towards the one of all languages by the weight of ``PRIOR`` texts.  The perplexity of
short texts scatters, so each text gets a margin that falls with the square root of its length.

Defined cases: null, empty and blank texts have no perplexity and are not kept; a null language,
or one without held-out trusted texts, takes the limit of all languages together; without
held-out trusted texts every text with letters is kept; null and repeated ``doc_id`` are kept, one
output row for each input row (a ``doc_id`` is trusted if one of its labels says so and none says
otherwise); other columns are ignored by ``judge``, and ``keep`` returns them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from plaudit.llm.chunks import released, text_chunks, texts_of
from plaudit.llm.select import rows_of
from plaudit.staging import stage

ORDER = 4
BITS = 21  # of a code point and one; 0 stands in front of a text
LETTERS = 0x110000
CHUNK_BYTES = 4_000_000
SHARD_GRAMS = 500_000
COMMON = 1 << 20
QUANTILE = 0.995
PRIOR = 20  # texts
BIN = 0.001
SLACK = 0.1  # of log-perplexity, added to the quantile
MARGIN = 1.5  # of log-perplexity for a text of one letter; falls with the root of the length
ROW_BITS = 33

Grams = tuple[np.ndarray, np.ndarray]  # contexts and last letters


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters of all texts, each text padded in front with ``ORDER - 1`` zeros; where the letters
    themselves stand; and how many each text has.  Runs of white space count as one blank."""
    texts = [" ".join(text.split()) for text in texts]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    letters = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.arange(len(letters)) + np.repeat((ORDER - 1) * np.arange(1, len(texts) + 1), lengths)
    padded = np.zeros(len(letters) + (ORDER - 1) * len(texts), np.uint32)
    padded[at] = letters + 1
    return padded, at, lengths


def distinct(padded: np.ndarray, at: np.ndarray) -> Iterator[tuple[Grams, np.ndarray, slice]]:
    """Distinct n-grams that end at the places ``at``, and which of them ends at each place.

    Letters get numbers of 16 bits, so that an n-gram is one number; places that hold more
    different letters than that are taken in slices too short to."""
    used = np.zeros(1 << BITS, bool)
    used[padded] = True
    step = max(1, len(at)) if np.count_nonzero(used) <= 1 << 16 else (1 << 16) // ORDER
    for start in range(0, len(at), step):
        ends = at[start : start + step]
        used[:] = False
        for back in range(ORDER):
            used[padded[ends - back]] = True
        alphabet = np.flatnonzero(used).astype(np.uint64)
        number = np.zeros(1 << BITS, np.uint16)
        number[alphabet] = np.arange(len(alphabet))
        packed = np.zeros(len(ends), np.uint64)
        for back in range(ORDER):
            packed |= number[padded[ends - back]].astype(np.uint64) << np.uint64(16 * back)
        # as np.unique does it, with smaller numbers and fewer copies
        order = np.argsort(packed)
        packed = packed[order]
        first = np.concatenate([np.ones(min(1, len(packed)), bool), packed[1:] != packed[:-1]])
        found = packed[first]
        which = np.empty(len(packed), np.int32)
        which[order] = np.cumsum(first, dtype=np.int32) - 1
        del packed, order, first
        letter = [alphabet[(found >> np.uint64(16 * back)) & np.uint64(0xFFFF)] for back in range(ORDER)]
        context = sum((letter[back] << np.uint64(BITS * (back - 1)) for back in range(1, ORDER)), np.zeros(len(found), np.uint64))
        yield (context, letter[0]), which, slice(start, start + len(ends))


def chunks(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for chunk in text_chunks(batch, most=CHUNK_BYTES):
            padded, at, lengths = windows(texts_of(chunk))
            yield chunk, lengths, distinct(padded, at)


# ---- the model ---------------------------------------------------------------
def count_grams(texts: DataFrame) -> DataFrame:
    """Rows (c, w, n) of the longest n-grams of all texts; a piece of texts sends each once."""

    def run(batches):
        for _, _, parts in chunks(batches):
            for (c, w), which, _ in parts:
                columns = [pa.array(c.view(np.int64)), pa.array(w.astype(np.int32)), pa.array(np.bincount(which, minlength=len(c)))]
                yield pa.RecordBatch.from_arrays(columns, ["c", "w", "n"])

    return texts.select("text").mapInArrow(released(run), "c long, w int, n long").groupBy("c", "w").agg(F.sum("n").alias("n"))


def shortened(size: int) -> Column:
    """The context of the last ``size`` letters."""
    return F.col("c") % F.lit(1 << BITS * (size - 1)).cast("long")


def levels(top: DataFrame) -> list[DataFrame]:
    """Counts of all orders, shortest first: of the longest n-grams how often they occur, of
    shorter ones how many different letters stand in front of them."""
    made = [stage(top, "grams")]
    for size in range(ORDER - 1, 0, -1):
        shorter = made[0].select(shortened(size).alias("c"), "w")
        made.insert(0, stage(shorter.groupBy("c", "w").agg(F.count("*").alias("n")), "grams"))
    return made


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Discounts of n-grams seen once, twice and more often, from how many there are of those
    seen one to four times."""
    n1, n2, n3, n4 = (max(int(v), 1) for v in counts.agg(*(F.count_if(F.col("n") == i) for i in (1, 2, 3, 4))).first())
    y = n1 / (n1 + 2 * n2)
    plain = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    # tables of few n-grams can give values out of range
    return tuple(min(max(d, 0.05), i - 0.05) for i, d in enumerate(plain, 1))


def taken(d: tuple[float, float, float]) -> Column:
    """The discount of a count."""
    return F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])


def costs(counts: list[DataFrame], asked: DataFrame) -> DataFrame:
    """Rows (c, w, times, cost) for the asked n-grams: the negative log of their probability.

    Going up from single letters, p(w | h) = (n(hw) - D) / n(h) + gamma(h) * p(w | h'), where
    h' is h without its first letter; an unseen context passes on p(w | h')."""
    below = None
    for size, level in enumerate(counts, 1):
        d = discounts(level)
        contexts = level.groupBy("c").agg(F.sum("n").alias("total"), F.sum(taken(d)).alias("lost"))
        wanted = asked if size == len(counts) else asked.select(shortened(size).alias("c"), "w").distinct()
        joined = wanted.join(level, ["c", "w"], "left").join(contexts, "c", "left")
        if below is None:
            joined = joined.withColumn("lower", F.lit(1.0 / LETTERS))
        else:
            lower = below.select(F.col("c").alias("_c"), F.col("w").alias("_w"), F.col("p").alias("lower"))
            joined = joined.join(lower, (shortened(size - 1) == F.col("_c")) & (F.col("w") == F.col("_w")))
        own = F.when(F.col("n") > 0, (F.col("n") - taken(d)) / F.col("total")).otherwise(0.0)
        rest = F.coalesce(F.col("lost") / F.col("total"), F.lit(1.0))
        kept = ["c", "w"] if size < len(counts) else ["c", "w", "times"]
        below = stage(joined.select(*kept, (own + rest * F.col("lower")).alias("p")), "level")
    return below.select("c", "w", "times", (-F.log("p")).alias("cost"))


def fit(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Costs of the n-grams of ``docs`` under the model of ``trusted``."""
    asked = stage(count_grams(docs).withColumnRenamed("n", "times"), "asked")
    return stage(costs(levels(count_grams(trusted)), asked), "costs")


# ---- scores ------------------------------------------------------------------
ASKED = "shard long, first long, c binary, w binary, docs binary, runs binary, times binary, doc string, lang string, letters long, nats double"


class Costs:
    """A table of costs in memory, looked up by n-gram."""

    def __init__(self, c: np.ndarray, w: np.ndarray, cost: np.ndarray):
        order = np.lexsort((w, c))
        self.contexts, first = np.unique(c[order], return_index=True)
        place = np.repeat(np.arange(len(first), dtype=np.uint64), np.diff(first, append=len(c)))
        self.keys = place << np.uint64(BITS) | w[order].astype(np.uint64)
        self.cost = cost[order]

    def of(self, c: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which n-grams are in the table, and their costs (0 for others)."""
        if not len(self.keys):
            return np.zeros(len(c), bool), np.zeros(len(c))
        place = np.minimum(np.searchsorted(self.contexts, c), len(self.contexts) - 1)
        keys = place.astype(np.uint64) << np.uint64(BITS) | w
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        held = (self.contexts[place] == c) & (self.keys[at] == keys)
        return held, np.where(held, self.cost[at], 0.0)


def common(found: DataFrame) -> tuple[Column, tuple[np.ndarray, ...]]:
    """Which n-grams are common, and contexts, letters and costs of those: at most ``COMMON`` rows."""
    letters = found.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]
    often = F.col("times") >= F.lit(letters / COMMON)
    table = found.filter(often).select("c", "w", F.col("cost").cast("float").alias("cost")).toArrow()
    c, w, cost = (column.combine_chunks().to_numpy(zero_copy_only=False) for column in table.columns)
    return often, (c.astype(np.int64).view(np.uint64), w.astype(np.uint32), cost)


def shard_of(c: np.ndarray, w: np.ndarray, shards: int) -> np.ndarray:
    """Shards, a power of two, from a hash of the n-gram."""
    x = (c ^ (c >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + w.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(27))) & np.uint64(shards - 1)).astype(np.int64)


def planes(numbers: np.ndarray) -> bytes:
    """Ascending numbers as gaps, byte by byte, so that the empty high bytes compress."""
    gaps = np.diff(numbers, prepend=np.uint64(0))
    return np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unplaned(data: bytes) -> np.ndarray:
    parts = np.frombuffer(data, np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(parts).view(np.uint64).ravel(), dtype=np.uint64)


def ask(docs: DataFrame, known: tuple[np.ndarray, ...], shards: int) -> DataFrame:
    """Two kinds of rows: with null ``shard`` one per document (``first`` is its number), with
    what its common n-grams cost; the others ask a shard for a piece of texts, whose numbers
    begin at ``first``: n-grams by context, and the documents of each with how often they hold it."""

    def run(batches):
        number = TaskContext.get().partitionId() << ROW_BITS
        table = Costs(*known)
        for chunk, lengths, parts in chunks(batches):
            owner = np.repeat(np.arange(len(lengths)), lengths)
            sums, asked = np.zeros(len(lengths)), []
            for (c, w), which, place in parts:
                mine = owner[place]
                held, cost = table.of(c, w)
                sums += np.bincount(mine, cost[which], len(lengths))
                rare = np.flatnonzero(~held[which])
                # one row for each n-gram of each document
                pair, times = np.unique(which[rare].astype(np.uint64) << np.uint64(32) | mine[rare].astype(np.uint64), return_counts=True)
                gram = (pair >> np.uint64(32)).astype(np.int64)
                shard = shard_of(c[gram], w[gram], shards)
                order = np.lexsort((w[gram], c[gram], shard))
                gram, shard, times = gram[order], shard[order], times[order].astype(np.uint32)
                holder = (pair[order] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                for a, b in spans(shard):
                    starts = np.flatnonzero(np.concatenate([[True], gram[a + 1 : b] != gram[a : b - 1]])) + a
                    runs = np.diff(starts, append=b).astype(np.uint32)
                    data = (planes(c[gram[starts]]), w[gram[starts]].astype(np.uint32), holder[a:b], runs, times[a:b])
                    asked.append((int(shard[a]), data[0], *(x.tobytes() for x in data[1:])))
            n, none = len(asked), len(lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([s for s, *_ in asked] + [None] * none, pa.int64()),
                    pa.array(np.concatenate([np.full(n, number), number + np.arange(none)])),
                    *(pa.array([a[i] for a in asked] + [None] * none, pa.binary()) for i in range(1, 6)),
                    pa.concat_arrays([pa.nulls(n, pa.string()), chunk.column("doc_id").cast(pa.string())]),
                    pa.concat_arrays([pa.nulls(n, pa.string()), chunk.column("lang").cast(pa.string())]),
                    pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(lengths)]),
                    pa.concat_arrays([pa.nulls(n, pa.float64()), pa.array(sums)]),
                ],
                [column.split()[0] for column in ASKED.split(", ")],
            )
            number += none

    return docs.select("doc_id", F.col("lang").cast("string").alias("lang"), "text").mapInArrow(released(run), ASKED)


def spans(ordered: np.ndarray) -> list[tuple[int, int]]:
    """Starts and ends of the runs of equal numbers."""
    cuts = [0, *(np.flatnonzero(ordered[1:] != ordered[:-1]) + 1).tolist(), len(ordered)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]


def dealt(found: DataFrame, shards: int) -> DataFrame:
    """Costs with their shards."""

    def run(batches):
        for batch in batches:
            c, w = batch.column("c").to_numpy().view(np.uint64), batch.column("w").to_numpy()
            columns = [pa.array(shard_of(c, w, shards)), batch.column("c"), batch.column("w"), batch.column("cost")]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "context", "letter", "cost"])

    rows = found.select("c", "w", F.col("cost").cast("float").alias("cost"))
    return rows.mapInArrow(released(run), "shard long, context long, letter int, cost float")


def answers(asked: DataFrame, rare: DataFrame, shards: int) -> DataFrame:
    """Rows (first, shard, rows, sums): for a piece of texts, what n-grams of a shard cost its
    documents.  The costs of a shard come first, then the pieces that ask for them."""
    wanted = asked.select("shard", "first", "c", "w", "docs", "runs", "times")
    both = rare.unionByName(wanted, allowMissingColumns=True).repartition(shards, "shard")

    def run(batches):
        shard, held, table = None, [], None
        for batch in batches:
            of_row = batch.column("shard").to_numpy()
            for a, b in spans(of_row):
                if of_row[a] != shard:
                    shard, held, table = of_row[a], [], None
                part = batch.slice(a, b - a)
                model = part.filter(part.column("letter").is_valid())
                held.append([model.column(c).to_numpy() for c in ("context", "letter", "cost")])
                out = []
                for row in part.slice(model.num_rows).to_pylist():
                    if table is None:
                        c, w, cost = (np.concatenate(columns) for columns in zip(*held))
                        table, held = Costs(c.view(np.uint64), w.astype(np.uint32), cost.astype(np.float64)), []
                    letters, docs, runs, times = (np.frombuffer(row[c], np.uint32) for c in ("w", "docs", "runs", "times"))
                    _, cost = table.of(unplaned(row["c"]), letters.astype(np.uint64))
                    sums = np.bincount(docs, np.repeat(cost, runs) * times)
                    some = np.flatnonzero(sums)
                    out.append((row["first"], int(shard), some.astype(np.uint32).tobytes(), sums[some].tobytes()))
                if out:
                    types = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["first", "shard", "rows", "sums"])

    ordered = both.sortWithinPartitions("shard", F.col("letter").isNull())
    return ordered.mapInArrow(released(run), "first long, shard long, rows binary, sums binary")


def sums_by_document(answered: DataFrame) -> DataFrame:
    """Rows (first, more): what the n-grams of the shards cost the document numbered ``first``; the sums of
    a piece are added in the order of shards, so they are the same in every run."""

    def run(batches):
        held, number = np.zeros(0), None

        def done():
            some = np.flatnonzero(held)
            return pa.RecordBatch.from_arrays([pa.array(number + some), pa.array(held[some])], ["first", "more"])

        for batch in batches:
            for first, rows, sums in zip(*(batch.column(c) for c in ("first", "rows", "sums"))):
                if first.as_py() != number:
                    if number is not None:
                        yield done()
                    held, number = np.zeros(0), first.as_py()
                at = np.frombuffer(rows.as_buffer(), np.uint32)
                if len(at):
                    if at[-1] >= len(held):
                        held = np.concatenate([held, np.zeros(int(at[-1]) + 1 - len(held))])
                    held[at] += np.frombuffer(sums.as_buffer(), np.float64)
        if number is not None:
            yield done()

    return answered.repartition("first").sortWithinPartitions("first", "shard").mapInArrow(released(run), "first long, more double")


def score(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` columns doc_id, lang, and ``letters`` and ``nats``: their number in the text, and
    the mean cost of a letter."""
    often, known = common(found)
    rare = found.filter(~often)
    shards = 1 << max(3, math.ceil(rare.count() / SHARD_GRAMS).bit_length())
    asked = stage(ask(docs, known, shards), "asked")
    more = sums_by_document(answers(asked.filter("shard is not null"), dealt(rare, shards), shards))
    told = asked.filter("shard is null").select("first", "doc", "lang", "letters", "nats").join(more, "first", "left")
    mean = (F.col("nats") + F.coalesce("more", F.lit(0.0))) / F.col("letters")
    key = docs.schema["doc_id"].dataType
    return told.select(F.col("doc").cast(key).alias("doc_id"), "lang", "letters", F.when(F.col("letters") > 0, mean).alias("nats"))


# ---- limits ------------------------------------------------------------------
def quantiles(scored: DataFrame, share: float) -> DataFrame:
    """Rows (lang, limit, texts) of the ``nats`` below which ``share`` of the texts are; the row
    of null stands for all languages.  Values count in bins, so a language of any size is a
    few thousand counts."""
    bins = scored.filter("nats is not null").select("lang", F.ceil(F.col("nats") / BIN).alias("bin"))
    counted = bins.groupBy("lang", "bin").agg(F.count("*").alias("n"))
    whole = counted.groupBy("bin").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), "bin", "n")
    each = counted.filter("lang is not null").unionByName(whole)
    up = W.partitionBy("lang").orderBy("bin")
    summed = each.withColumn("below", F.sum("n").over(up)).withColumn("texts", F.sum("n").over(W.partitionBy("lang")))
    return summed.filter(F.col("below") >= share * F.col("texts")).groupBy("lang").agg(
        (F.min("bin") * BIN).alias("limit"), F.first("texts").alias("texts")
    )


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents whose labels all say quality 1 and not toxic."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    return labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min(F.coalesce(good, F.lit(False))).alias("_good")).filter("_good").select("doc_id")


def testing() -> Column:
    """A fifth of the documents: trusted ones among them set the limits, and train nothing."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def scatter() -> Column:
    return MARGIN / F.sqrt(F.greatest("letters", F.lit(1)))


def judged(docs: DataFrame, labels: DataFrame, number: str = "doc_id") -> DataFrame:
    """Scores of all documents with ``limit`` and ``kept``; column ``doc_id`` holds ``number``."""
    ids = trusted_ids(labels)
    found = fit(docs, rows_of(docs.select("doc_id", "text"), ids.filter(~testing())))
    named = docs.select(F.col(number).alias("doc_id"), "lang", "text")
    scored = stage(score(named, found), "scored")
    held_out = scored
    if number != "doc_id":
        held_out = scored.withColumnRenamed("doc_id", number).join(docs.select(number, "doc_id"), number)
    held_out = held_out.join(ids.filter(testing()), "doc_id", "left_semi")
    # what remains of a text's own scatter is not part of the limit
    found = stage(quantiles(held_out.withColumn("nats", F.col("nats") - scatter()), QUANTILE), "limits")
    general = found.filter("lang is null").select("limit").scalar()
    own = found.filter("lang is not null").select(F.col("lang").alias("_lang"), F.col("limit").alias("_own"), "texts")
    rows = scored.join(own, F.col("lang") == F.col("_lang"), "left")
    weight = F.coalesce("texts", F.lit(0))
    limit = (weight * F.coalesce("_own", F.lit(0.0)) + PRIOR * general) / (weight + PRIOR) + SLACK + scatter()
    good = (F.col("letters") > 0) & F.coalesce(F.col("nats") <= limit, F.lit(True))
    return rows.select("doc_id", "lang", "letters", "nats", limit.alias("limit"), good.alias("kept"))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``lang``, ``perplexity`` of a letter, ``limit`` and
    ``kept``."""
    return judged(docs, labels).select(
        "doc_id", "lang", F.exp("nats").alias("perplexity"), F.exp("limit").alias("limit"), "kept"
    )


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that ``judge`` keeps.  They are numbered in a written copy, so that rows
    with null or repeated ids are each judged on their own; a column ``_row`` is not allowed."""
    numbered = stage(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    gone = judged(numbered, labels, "_row").filter("not kept").select(F.col("doc_id").alias("_row"))
    return numbered.join(stage(gone, "gone"), "_row", "left_anti").select(*docs.columns)
