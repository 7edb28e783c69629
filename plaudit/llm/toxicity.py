r"""Toxicity by a weighted finite-state grammar of clauses, with a lexicon learned from labels.

A text is cut into clauses (at . ! ? ; : and line ends) and a clause into words.  Every word has a
class: insult, threat, target (the one spoken to or about), negation, report (said, wrote ...)
or other.  Small transducers read the classes, each passing weights on to the next:

- *insult* gives a word of the lexicon its weight, and a threat word ``THREAT``;
- *target* multiplies a weight by ``AIMED`` when a target stands within ``NEAR`` words before
  it, and a threat counts only then;
- *negation* takes a weight down by ``NEGATED`` within ``SCOPE`` words after a negation;
- *reported speech* takes it down by ``REPORTED`` from a report verb to the end of the clause.

Their product is one automaton whose state is (words since a target, words since a negation,
reported or not); it is worked out once, as a table.  A clause scores the sum of the weights that
the automaton passes, of its ``BEST`` heaviest words so that length alone says nothing, and a
document the sum of its ``TOP`` best clauses, turned into 0 to 1 by a logistic curve.

*Learning.*  Lexicon entries are whole words and word beginnings of 3 to 7 letters.  They are
counted by how many different neighbours (word before, word after) their words occur between,
in toxic and in clean texts, so copies of one text count once.  An entry's weight is the log odds of
the lower bound of its precision at equal class sizes; entries below ``LEAST_ODDS`` are left
out.  The curve is fitted on scores of rows whose texts are in the other half of a hash, under a
lexicon of the half they are not in.  The fit uses at most ``FIT_TOXIC`` toxic and
``FIT_CLEAN`` clean labelled rows (bounds of what is learned from, by a hash of the text); all
rows are scored, by whole texts.

Defined cases: null and empty texts score what a text without matched clauses does; rows without
``doc_id`` are not held out, and not learned from; of contradicting labels for a ``doc_id`` the
larger counts; without labels of both kinds the lexicon is empty and each score is ``UNKNOWN``; repeated rows are
scored each; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from plaudit.llm.chunks import texts_of
from plaudit.staging import stage

FIT_TOXIC, FIT_CLEAN = 4000, 8000
LEXICON = 20_000  # most entries
FIRST_LETTERS = range(3, 8)
LEAST_CONTEXTS = 4  # different neighbours of an entry in toxic texts
DOUBT = 2.0  # standard deviations below the precision seen
LEAST_ODDS = 0.9
UNKNOWN = 0.0
BEST, TOP = 2, 6
THREAT = 1.5
AIMED, NEGATED, REPORTED = 1.25, 0.5, 0.6
NEAR, SCOPE = 3, 3
SLICE_CHARS = 1_000_000
KNOWN_WORDS = 500_000  # remembered by a task

# Cue words of the four languages.
TARGETS = "you your youre u he she they them these those du dich dir euch ihr sie tu te toi vous ils elles tú ti usted ustedes vosotros ellos ellas".split()
NEGATIONS = "not no never none neither nor without isn't aren't don't nicht kein keine keinen nie niemals ohne pas jamais aucun aucune sans nunca jamás ningún ninguna sin".split()
REPORTS = "said says say wrote writes called calls claimed claims quoted sagte sagt schrieb nannte nennt behauptet dit disait écrit appelle appelé dijo dice escribió llamó llama".split()
THREATS = "kill hurt destroy punish beat burn töten umbringen verletzen vernichten tuer frapper détruire brûler matar golpear destruir quemar".split()
OTHER, INSULT, THREATENS, TARGET, NEGATION, REPORT = range(6)
CUES = {**dict.fromkeys(TARGETS, TARGET), **dict.fromkeys(NEGATIONS, NEGATION), **dict.fromkeys(REPORTS, REPORT), **dict.fromkeys(THREATS, THREATENS)}

CLAUSE = regex.compile(r"[^.!?;:\n]+")
WORD = regex.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")


@dataclass(frozen=True)
class Transducer:
    """States 0 .. n - 1; ``step[state][class]`` is the next state and ``scale[state][class]`` what
    a weight of that class is multiplied by."""

    step: list[list[int]]
    scale: list[list[float]]

    def then(self, other: Transducer) -> Transducer:
        """The product: both read the classes, and weights pass both."""
        n = len(other.step)
        pairs = [(a, b) for a in range(len(self.step)) for b in range(n)]
        classes = range(len(CLASSES))
        return Transducer(
            [[self.step[a][c] * n + other.step[b][c] for c in classes] for a, b in pairs],
            [[self.scale[a][c] * other.scale[b][c] for c in classes] for a, b in pairs],
        )


CLASSES = (OTHER, INSULT, THREATENS, TARGET, NEGATION, REPORT)


def window(opens: int, length: int, inside: dict[int, float], outside: dict[int, float]) -> Transducer:
    """A cue class opens a window of ``length`` words, inside which weights scale by ``inside``.
    The state is how many words of the window are left."""
    step = [[length if c == opens else max(0, left - 1) for c in CLASSES] for left in range(length + 1)]
    scale = [[(inside if left else outside).get(c, 1.0) for c in CLASSES] for left in range(length + 1)]
    return Transducer(step, scale)


def grammar() -> Transducer:
    words = Transducer([[0] * len(CLASSES)], [[1.0 if c in (INSULT, THREATENS) else 0.0 for c in CLASSES]])
    target = window(TARGET, NEAR, {INSULT: AIMED, THREATENS: AIMED}, {THREATENS: 0.0})
    negation = window(NEGATION, SCOPE, {INSULT: NEGATED, THREATENS: NEGATED}, {})
    report = Transducer(
        [[int(c == REPORT) for c in CLASSES], [1] * len(CLASSES)],
        [[1.0] * len(CLASSES), [REPORTED if c in (INSULT, THREATENS) else 1.0 for c in CLASSES]],
    )
    return words.then(target).then(negation).then(report)


def entries_of(word: str) -> list[str]:
    """Lexicon entries that a word has: itself, with a blank behind, and its beginnings."""
    return [word + " ", *(word[:k] for k in FIRST_LETTERS if len(word) >= k)]


def clauses(text: str) -> Iterator[str]:
    """Clauses, in slices of bounded size where a clause is very long."""
    for m in CLAUSE.finditer(text):
        clause, at = m[0], 0
        while len(clause) - at > SLICE_CHARS:
            end = clause.find(" ", at + SLICE_CHARS)
            if end < 0:
                break
            yield clause[at:end]
            at = end
        yield clause[at:]


class Scorer:
    """Scores texts by a lexicon and the grammar."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        machine = grammar()
        self.step, self.scale = machine.step, machine.scale
        self.known: dict[str, tuple[int, float]] = {}

    def reads(self, word: str) -> tuple[int, float]:
        """Class and weight of a word in small letters."""
        found = self.known.get(word)
        if found is None:
            weight = max((self.lexicon[e] for e in entries_of(word) if e in self.lexicon), default=0.0)
            found = (INSULT, weight) if weight else (CUES.get(word, OTHER), THREAT)
            if len(self.known) >= KNOWN_WORDS:
                self.known.clear()
            self.known[word] = found
        return found

    def clause(self, words: Iterable[str]) -> float:
        state, best = 0, [0.0] * BEST
        for word in words:
            kind, weight = self.reads(word)
            scale = self.scale[state][kind]
            if scale * weight > best[-1]:
                best = sorted([*best, scale * weight], reverse=True)[:BEST]
            state = self.step[state][kind]
        return sum(best)

    def evidence(self, text: str) -> float:
        """Sum of the best clauses."""
        best: list[float] = []
        for clause in clauses(text.lower()):
            found = self.clause(m[0] for m in WORD.finditer(clause)) if len(clause) > SLICE_CHARS else self.clause(WORD.findall(clause))
            if found:
                best = sorted([*best, found], reverse=True)[:TOP]
        return sum(best)


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    slope: float
    start: float

    def chance(self, evidence: np.ndarray) -> np.ndarray:
        if not self.lexicon:
            return np.full(len(evidence), UNKNOWN)
        return 1 / (1 + np.exp(-(self.start + self.slope * evidence).clip(-500, 500)))


def precision_bound(toxic: float, clean: float) -> float:
    """Lower bound of the share of toxic among so many, by Wilson's interval."""
    n = toxic + clean
    share = toxic / n
    z = DOUBT
    return (share + z * z / (2 * n) - z * math.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def count_contexts(sample: DataFrame) -> DataFrame:
    """Rows (half, toxic, entry, contexts): between how many different neighbours an entry's words
    occur.  Only words travel with their neighbours, each once for a stretch of texts; their
    beginnings are made from the counts."""

    def run(batches):
        for batch in batches:
            rows: set[tuple] = set()
            groups = zip(batch.column("half").to_pylist(), batch.column("toxic").to_pylist(), texts_of(batch))
            for half, toxic, text in groups:
                before, words = "", iter(WORD.finditer(text.lower()))
                present = next(words, None)
                while present is not None:
                    word, following = present[0], next(words, None)
                    rows.add((half, toxic, word, hash_of(before, following[0] if following else "")))
                    before, present = word, following
                    if len(rows) >= 200_000:
                        yield _columns(rows)
                        rows = set()
            if rows:
                yield _columns(rows)

    found = sample.select("half", "toxic", "text").mapInArrow(run, "half int, toxic int, word string, near long")
    words = found.distinct().groupBy("half", "toxic", "word").agg(F.count(F.lit(1)).alias("n"))
    beginnings = [F.when(F.length("word") >= k, F.substring("word", 1, k)) for k in FIRST_LETTERS]
    entries = F.explode(F.array_compact(F.array(F.concat("word", F.lit(" ")), *beginnings)))
    return words.select("half", "toxic", entries.alias("entry"), "n").groupBy("half", "toxic", "entry").agg(F.sum("n").alias("contexts"))


def _columns(rows: set[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["half", "toxic", "word", "near"])


def hash_of(before: str, after: str) -> int:
    """The same number in every task (``hash`` differs between workers)."""
    return zlib.crc32(before.encode()) << 31 ^ zlib.crc32(after.encode())


def weights(counts: list[tuple[str, int, int]], toxic_rows: int, clean_rows: int) -> dict[str, float]:
    """Lexicon of (entry, toxic contexts, clean contexts)."""
    even = toxic_rows / max(1, clean_rows)
    made = {}
    for entry, toxic, clean in counts:
        bound = precision_bound(toxic, clean * even)
        odds = math.log(bound / (1 - bound)) if 0 < bound < 1 else 0.0
        if odds >= LEAST_ODDS:
            made[entry] = odds
    # an entry counts only where no shorter one says as much
    return {e: w for e, w in made.items() if not any(made.get(e.rstrip()[:k], 0) >= w for k in FIRST_LETTERS if k < len(e))}


def fit_curve(evidence: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and start of the logistic curve, by Newton's method with a little shrinkage."""
    x = np.stack([evidence, np.ones(len(evidence))], axis=1)
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ b).clip(-30, 30)))
        grad = x.T @ (toxic - p) - np.array([1e-2, 1e-2]) * b
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2) * 1e-2, grad)
        b = b + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(b[0], 0.0)), float(b[1])


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (half, toxic, text) of the bounded sample of labelled rows, one for each text."""
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    known = known.filter(~held_out())
    texts = docs.filter("text is not null").select("doc_id", "text", F.xxhash64("text").alias("_m"))
    marks = stage(texts.select("doc_id", "_m").join(known, "doc_id").select("toxic", "_m").distinct(), "marks")
    within = F.lit(False)
    for kind, most in ((1, FIT_TOXIC), (0, FIT_CLEAN)):
        least = marks.filter(F.col("toxic") == kind).select("_m").orderBy("_m").limit(most)
        last = least.agg(F.max("_m")).first()[0]
        within = within | ((F.col("toxic") == kind) & (F.col("_m") <= F.lit(last)))
    # texts move only if their mark is among those taken
    rows = texts.join(known, "doc_id").filter(within).dropDuplicates(["toxic", "_m"])
    half = F.col("_m").bitwiseAND(F.lit(1)).cast("int")
    return stage(rows.select(half.alias("half"), "toxic", "text").repartition(64), "labelled")


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Lexicon and curve from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    sample = training_rows(docs, labels)
    sizes = {(r["half"], r["toxic"]): r["count"] for r in sample.groupBy("half", "toxic").count().collect()}
    rows = {kind: sum(n for (_, t), n in sizes.items() if t == kind) for kind in (0, 1)}
    if not rows[0] or not rows[1]:
        return Model({}, 0.0, 0.0)
    contexts = stage(count_contexts(sample), "contexts")
    seen = contexts.groupBy("entry").agg(
        *[F.coalesce(F.sum(F.when((F.col("half") == h) & (F.col("toxic") == t), F.col("contexts"))), F.lit(0)).alias(f"n{h}{t}") for h in (0, 1) for t in (0, 1)]
    )
    likely = seen.filter(F.col("n01") + F.col("n11") >= LEAST_CONTEXTS)
    # entries most of whose contexts are toxic at equal class sizes; the fit's bound keeps this list short
    even = rows[1] / rows[0]
    likely = likely.filter((F.col("n01") + F.col("n11")) > (F.col("n00") + F.col("n10")) * even)
    counts = likely.orderBy(F.desc(F.col("n01") + F.col("n11")), "entry").limit(LEXICON).collect()
    whole = weights([(r["entry"], r["n01"] + r["n11"], r["n00"] + r["n10"]) for r in counts], rows[1], rows[0])
    halves = {
        h: weights([(r["entry"], r[f"n{h}1"], r[f"n{h}0"]) for r in counts if r[f"n{h}1"]], sizes.get((h, 1), 0), sizes.get((h, 0), 0)) for h in (0, 1)
    }

    def run(batches):
        scorers = {h: Scorer(lexicon) for h, lexicon in halves.items()}
        for batch in batches:
            halves_of = batch.column("half").to_pylist()
            found = [scorers[1 - h].evidence(t) for h, t in zip(halves_of, texts_of(batch))]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.float64())], ["toxic", "evidence"])

    scored = sample.mapInArrow(run, "toxic int, evidence double").toPandas().sort_values(["toxic", "evidence"])
    slope, start = fit_curve(scored["evidence"].to_numpy(), scored["toxic"].to_numpy(np.float64))
    return Model(whole, slope, start)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted) for all of ``docs`` (doc_id, text)."""

    def run(batches):
        scorer = Scorer(model.lexicon)
        for batch in batches:
            found = np.array([scorer.evidence(t) for t in texts_of(batch)], np.float64)
            chances = model.chance(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(chances), pa.array((chances >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        run, f"doc_id {key}, held_out boolean, score double, predicted int"
    )


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, learn(docs, labels))
