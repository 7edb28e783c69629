"""Secret scans over a trigram inverted index, in DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived: a list of
alternatives, each the trigrams that every match of it must hold.  ``gram_index`` lists the
documents in which each of these trigrams occurs, ``candidates`` intersects the posting
lists, and only candidates are searched with the expression itself.  A rule without
mandatory trigrams is searched in every document.

The index is made for the trigrams of a rule set.  Postings are keyed by document, never
gathered by trigram, so a trigram that occurs in every document is no hot key.

Defined cases: a null text is an empty one, a document without a find has empty spans;
null and repeated ``doc_id`` are allowed, each input row gives one row; other columns are
ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

SPAN = "array<struct<kind:string,start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` to ``most`` characters.
    ``pattern`` has a meaning shared by Java's and Python's expressions."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    most: int = 1 << 30


# The three rules whose finds every scan reports.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    # a run that is too short holds no match, so the least length can stand in the pattern
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("bearer", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

MOST_STRINGS = 32  # alternatives of a query
MOST_GRAMS = 3  # trigrams of an alternative that are looked up


def _join(left: list[str], right: list[str]) -> list[str] | None:
    made = sorted({a + b for a, b in product(left, right)})
    return made if len(made) <= MOST_STRINGS else None


def _grams(strings: list[str]) -> list[frozenset[str]]:
    """Alternatives of trigrams that a text holding one of the strings must have."""
    return [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings]


def _both(left: list[frozenset[str]], right: list[frozenset[str]]) -> list[frozenset[str]]:
    """Conjunction of two queries, without alternatives that another one implies."""
    made = {a | b for a, b in product(left, right)}
    least = [a for a in made if not any(b < a for b in made)]
    return sorted(least, key=sorted) if len(least) <= MOST_STRINGS else left


def _walk(items) -> tuple[list[str] | None, list[frozenset[str]]]:
    """Of a parsed expression: all strings it can match (None: too many) and its query."""
    exact: list[str] | None = [""]
    run, query = [""], [frozenset()]
    for op, value in items:
        name = str(op)
        part: list[str] | None = None
        inner: list[frozenset[str]] = [frozenset()]
        if name == "LITERAL":
            part = [chr(value).lower()]
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in value):
            part = sorted({chr(v).lower() for _, v in value})
        elif name == "SUBPATTERN":
            part, inner = _walk(value[3])
        elif name == "BRANCH":
            ways = [_walk(way) for way in value[1]]
            if all(strings is not None for strings, _ in ways):
                part = sorted({s for strings, _ in ways for s in strings})
            else:
                inner = [clause for strings, found in ways for clause in (_grams(strings) if strings is not None else found)]
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, body = value
            strings, found = _walk(body)
            if strings is not None and int(most) <= 8 and int(most) * len(strings) <= MOST_STRINGS:
                part, once = [], [""]
                for n in range(int(most) + 1):
                    part = sorted({*part, *once}) if n >= least else part
                    once = _join(once, strings) or []
            elif least:
                # one occurrence is certain
                inner = found if strings is None else _grams(strings)
        elif name == "AT":
            part = [""]
        grown = None if part is None or len(part) > MOST_STRINGS else _join(run, part)
        if grown is not None:
            run = grown
            exact = None if exact is None else _join(exact, part)
        else:
            query, run, exact = _both(_both(query, _grams(run)), inner if part is None else _grams(part)), [""], None
    return exact, _both(query, _grams(run))


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives of mandatory trigrams in lower case; empty if there are none to rely on."""
    _, clauses = _walk(re._parser.parse(pattern))
    return [] if any(not clause for clause in clauses) else [_few(clause) for clause in clauses]


def _few(clause: frozenset[str]) -> frozenset[str]:
    """Some of the mandatory trigrams: a weaker condition, so nothing is missed."""
    grams = sorted(clause)
    return frozenset(grams[i * len(grams) // MOST_GRAMS] for i in range(min(MOST_GRAMS, len(grams)))) if len(grams) > MOST_GRAMS else clause


def gram_index(docs: DataFrame, grams: list[str]) -> DataFrame:
    """Inverted index of the given trigrams over whole texts: rows (gram, doc_id)."""
    folded = docs.select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("_text"))
    held = F.array_compact(F.array(*(F.when(F.contains("_text", F.lit(g)), F.lit(g)) for g in grams)))
    return folded.select("doc_id", F.explode(held).alias("gram"))


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """Documents that satisfy a rule's query: rows (doc_id, kinds).  The posting lists meet
    by document, where a set holds at most the trigrams of the rules."""
    hits: dict[str, Column] = {}
    for kind, clauses in queries.items():
        for clause in clauses:
            whole = F.size(F.array_intersect("_grams", F.array(*map(F.lit, sorted(clause))))) == len(clause)
            hits[kind] = hits[kind] | whole if kind in hits else whole
    kinds = F.array_compact(F.array(*(F.when(hit, F.lit(kind)) for kind, hit in hits.items())))
    held = index.groupBy("doc_id").agg(F.collect_set("gram").alias("_grams"))
    return held.select("doc_id", kinds.alias("kinds")).filter(F.size("kinds") > 0)


def with_candidates(docs: DataFrame, rules) -> tuple[DataFrame, dict[str, Column]]:
    """``docs`` with a column ``_kinds``, and for each rule whether to search a document."""
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = {kind: clauses for kind, clauses in queries.items() if clauses}
    grams = sorted({gram for clauses in indexed.values() for clause in clauses for gram in clause})
    if not indexed:
        return docs.withColumn("_kinds", F.array().cast("array<string>")), {rule.kind: F.lit(True) for rule in rules}
    found = candidates(gram_index(docs, grams), indexed).select(F.col("doc_id").alias("_id"), F.col("kinds").alias("_kinds"))
    joined = docs.join(found, docs["doc_id"].eqNullSafe(found["_id"]), "left").drop("_id")
    due = {
        rule.kind: F.coalesce(F.array_contains("_kinds", rule.kind), F.lit(False)) if rule.kind in indexed else F.lit(True)
        for rule in rules
    }
    return joined, due


BLOCK = 512


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def running_sums(lengths: Column) -> Column:
    """Sums of all elements before each one.  Goes in blocks, since appending to an array
    copies it."""
    sums = lambda a: F.aggregate(
        a,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")),
        lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["all"], F.array(s["at"])).alias("all")),
        lambda s: s["all"],
    )
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)

    def in_blocks(a: Column) -> Column:
        count = F.greatest(F.ceil(F.size(a) / BLOCK).cast("int") - 1, F.lit(0))
        blocks = F.transform(F.sequence(F.lit(0), count), lambda b: F.slice(a, b * BLOCK + 1, BLOCK))
        return _let(blocks, lambda made: F.zip_with(made, sums(F.transform(made, total)), shifted))

    shifted = lambda block, first: F.transform(sums(block), lambda at: at + first)
    return F.flatten(_let(lengths, in_blocks))


def _cut(text: Column, rule: Rule) -> Column:
    """Of a text: the ``gaps`` between matches, the ``matches``, and the ``good`` ones."""
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    groups = matches if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    good = F.transform(groups, lambda g: F.length(g).between(rule.least, rule.most))
    return F.struct(F.split(text, rule.pattern, -1).alias("gaps"), matches.alias("matches"), good.alias("good"))


def spans_of(text: Column, rule: Rule) -> Column:
    """Leftmost non-overlapping matches that count, in code points, end exclusive."""

    def spans(cut: Column) -> Column:
        # text before a match, match, text before the next match, match ...
        lengths = F.flatten(
            F.zip_with(
                F.slice(cut.gaps, 1, F.size(cut.matches)), cut.matches, lambda b, m: F.array(F.length(b), F.length(m))
            )
        )
        return _let(running_sums(lengths), lambda starts: F.filter(F.transform(cut.good, span(cut, starts)), lambda s: s.kind.isNotNull()))

    def span(cut: Column, starts: Column):
        return lambda good, i: F.struct(
            F.when(good, F.lit(rule.kind)).alias("kind"),
            F.get(starts, 2 * i + 1).alias("start"),
            (F.get(starts, 2 * i + 1) + F.length(F.get(cut.matches, i))).alias("end"),
        )

    return F.when(text.rlike(rule.pattern), _let(_cut(text, rule), spans)).otherwise(F.array().cast(SPAN))


def find_secrets(docs: DataFrame, rules=BASE_RULES + MORE_RULES) -> DataFrame:
    """One row per document: ``doc_id`` and ``spans`` by start, then in the order of rules."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    joined, due = with_candidates(texts, rules)
    kind_no = F.create_map(*(x for n, rule in enumerate(rules) for x in (F.lit(rule.kind), F.lit(n))))
    found = joined.select(
        "doc_id",
        *(F.when(due[rule.kind], spans_of(F.col("text"), rule)).otherwise(F.array().cast(SPAN)).alias(f"_{rule.kind}") for rule in rules),
    ).select("doc_id", F.concat(*(f"_{rule.kind}" for rule in rules)).alias("_spans"))
    keyed = F.transform("_spans", lambda s: F.struct(s.start.alias("start"), F.element_at(kind_no, s.kind).alias("no"), s.kind.alias("kind"), s.end.alias("end")))
    ordered = F.transform(F.sort_array(keyed), lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end")))
    return found.select("doc_id", F.when(F.size("_spans") == 0, F.col("_spans")).otherwise(ordered).alias("spans"))


def digest(found: DataFrame, base=tuple(rule.kind for rule in BASE_RULES)) -> DataFrame:
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    of_base = F.filter("spans", lambda s: s.kind.isin(*base))
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")
    counts = [count(kind).alias(f"n_{kind}") for kind in base]
    return found.select("doc_id", *counts, F.sha2(listed(of_base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


REDACTED = "<redacted>"


def _without(text: Column, rule: Rule) -> Column:
    def joined(cut: Column) -> Column:
        shown = F.zip_with(cut.good, cut.matches, lambda good, m: F.when(good, F.lit(REDACTED)).otherwise(m))
        pairs = F.zip_with(F.slice(cut.gaps, 1, F.size(cut.matches)), shown, lambda b, m: F.concat(b, m))
        return F.concat(F.array_join(pairs, ""), F.element_at(cut.gaps, -1))

    return _let(_cut(text, rule), joined)


def redact(docs: DataFrame, rules=BASE_RULES + MORE_RULES) -> DataFrame:
    """``docs`` with each secret in ``text`` replaced; ``n_chars`` follows where text changed.
    Rules go one after the other, so a secret inside another one is gone with it."""
    joined, due = with_candidates(docs, rules)
    joined = joined.withColumn("_was", F.col("text"))
    for rule in rules:
        hit = due[rule.kind] & F.col("text").rlike(rule.pattern)
        joined = joined.withColumn("text", F.when(hit, _without(F.col("text"), rule)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        changed = F.col("text") != F.col("_was")
        joined = joined.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return joined.select(*docs.columns)
