r"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, scheme marks,
identifier cues, and digits that begin a run.  From each anchor a deterministic parser
reads to the left and right for as long as characters fit, then validates what it read.
Parsers go on from where the last span of their kind ended, so the work stays in
proportion to the text, also for long runs of digits or of letters.

Kinds, in order (the first four are the base, with the same spans as leftmost
non-overlapping matches of their patterns):

- ``email`` ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+``
- ``ip`` four dotted numbers of at most 255
- ``card`` 14 to 19 digits, single blanks or hyphens between them, with a valid Luhn sum
- ``phone`` ``\+[0-9][\x20().0-9-]+[0-9]`` with 10 to 15 digits
- ``url`` a scheme, ``://`` and the characters up to a blank, quote or bracket
- ``account`` the number after an identifier cue (IBAN, account, SSN, passport, tax id):
  6 to 34 letters and digits with at least 5 digits, single blanks or hyphens inside

Defined cases: null is an empty text; a text without anchors has no spans; null and
repeated ``doc_id`` are kept, one output row for each input row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plaudit.llm.chunks import text_chunks, texts_of

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account")

# Character sets of the parsers, and what announces an address or an account.
DIGITS = frozenset("0123456789")
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
HOST = DIGITS | LETTERS | {"-"}
LOCAL = HOST | set("._%+")
PHONE = DIGITS | set(" ().-")
URL_ENDS = frozenset("\"'<>()[]{}|\\^`")
SCHEMES = ("http://", "https://", "ftp://", "ftps://", "ssh://", "sftp://")
CUES = ("iban", "account", "acct", "ssn", "social security", "passport", "tax id", "routing")
LUHN = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def automaton() -> ahocorasick.Automaton:
    """All anchors; cues in lower case, with a capital, and in capitals."""
    found = ahocorasick.Automaton()
    for sign, kind in (("@", "at"), ("+", "plus")):
        found.add_word(sign, (kind, 1))
    for digit in DIGITS:
        found.add_word(digit, ("digit", 1))
    for scheme in SCHEMES:
        for form in (scheme, scheme.upper()):
            found.add_word(form, ("scheme", len(form)))
    for cue in CUES:
        for form in {cue, cue.capitalize(), cue.title(), cue.upper()}:
            found.add_word(form, ("cue", len(form)))
    found.make_automaton()
    return found


def run_end(text: str, at: int, allowed: frozenset[str]) -> int:
    """End of the run of allowed characters from ``at``."""
    size = len(text)
    while at < size and text[at] in allowed:
        at += 1
    return at


def email_at(text: str, at: int, least: int) -> tuple[int, int] | None:
    """Address around the at-sign, not reaching left of ``least``."""
    start = at
    while start > least and text[start - 1] in LOCAL:
        start -= 1
    if start == at:
        return None
    end = run_end(text, at + 1, HOST)
    if end == at + 1:
        return None
    dots = 0
    while end < len(text) and text[end] == ".":
        label = run_end(text, end + 1, HOST)
        if label == end + 1:
            break
        end, dots = label, dots + 1
    return (start, end) if dots else None


def ip_spans(text: str, runs: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Four runs of digits joined by single dots; matches that fail use up their runs too."""
    i = 0
    while i + 3 < len(runs):
        four = runs[i : i + 4]
        if all(a[1] + 1 == b[0] and text[a[1]] == "." for a, b in zip(four, four[1:])):
            parts = [text[a:b].lstrip("0") for a, b in four]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                yield four[0][0], four[3][1]
            i += 4
        else:
            i += 1


def luhn(digits: str) -> bool:
    total = 0
    for n, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        total += LUHN[value] if n % 2 else value
    return total % 10 == 0


def card_spans(text: str, runs: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Runs of digits with one blank or hyphen between them, taken as far as they go."""
    i = 0
    while i < len(runs):
        j = i
        while j + 1 < len(runs) and runs[j][1] + 1 == runs[j + 1][0] and text[runs[j][1]] in " -":
            j += 1
        group = runs[i : j + 1]
        if 14 <= sum(b - a for a, b in group) <= 19 and luhn("".join(text[a:b] for a, b in group)):
            yield group[0][0], group[-1][1]
        i = j + 1


def phone_at(text: str, at: int) -> tuple[int, int, bool] | None:
    """Match that begins at the plus sign, and whether its number of digits is right."""
    if at + 1 >= len(text) or text[at + 1] not in DIGITS:
        return None
    end = run_end(text, at + 2, PHONE)
    while end > at + 2 and text[end - 1] not in DIGITS:
        end -= 1
    if end < at + 4:
        return None
    return at, end, 10 <= sum(c in DIGITS for c in text[at:end]) <= 15


def url_at(text: str, scheme: int, start: int) -> tuple[int, int] | None:
    end = start
    while end < len(text) and not text[end].isspace() and text[end] not in URL_ENDS:
        end += 1
    while end > start and text[end - 1] in ".,;:!?*#&%$":
        end -= 1
    return (scheme, end) if end > start and text[start] in HOST else None


def account_after(text: str, cue: int, at: int) -> tuple[int, int] | None:
    """Number after a cue that stands as a word of its own."""
    if cue and text[cue - 1].isalnum():
        return None
    for word in (" number", " no", " nr", " id"):
        if text[at : at + len(word)].lower() == word:
            at += len(word)
            break
    start = at
    while start < len(text) and start < at + 4 and text[start] in " .:#=-":
        start += 1
    if start == at:
        return None
    end, size, digits = start, 0, 0
    while end < len(text):
        here = text[end]
        if here in DIGITS or "A" <= here <= "Z":
            size, digits = size + 1, digits + (here in DIGITS)
        elif not (here in " -" and end + 1 < len(text) and (text[end + 1] in DIGITS or "A" <= text[end + 1] <= "Z")):
            break
        end += 1
        if size > 34:
            return None
    if end < len(text) and text[end].isalnum():
        return None
    return (start, end) if size >= 6 and digits >= 5 else None


def find(text: str, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) by start, then kind."""
    spans: list[tuple[int, int, int]] = []
    runs: list[tuple[int, int]] = []
    after = dict.fromkeys(KINDS, 0)

    def add(kind: str, start: int, end: int) -> None:
        spans.append((start, KINDS.index(kind), end))
        after[kind] = end

    digits_to = 0
    for last, (kind, size) in anchors.iter(text):
        at = last - size + 1
        if kind == "digit":
            if at >= digits_to:
                digits_to = run_end(text, at, DIGITS)
                runs.append((at, digits_to))
        elif kind == "at":
            if found := email_at(text, at, after["email"]):
                add("email", *found)
        elif kind == "plus":
            if at >= after["phone"] and (found := phone_at(text, at)):
                start, end, good = found
                after["phone"] = end
                if good:
                    add("phone", start, end)
        elif kind == "scheme":
            if at >= after["url"] and (found := url_at(text, at, last + 1)):
                add("url", *found)
        elif at >= after["account"] and (found := account_after(text, at, last + 1)):
            add("account", *found)
    for start, end in ip_spans(text, runs):
        add("ip", start, end)
    for start, end in card_spans(text, runs):
        add("card", start, end)
    return [(KINDS[n], start, end) for start, n, end in sorted(spans)]


def find_pii(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end) of each whole text."""

    def run(batches):
        anchors = automaton()
        for batch in batches:
            for chunk in text_chunks(batch):
                spans = [[{"kind": k, "start": s, "end": e} for k, s, e in find(text, anchors)] for text in texts_of(chunk)]
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, spans array<struct<kind:string,start:long,end:long>>")


def digest(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")
    return find_pii(docs).select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in BASE),
        F.sha2(listed(F.filter("spans", lambda s: s.kind.isin(*BASE))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
