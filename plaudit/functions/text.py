"""Text expressions shared by cleaning, counting and scoring."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# One letter as lower() sees it: U+0130 and U+212A are the only other characters
# whose lower case contains an ASCII letter.
_LETTER = "[a-zA-Z\u0130\u212a]"
_NO_LETTER = "[^a-zA-Z\u0130\u212a]"


def plain_words(text: Column) -> Column:
    """Lower-case a-z words separated by single spaces; NULL becomes ''.

    Every run of other characters ends up as one space, so one pass is enough.
    """
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z]+", " "))


def has_two_letters(text: Column) -> Column:
    """True exactly when ``plain_words(text)`` has two characters or more.

    The match ends at the second letter, so filtering long texts stays cheap and
    the full normalisation runs once, after de-duplication.
    """
    return F.coalesce(text.rlike(f"{_LETTER}{_NO_LETTER}*{_LETTER}"), F.lit(False))


def tidy(name: Column) -> Column:
    """Replace broken-encoding runs and repeated white space by one space."""
    return F.trim(F.regexp_replace(name, "(?:[?\ufffd\u00a0]{2,}|\\s)+", " "))


def letter_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0))
