"""Raw reviews to the silver table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from plaudit.functions import rules as R
from plaudit.operators import clean as C


def to_silver(
    raw: DataFrame,
    rules: Sequence[tuple[str, str]] = R.CATEGORY_RULES,
    bands: Sequence[tuple[float, str]] = R.PRICE_BANDS,
    strict_price: bool = False,
) -> DataFrame:
    """De-duplicate, validate, clean and derive.

    The three row checks are cheap and Catalyst moves them below the
    de-duplication; the costly text work runs once per surviving row above it.
    """
    return cleaned(raw.transform(C.drop_exact_duplicates), rules, bands, strict_price)


def cleaned(
    distinct: DataFrame,
    rules: Sequence[tuple[str, str]] = R.CATEGORY_RULES,
    bands: Sequence[tuple[float, str]] = R.PRICE_BANDS,
    strict_price: bool = False,
) -> DataFrame:
    """The silver rows of raw rows that are distinct already."""
    return (
        distinct.transform(C.valid_rating)
        .transform(C.parse_price, strict=strict_price)
        .transform(C.keep_lettered)
        .transform(C.clean_text)
        .transform(C.tidy_name)
        .transform(C.null_sentinel)
        .transform(C.label_sentiment)
        .transform(C.word_count)
        .transform(C.band, bands=bands)
        .transform(C.categorise, rules=rules)
        .select(*C.SILVER_COLUMNS)
    )
