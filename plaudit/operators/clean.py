"""Cleaning steps, each usable alone with ``df.transform``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from plaudit.functions import rules as R
from plaudit.functions import text as T

SILVER_COLUMNS = (
    "product_name",
    "category",
    "price",
    "price_band",
    "rating",
    "sentiment",
    "review_title",
    "review_text",
    "word_count",
)

# a price whose digits can only be read one way: no sign, no dot before the digits
_CLEAR_PRICE = r"^[^0-9.\-]*[0-9][0-9,]*(\.[0-9]+)?[^0-9.\-]*$"


def rating_value():
    return F.col("rate").try_cast("int")


# what the price column of the star schema can hold; larger numbers come from joined digits
LARGEST_PRICE = 1e10


def price_value():
    return F.regexp_replace("price", "[^0-9.]", "").try_cast("double")


def price_fits(value):
    return (value > 0) & (value < LARGEST_PRICE)


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row distinct, NULLs equal.  Copies collapse before the shuffle."""
    return df.dropDuplicates()


def valid_rating(df: DataFrame, lo: int = 1, hi: int = 5) -> DataFrame:
    return df.withColumn("rating", rating_value()).filter(F.col("rating").between(lo, hi))


def parse_price(df: DataFrame, strict: bool = False) -> DataFrame:
    """Price text to a positive number.

    The sign is dropped and stray dots are kept ("Rs. 500" reads as 0.5).
    Numbers that no price column can hold are no prices; the quality report counts them
    with the step.  ``strict`` keeps only prices that can be read one way; see ``unclear_prices``.
    """
    source = df.filter(F.col("price").rlike(_CLEAR_PRICE)) if strict else df
    return source.withColumn("price", price_value()).filter(price_fits(F.col("price")))


def unclear_prices(df: DataFrame) -> DataFrame:
    """Rows whose price yields a number only by the lenient reading."""
    lenient = price_value()
    return df.filter((lenient > 0) & ~F.col("price").rlike(_CLEAR_PRICE)).withColumn("read_as", lenient)


def clean_text(df: DataFrame, src: str = "summary", dst: str = "review_text") -> DataFrame:
    return df.withColumn(dst, T.plain_words(F.col(src)))


def keep_texts(df: DataFrame, column: str = "review_text", shortest: int = 2) -> DataFrame:
    return df.filter(F.length(column) >= shortest)


def keep_lettered(df: DataFrame, src: str = "summary") -> DataFrame:
    """Same rows as ``clean_text`` then ``keep_texts``, decided at the second letter."""
    return df.filter(T.has_two_letters(F.col(src)))


def tidy_name(df: DataFrame, column: str = "product_name") -> DataFrame:
    return df.withColumn(column, T.tidy(F.col(column)))


def null_sentinel(df: DataFrame, column: str = "review_title", value: str = R.MISSING_TITLE) -> DataFrame:
    return df.withColumn(column, F.nullif(F.col(column), F.lit(value)))


def word_count(df: DataFrame, src: str = "review_text", dst: str = "word_count") -> DataFrame:
    return df.withColumn(dst, F.size(F.split(F.col(src), " ")))


def label_sentiment(df: DataFrame, rating: str = "rating") -> DataFrame:
    return df.withColumn("sentiment", R.sentiment_of(F.col(rating)))


def band(df: DataFrame, column: str = "price", bands=R.PRICE_BANDS, top: str = R.TOP_PRICE_BAND) -> DataFrame:
    return df.withColumn("price_band", R.band_of(F.col(column), bands, top))


def categorise(
    df: DataFrame,
    rules: Sequence[tuple[str, str]] = R.CATEGORY_RULES,
    default: str = R.OTHER_CATEGORY,
    name: str = "product_name",
) -> DataFrame:
    """First matching rule on the lower-cased name, which is computed once per row."""
    lowered = df.withColumn("_lowered", F.lower(F.col(name)))
    return lowered.withColumn("category", R.category_of(F.col("_lowered"), rules, default)).drop("_lowered")


def label(df: DataFrame, classes: Sequence[str] = R.SENTIMENTS) -> DataFrame:
    """Numeric class label; rows of other classes are left out."""
    return df.withColumn("label", R.class_label(F.col("sentiment"), classes)).filter(F.col("label").isNotNull())


def keep_nonempty(df: DataFrame, column: str = "review_text") -> DataFrame:
    return df.filter(F.length(column) > 0)


def apply_filters(df: DataFrame, **wanted) -> DataFrame:
    """Optional predicates: a value means equality, a list membership, None nothing."""
    for column, value in wanted.items():
        if value is None:
            continue
        if isinstance(value, (list, tuple, set, frozenset)):
            df = df.filter(F.col(column).isin(*value)) if value else df.filter(F.lit(False))
        else:
            df = df.filter(F.col(column) == value)
    return df
