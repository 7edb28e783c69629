import pytest
from pyspark.sql import functions as F

from plaudit.functions import rules as R
from plaudit.functions import text as T
from plaudit.functions.rounding import percent, ratio
from plaudit.operators import clean as C
from plaudit.plans.silver import to_silver
from plaudit.sources.raw import BRONZE_COLUMNS

from .conftest import plan


def one(spark, expr_of, values, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(expr_of(F.col("v"))).collect()]


def test_rating_keeps_whole_numbers_in_range(spark):
    texts = [" 4 ", "4.0", "4.5", "abc", "", None, "0", "6", "5", "-1"]
    df = spark.createDataFrame([(t,) for t in texts], "rate string")
    assert sorted(r["rating"] for r in C.valid_rating(df).collect()) == [4, 5]


def test_price_reading(spark):
    texts = ["?3,999", "1.2.3", "-5", "Rs. 500", "0", None, "", "499.50"]
    df = spark.createDataFrame([(t,) for t in texts], "price string")
    read = {r["price"]: r["value"] for r in df.select("price", C.price_value().alias("value")).collect()}
    assert read == {"?3,999": 3999.0, "1.2.3": None, "-5": 5.0, "Rs. 500": 0.5, "0": 0.0, None: None, "": None, "499.50": 499.5}
    assert sorted(r["price"] for r in C.parse_price(df).collect()) == [0.5, 5.0, 499.5, 3999.0]
    assert sorted(r["price"] for r in C.parse_price(df, strict=True).collect()) == [499.5, 3999.0]
    assert {r["price"]: r["read_as"] for r in C.unclear_prices(df).collect()} == {"-5": 5.0, "Rs. 500": 0.5}


TEXTS = [
    None, "", "a", "!!", "Don't BUY", "café crème", "tab\tand\nline\x0bfeed", "  x  ", "A.b",
    "İ", "K", "K9İ", "éè", "5 stars", "İstanbul", "1a", "ÅÅ",
]


def test_plain_words(spark):
    got = dict(zip(TEXTS, one(spark, T.plain_words, TEXTS)))
    assert got["Don't BUY"] == "don t buy"
    assert got["café crème"] == "caf cr me"
    assert got["tab\tand\nline\x0bfeed"] == "tab and line feed"
    assert got[None] == got[""] == got["!!"] == ""
    assert got["İstanbul"] == "i stanbul"


def test_one_pass_cleaning_equals_two_passes(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "v string")
    spaced = F.regexp_replace(F.lower(F.coalesce("v", F.lit(""))), r"[^a-z\s]", " ")
    two = F.trim(F.regexp_replace(spaced, r"[\s\x0b]+", " "))
    assert df.filter(~two.eqNullSafe(T.plain_words(F.col("v")))).count() == 0


def test_two_letter_check_equals_length_of_clean_text(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "v string")
    checked = df.select("v", T.has_two_letters(F.col("v")).alias("fast"), (F.length(T.plain_words(F.col("v"))) >= 2).alias("slow"))
    assert checked.filter("fast <> slow").collect() == []


def test_tidy_name(spark):
    names = ["a??b", "a?b", "??� x  y ", "q r", "q  r", None, " ?? ?? z"]
    assert one(spark, T.tidy, names) == ["a b", "a?b", "x y", "q r", "q r", None, "z"]


def test_bands_are_half_open(spark):
    prices = [499.99, 500.0, 999.99, 1000.0, 2999.99, 3000.0, 9999.99, 10000.0]
    assert [b[0] for b in one(spark, R.band_of, prices, "double")] == ["1", "2", "2", "3", "3", "4", "4", "5"]


def test_sentiment(spark):
    assert one(spark, R.sentiment_of, [1, 2, 3, 4, 5], "int") == ["negative", "negative", "neutral", "positive", "positive"]


@pytest.mark.parametrize(
    "name, category",
    [
        ("Curtain lamp", "Home Decor & Furnishing"),  # the narrow early rule
        ("Table LAMP", "Home Decor & Furnishing"),  # the broad late rule
        ("Cotton curtain for gym", "Home Decor & Furnishing"),  # first of several
        ("Smart watch", "Electronics & Accessories"),
        ("Dish wash bar", "Appliances"),
        ("Xylophone stabiliser", "Appliances"),
        ("unknown thing", "Other"),
        (None, "Other"),
    ],
)
def test_first_matching_category_wins(spark, name, category):
    df = spark.createDataFrame([(name,)], "product_name string")
    assert C.categorise(df).first()["category"] == category


def test_null_sentinel(spark):
    df = spark.createDataFrame([("Nan",), ("nan",), (None,)], "review_title string")
    assert [r[0] for r in C.null_sentinel(df).collect()] == [None, "nan", None]


def test_ratio_rounds_half_up_exactly(spark):
    cases = [(201, 200, 2, 1.01), (535, 200, 2, 2.68), (1, 8, 2, 0.13), (0, 7, 3, 0.0), (1, 0, 2, None)]
    for num, den, digits, want in cases:
        df = spark.createDataFrame([(num, den)], "a long, b long")
        assert df.select(ratio(F.col("a"), F.col("b"), digits)).first()[0] == want
    empty = spark.createDataFrame([(0, 0)], "a long, b long")
    assert empty.select(percent(F.col("a"), F.col("b"), empty=0)).first()[0] == 0.0


def test_filters(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2)], "category string, n int")
    assert C.apply_filters(df, category=None).count() == 2
    assert C.apply_filters(df, category="x").count() == 1
    assert C.apply_filters(df, category=["x", "y"]).count() == 2
    assert C.apply_filters(df, category=[]).count() == 0


RAW = [
    ("Steel bottle", "?1,200", "5", "Nan", "Great BOTTLE!"),
    ("Steel bottle", "?1,200", "5", "Nan", "Great BOTTLE!"),
    ("Steel bottle", "?1,200", "9", "x", "Great BOTTLE!"),
    ("Steel bottle", "free", "5", "x", "Great BOTTLE!"),
    ("Steel bottle", "?1,200", "3", None, "!"),
    (None, "?10", "1", None, "so bad"),
]


def test_silver_row(spark):
    raw = spark.createDataFrame(RAW, ", ".join(f"{c} string" for c in BRONZE_COLUMNS))
    got = {r["product_name"]: r.asDict() for r in to_silver(raw).collect()}
    assert set(got) == {"Steel bottle", None}
    assert got["Steel bottle"] == {
        "product_name": "Steel bottle", "category": "Kitchen & Dining", "price": 1200.0, "price_band": "3. 1,000-2,999",
        "rating": 5, "sentiment": "positive", "review_title": None, "review_text": "great bottle", "word_count": 2,
    }
    assert got[None]["category"] == "Other"


def test_silver_plan_checks_rows_before_the_shuffle_and_lowers_names_once(spark):
    raw = spark.createDataFrame(RAW, ", ".join(f"{c} string" for c in BRONZE_COLUMNS))
    text = plan(to_silver(raw))
    below = text.split("Exchange", 1)[1]
    assert "RLIKE(summary" in below and "try_cast(rate" in below
    assert text.count("lower(product_name") == 1
    assert text.count("[^a-z]+") == 1
    assert "Python" not in text


def test_silver_does_not_depend_on_layout(spark, rows):
    raw = spark.createDataFrame(RAW, ", ".join(f"{c} string" for c in BRONZE_COLUMNS))
    assert rows(to_silver(raw.repartition(1))) == rows(to_silver(raw.repartition(7)))
