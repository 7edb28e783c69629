"""The same answers in DuckDB SQL, written from the table definitions.

Each statement starts from the generated tables and shares nothing with the Spark
plans but fixed values: rule patterns, labels, step names and the stop list.
"""

from __future__ import annotations

import re

from plaudit.functions.rules import CATEGORY_RULES, OTHER_CATEGORY, PRICE_BANDS, TOP_PRICE_BAND
from plaudit.operators.quality import FUNNEL_STEPS
from plaudit.plans.registry import (
    BAND,
    CATEGORY,
    FIRST_BATCH_ENDS,
    INTERCEPTS,
    PRODUCT_REVIEWS,
    WORD_USES,
    WORST_REVIEWS,
)
from plaudit.sources.testdata import TEST_RULES


# The 181 English words that Spark's StopWordsRemover takes out by default.
STOP_WORDS = """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
    herself it its itself they them their theirs themselves what which who whom this that these those am is are
    was were be been being have has had having do does did doing a an the and but if or because as until while of
    at by for with about against between into through during before after above below to from up down in out on
    off over under again further then once here there when where why how all any both each few more most other
    some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll she'll
    we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
    they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
    mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
    would
""".split()


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def ratio(num: str, den: str, digits: int) -> str:
    """Half-up rounding in integers; NULL when the denominator is 0."""
    scale = 10**digits
    num, den = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return f"CAST(({2 * scale} * {num} + {den}) // (2 * {den}) AS DOUBLE) / {scale}"


def pct(num: str, den: str, digits: int = 1) -> str:
    return ratio(f"100 * ({num})", den, digits)


def settle(value: str, digits: int) -> str:
    return f"floor(({value}) * 1e{digits} + 0.5) / 1e{digits}"


def band(price: str) -> str:
    cases = " ".join(f"WHEN {price} < {bound} THEN {lit(label)}" for bound, label in PRICE_BANDS)
    return f"CASE {cases} ELSE {lit(TOP_PRICE_BAND)} END"


def sentiment(rating: str) -> str:
    return f"CASE WHEN {rating} >= 4 THEN 'positive' WHEN {rating} = 3 THEN 'neutral' ELSE 'negative' END"


def category(name: str, rules) -> str:
    cases = " ".join(f"WHEN regexp_matches({name}, {lit(pattern)}) THEN {lit(label)}" for pattern, label in rules)
    return f"CASE {cases} ELSE {lit(OTHER_CATEGORY)} END"


def clean(text: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower(coalesce({text}, '')), '[^a-z\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


def tidy(name: str) -> str:
    broken = "'[?\\x{FFFD}\\x{00A0}]{2,}'"
    return f"trim(regexp_replace(regexp_replace({name}, {broken}, ' ', 'g'), '\\s+', ' ', 'g'))"


def cents(total: str) -> str:
    return f"CAST({total} * 100 AS HUGEINT)"


RATING = "CASE WHEN regexp_matches(trim(rate), '^[+-]?[0-9]+$') THEN TRY_CAST(trim(rate) AS INTEGER) END"
PRICE = "TRY_CAST(regexp_replace(price, '[^0-9.]', '', 'g') AS DOUBLE)"
MONEY = "CAST(price AS DECIMAL(18, 2))"
STOP = ", ".join(lit(w) for w in STOP_WORDS)
FIRST = f"received_at < TIMESTAMP '{FIRST_BATCH_ENDS} 00:00:00'"


def merged(tag: str, column: str, old: str = "first_lines", new: str = "lines") -> dict[str, str]:
    """Ids by name order over ``old``; unseen names of ``new`` continue the count."""
    return {
        f"{tag}_old": f"SELECT row_number() OVER (ORDER BY n) AS id, n FROM (SELECT DISTINCT {column} AS n FROM {old})",
        f"{tag}_new": f"SELECT (SELECT coalesce(max(id), 0) FROM {tag}_old) + row_number() OVER (ORDER BY n) AS id, n "
        f"FROM (SELECT DISTINCT {column} AS n FROM {new}) WHERE n NOT IN (SELECT n FROM {tag}_old)",
        f"{tag}_ids": f"SELECT id, n FROM {tag}_old UNION ALL SELECT id, n FROM {tag}_new",
    }


def totals(source: str, least: int) -> str:
    return (
        "SELECT product_name, category, count(*) AS reviews, sum(rating) AS stars, "
        "count(*) FILTER (sentiment = 'positive') AS pos, count(*) FILTER (sentiment = 'negative') AS neg, "
        f"sum({MONEY}) AS money FROM {source} GROUP BY ALL HAVING count(*) >= {least}"
    )


def led(source: str) -> str:
    return (
        "SELECT product_name, category FROM "
        f"(SELECT *, row_number() OVER (PARTITION BY product_name ORDER BY reviews DESC, category) AS r FROM {source}) WHERE r = 1"
    )


CTES: dict[str, str] = {
    "numbered": """SELECT d.doc_id, p.p_name || ' ' || p.p_brand AS product_name,
        CASE WHEN d.doc_id % 101 = 0 THEN 'N/A' ELSE '?' || CAST(CAST(p.p_retailprice *
          CAST(CASE WHEN d.doc_id % 12 = 0 THEN 0.5 ELSE d.doc_id % 12 END AS DOUBLE) AS DECIMAL(12, 2)) AS VARCHAR) END AS price,
        CASE WHEN d.doc_id % 97 = 0 THEN 'broken' WHEN l.toxic = 1 THEN '1'
          WHEN l.quality = 0 THEN CAST(2 + d.doc_id % 2 AS VARCHAR) WHEN l.quality = 1 THEN CAST(4 + d.doc_id % 2 AS VARCHAR)
          ELSE CAST(1 + d.doc_id % 5 AS VARCHAR) END AS rate,
        CASE WHEN d.doc_id % 11 = 0 THEN 'Nan' ELSE d.source END AS review_title,
        CASE WHEN d.doc_id % 89 = 0 THEN '!!' ELSE d.text END AS summary
        FROM documents d JOIN part p ON p.p_partkey = d.doc_id % (SELECT count(*) FROM part) LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "delivered": "SELECT *, unnest(range(CASE WHEN doc_id % 8 = 0 THEN 2 ELSE 1 END)) AS delivery FROM numbered",
    "raw": "SELECT product_name, price, rate, review_title, summary FROM delivered",
    "unique_raw": "SELECT DISTINCT * FROM raw",
    "checked": f"SELECT *, {RATING} AS rating, {PRICE} AS value, {clean('summary')} AS review_text FROM unique_raw",
    "silver": f"""SELECT {tidy('product_name')} AS product_name, {category(f"lower({tidy('product_name')})", TEST_RULES)} AS category,
        value AS price, {band('value')} AS price_band, rating, {sentiment('rating')} AS sentiment,
        nullif(review_title, 'Nan') AS review_title, review_text,
        CAST(len(string_split(review_text, ' ')) AS INTEGER) AS word_count
        FROM checked WHERE rating BETWEEN 1 AND 5 AND value > 0 AND value < 1e10 AND length(review_text) >= 2""",
    "lines": f"""SELECT p.p_name || ' ' || p.p_brand AS product_name, p.p_type AS category, l.l_extendedprice AS price,
        {band('l.l_extendedprice')} AS price_band, CAST(1 + CAST(l.l_quantity AS INTEGER) % 5 AS INTEGER) AS rating,
        {sentiment('1 + CAST(l.l_quantity AS INTEGER) % 5')} AS sentiment,
        CAST(length(p.p_name) * l.l_linenumber AS INTEGER) AS word_count, l.l_shipdate AS received_at
        FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey""",
    "first_lines": f"SELECT * FROM lines WHERE {FIRST}",
    "cells": f"""SELECT category, price_band, rating, sentiment, count(*) AS reviews, sum({MONEY}) AS sum_price,
        sum(word_count) AS sum_words FROM lines GROUP BY ALL""",
    "words": "SELECT sentiment, unnest(string_split(review_text, ' ')) AS word FROM silver",
    "kept": f"SELECT sentiment, word FROM words WHERE word NOT IN ({STOP})",
    "tokens": "SELECT sentiment, word FROM kept WHERE length(word) > 2",
    "counts": "SELECT sentiment, word, count(*) AS count FROM tokens GROUP BY ALL",
    "wide": """SELECT word, count(*) FILTER (sentiment = 'negative') AS negative, count(*) FILTER (sentiment = 'neutral') AS neutral,
        count(*) FILTER (sentiment = 'positive') AS positive FROM tokens GROUP BY word""",
    "signals": f"""SELECT word, negative, neutral, positive, negative + neutral + positive AS total,
        {ratio('negative', 'negative + neutral + positive', 3)} AS neg_share,
        {ratio('positive', 'negative + neutral + positive', 3)} AS pos_share FROM wide""",
    "ranked_words": "SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY count DESC, word) AS place FROM counts",
    "text_rows": "SELECT row_number() OVER () AS id, review_text FROM silver",
    "text_words": f"SELECT id, word FROM (SELECT id, unnest(string_split(review_text, ' ')) AS word FROM text_rows) WHERE word NOT IN ({STOP})",
    "frequencies": "SELECT word, count(*) AS count, count(DISTINCT id) AS df FROM text_words GROUP BY word",
    "vocabulary": "SELECT * FROM frequencies WHERE df >= 3",
    "pairs": f"SELECT sentiment AS actual, {sentiment('1 + (rating * 7 + word_count) % 5')} AS predicted FROM silver",
    "confusion": "SELECT actual, predicted, count(*) AS reviews FROM pairs GROUP BY ALL",
    "category_keys": "SELECT CAST(row_number() OVER (ORDER BY category) AS INTEGER) AS category_key, category AS category_name FROM (SELECT DISTINCT category FROM lines)",
    "band_keys": "SELECT CAST(row_number() OVER (ORDER BY price_band) AS INTEGER) AS price_band_key, price_band FROM (SELECT DISTINCT price_band FROM lines)",
    "sentiment_keys": "SELECT * FROM (VALUES (1, 'negative'), (2, 'neutral'), (3, 'positive')) AS v(sentiment_key, sentiment)",
    "product_keys": """SELECT CAST(row_number() OVER (ORDER BY product_name, category) AS INTEGER) AS product_key, product_name, category
        FROM (SELECT DISTINCT product_name, category FROM lines)""",
    "text_products": """SELECT CAST(row_number() OVER (ORDER BY product_name, category) AS INTEGER) AS product_key, product_name, category
        FROM (SELECT DISTINCT product_name, category FROM silver)""",
    "text_bands": "SELECT CAST(row_number() OVER (ORDER BY price_band) AS INTEGER) AS price_band_key, price_band FROM (SELECT DISTINCT price_band FROM silver)",
    "text_fact": """SELECT product_key, price_band_key, sentiment_key, CAST(rating AS SMALLINT) AS rating,
        CAST(price AS DECIMAL(12, 2)) AS price, word_count, review_text
        FROM silver JOIN text_products USING (product_name, category) JOIN text_bands USING (price_band) JOIN sentiment_keys USING (sentiment)""",
    "totals": totals("lines", PRODUCT_REVIEWS),
    "all_totals": totals("lines", 1),
    "first_totals": totals("first_lines", 1),
    "led": led("totals"),
    "all_led": led("all_totals"),
    "first_led": led("first_totals"),
    **merged("cat", "category"),
    **merged("band", "price_band"),
    **merged("sent", "sentiment"),
    **merged("name", "product_name"),
    **merged("product", "product_name", "first_led", "led"),
    "whole": "SELECT product_name, sum(reviews) AS reviews, sum(stars) AS stars, sum(pos) AS pos, sum(neg) AS neg, sum(money) AS money FROM totals GROUP BY product_name",
    "summaries": f"""SELECT i.id AS product_id, w.product_name, CAST(reviews AS BIGINT) AS review_count,
        {ratio('stars', 'reviews', 2)} AS average_rating, {pct('pos', 'reviews')} AS positive_percent,
        {pct('neg', 'reviews')} AS negative_percent, {ratio(cents('money'), '100 * reviews', 0)} AS average_price
        FROM whole w JOIN product_ids i ON i.n = w.product_name""",
    "documents_words": f"""SELECT doc_id, word FROM (SELECT doc_id, unnest(string_split({clean('text')}, ' ')) AS word FROM documents)
        WHERE word NOT IN ({STOP})""",
    "first_rows": "SELECT product_name, price, rate, review_title, summary FROM delivered WHERE doc_id % 10 < 7",
    "second_rows": "SELECT product_name, price, rate, review_title, summary FROM delivered WHERE doc_id % 10 >= 5",
    "later_rows": "SELECT * FROM second_rows EXCEPT SELECT * FROM first_rows",
    "good_rows": """SELECT product_name, price, rate, review_title, summary FROM checked
        WHERE rating BETWEEN 1 AND 5 AND value > 0 AND value < 1e10 AND length(review_text) >= 2""",
    "first_products": f"""SELECT DISTINCT {tidy('product_name')} AS product_name, {category(f"lower({tidy('product_name')})", TEST_RULES)} AS category
        FROM (SELECT * FROM good_rows INTERSECT SELECT * FROM first_rows)""",
    "later_products": "SELECT product_name, category FROM silver EXCEPT SELECT product_name, category FROM first_products",
    "document_vocabulary": """SELECT word, count(*) AS count, count(DISTINCT doc_id) AS df FROM documents_words
        GROUP BY word HAVING count(DISTINCT doc_id) >= 3""",
    "weights": f"""SELECT s.word, {settle('ln(((SELECT count(*) FROM silver) + 1) / (f.df + 1))', 6)} AS idf, s.neg_share AS w_negative,
        {settle('s.neutral / s.total', 3)} AS w_neutral, s.pos_share AS w_positive
        FROM signals s JOIN frequencies f USING (word) WHERE s.total >= {WORD_USES}""",
    "products": f"""SELECT product_name, category, reviews, {ratio('stars', 'reviews', 2)} AS avg_rating, {pct('pos', 'reviews')} AS pct_positive,
        {pct('neg', 'reviews')} AS pct_negative, {ratio(cents('money'), '100 * reviews', 0)} AS avg_price FROM totals""",
}


def _scored(source: str, longest: int | None = None) -> str:
    """Scores of ``source(id, txt)`` with status and probabilities."""
    fits = "length(txt) >= 1" if longest is None else f"length(txt) BETWEEN 1 AND {longest}"
    sums = ", ".join(f"round(coalesce(sum(w.idf * w.w_{c}), 0) + {b}, 9) AS s_{c}" for c, b in INTERCEPTS.items())
    exps = ", ".join(f"exp(s_{c} - greatest(s_negative, s_neutral, s_positive)) AS e_{c}" for c in INTERCEPTS)
    shares = ", ".join(
        f"CASE WHEN status = 'ok' THEN {settle(f'e_{c} / (e_negative + e_neutral + e_positive)', 6)} END AS p_{c}" for c in INTERCEPTS
    )
    return f"""SELECT id, status, CASE WHEN status <> 'ok' THEN NULL
          WHEN s_negative >= s_neutral AND s_negative >= s_positive THEN 'negative' WHEN s_neutral >= s_positive THEN 'neutral' ELSE 'positive' END AS prediction, {shares}
        FROM (SELECT *, {exps} FROM (
          SELECT t.id, CASE WHEN NOT t.valid THEN 'invalid' WHEN count(w.word) = 0 THEN 'unknown' ELSE 'ok' END AS status, {sums}
          FROM (SELECT id, coalesce({fits}, FALSE) AS valid FROM ({source})) t
          LEFT JOIN (SELECT id, unnest(regexp_extract_all(lower(txt), '[a-z]+')) AS token FROM ({source}) WHERE {fits}) k ON k.id = t.id
          LEFT JOIN weights w ON w.word = k.token GROUP BY t.id, t.valid))"""


def _metrics(name: str, pairs: str, classes: tuple[str, ...]) -> str:
    f1 = " + ".join(
        f"coalesce(2.0 * count(*) FILTER (actual = '{c}' AND predicted = '{c}') / nullif(count(*) FILTER (actual = '{c}') + "
        f"count(*) FILTER (predicted = '{c}'), 0) * count(*) FILTER (actual = '{c}'), 0)"
        for c in classes
    )
    source = f"FROM ({pairs})"
    return (
        f"SELECT '{name}' AS model, 'accuracy' AS metric, {ratio('count(*) FILTER (actual = predicted)', 'count(*)', 4)} AS value {source} "
        f"UNION ALL SELECT '{name}', 'f1_weighted', {settle(f'CAST({f1} AS DOUBLE) / count(*)', 4)} {source}"
    )


THREE = ("negative", "neutral", "positive")
ALL_METRICS = (
    _metrics("3-class", "SELECT * FROM pairs", THREE)
    + " UNION ALL "
    + _metrics("2-class", "SELECT * FROM pairs WHERE actual <> 'neutral' AND predicted <> 'neutral'", ("negative", "positive"))
)


def _summary(where: str = "TRUE") -> str:
    n = "coalesce(sum(reviews), 0)"
    return f"""SELECT CAST({n} AS BIGINT) AS reviews, coalesce({ratio('sum(rating * reviews)', 'sum(reviews)', 4)}, 0.0) AS average_rating,
        coalesce({ratio(cents('sum(sum_price)'), '100 * sum(reviews)', 2)}, 0.0) AS average_price FROM cells WHERE {where}"""


def _kpis(where: str = "TRUE") -> str:
    def share(s: str) -> str:
        return f"coalesce({pct(f'''coalesce(sum(reviews) FILTER (sentiment = '{s}'), 0)''', 'sum(reviews)')}, 0.0)"

    return f"""SELECT CAST(coalesce(sum(reviews), 0) AS BIGINT) AS reviews, coalesce({ratio('sum(rating * reviews)', 'sum(reviews)', 2)}, 0.0) AS avg_rating,
        {share('positive')} AS pct_positive, {share('negative')} AS pct_negative,
        coalesce({ratio(cents('sum(sum_price)'), '100 * sum(reviews)', 0)}, 0.0) AS avg_price FROM cells WHERE {where}"""


def _funnel() -> str:
    counts = [
        "SELECT count(*) FROM raw",
        "SELECT count(*) FROM checked",
        "SELECT count(*) FROM checked WHERE rating BETWEEN 1 AND 5",
        "SELECT count(*) FROM checked WHERE rating BETWEEN 1 AND 5 AND value > 0 AND value < 1e10",
        "SELECT count(*) FROM checked WHERE rating BETWEEN 1 AND 5 AND value > 0 AND value < 1e10 AND length(review_text) >= 2",
    ]
    rows = " UNION ALL ".join(f"SELECT {lit(step)} AS step, ({c}) AS rows" for step, c in zip(FUNNEL_STEPS, counts))
    return f"SELECT step, rows, lag(rows) OVER (ORDER BY step) - rows AS removed FROM ({rows})"


def _load_counts() -> str:
    tables = {
        "dim_category": "category_keys",
        "dim_product": "product_keys",
        "dim_price_band": "band_keys",
        "dim_sentiment": "sentiment_keys",
        "fact_reviews": "lines",
    }
    return " UNION ALL ".join(f"SELECT '{name}' AS \"table\", count(*) AS rows FROM {source}" for name, source in tables.items())


def _share(part: str) -> str:
    return f"""SELECT {part}, sentiment, CAST(sum(reviews) AS BIGINT) AS reviews,
        {pct('sum(reviews)', f'sum(sum(reviews)) OVER (PARTITION BY {part})', 2)} AS share FROM cells GROUP BY {part}, sentiment"""


def _weighted(by: str) -> str:
    return f"SELECT {by}, CAST(sum(reviews) AS BIGINT) AS reviews, {ratio('sum(rating * reviews)', 'sum(reviews)', 2)} AS avg_rating FROM cells GROUP BY {by}"


def _distribution(by: str) -> str:
    return f"SELECT {by}, CAST(sum(reviews) AS BIGINT) AS reviews FROM cells GROUP BY {by}"


def _ranked(order: str) -> str:
    return f"SELECT product_name, category, reviews, avg_rating, pct_positive, avg_price FROM products ORDER BY {order}, product_name, category LIMIT 10"


def _share_of(s: str, n: str = "count(*)") -> str:
    return pct(f"count(*) FILTER (sentiment = '{s}')", n)


AVG = ratio("sum(rating)", "count(*)", 2)
FACT_COLUMNS = "product_key, price_band_key, sentiment_key, rating, price, word_count, review_text"
CANON = " || ".join(
    f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '~')" for c in FACT_COLUMNS.split(", ")
)
ONE_LINE = "regexp_replace(summary, '[\\r\\n]+', ' ', 'g')"
BRONZE = "product_name, price, rate, review_title, summary"

BODIES: dict[str, str] = {
    "bronze_csv_roundtrip": f"SELECT product_name, price, rate, review_title, {ONE_LINE} AS summary FROM raw",
    "bronze_rename": f"SELECT {BRONZE} FROM raw",
    "bronze_rejects": f"""SELECT 'kept' AS outcome, count(*) AS rows, count(DISTINCT product_name) AS different FROM raw WHERE rate IS NULL OR rate NOT IN ('2', '4')
        UNION ALL SELECT 'too few fields', count(*), count(DISTINCT (product_name, price, rate, review_title)) FROM raw WHERE rate = '2' HAVING count(*) > 0
        UNION ALL SELECT 'too many fields', count(*), count(DISTINCT (product_name, price, rate, review_title, {ONE_LINE})) FROM raw WHERE rate = '4' HAVING count(*) > 0""",
    "scan_pruned": "SELECT l_partkey, l_quantity FROM lineitem",
    "dq_row_count": "SELECT 'bronze' AS \"table\", count(*) AS rows FROM raw",
    "silver_dedup": f"SELECT {BRONZE} FROM unique_raw",
    "silver_valid_rating": f"SELECT product_name, rate, rating FROM (SELECT *, {RATING} AS rating FROM raw) WHERE rating BETWEEN 1 AND 5",
    "silver_price_parse": f"SELECT price, {PRICE} AS value FROM raw",
    "silver_valid_price": f"SELECT product_name, value AS price FROM (SELECT *, {PRICE} AS value FROM raw) WHERE value > 0 AND value < 1e10",
    "silver_text_clean": f"SELECT summary, {clean('summary')} AS review_text FROM raw",
    "silver_nonempty_text": f"SELECT product_name, review_text FROM (SELECT product_name, {clean('summary')} AS review_text FROM raw) WHERE length(review_text) >= 2",
    "silver_name_tidy": f"""SELECT arrived, {tidy('arrived')} AS product_name FROM (SELECT ' ??' || chr(65533) ||
        replace(product_name, ' ', chr(160) || chr(160) || chr(65533)) || '? ' || chr(9) || price AS arrived FROM raw)""",
    "silver_null_sentinel": "SELECT product_name, nullif(review_title, 'Nan') AS review_title FROM raw",
    "silver_sentiment": "SELECT product_name, rating, sentiment FROM lines",
    "silver_word_count": f"""SELECT review_text, CAST(len(string_split(review_text, ' ')) AS INTEGER) AS word_count
        FROM (SELECT {clean('summary')} AS review_text FROM raw) WHERE length(review_text) >= 2""",
    "silver_price_band": f"SELECT p_partkey, price, {band('price')} AS price_band FROM (SELECT p_partkey, p_retailprice * (1 + p_partkey % 12) / 2 AS price FROM part)",
    "silver_category": f"""SELECT p_partkey, product_name, {category('lower(product_name)', CATEGORY_RULES)} AS default_category,
        {category('lower(product_name)', TEST_RULES)} AS category FROM (SELECT p_partkey, p_name || ' ' || p_brand AS product_name FROM part)""",
    "silver_full": "SELECT * FROM silver",
    "silver_sentiment_split": "SELECT sentiment, count(*) AS count FROM silver GROUP BY sentiment",
    "silver_category_split": "SELECT category, count(*) AS count FROM silver GROUP BY category",
    "dq_funnel": _funnel(),
    "dq_constraints": """SELECT 'product_name not null' AS rule, count(*) FILTER (product_name IS NULL) AS violations FROM lines
        UNION ALL SELECT 'rating 2..4', count(*) FILTER (rating NOT BETWEEN 2 AND 4) FROM lines
        UNION ALL SELECT 'price under 50000', count(*) FILTER (price >= 50000) FROM lines
        UNION ALL SELECT 'words at most 40', count(*) FILTER (word_count > 40) FROM lines
        UNION ALL SELECT 'unique product_name, category', (SELECT count(*) FROM lines) - (SELECT count(*) FROM product_keys)""",
    "dq_orphans": """SELECT count(*) AS fact_rows, count(k.product_name) AS matched, count(*) - count(k.product_name) AS orphans
        FROM lines LEFT JOIN (SELECT DISTINCT product_name, category FROM first_lines) k USING (product_name, category)""",
    **{
        name: f"""SELECT category, price_band, rating, sentiment, CAST(grouping_id(category, price_band, rating, sentiment) AS BIGINT) AS grouping_id,
        count(*) AS reviews, sum({MONEY}) AS sum_price, CAST(sum(word_count) AS BIGINT) AS sum_words
        FROM lines GROUP BY {grains}(category, price_band, rating, sentiment)"""
        for name, grains in (("gold_rollup", "ROLLUP"), ("gold_all_grains", "CUBE"))
    },
    "gold_cube": f"""SELECT category, price_band, rating, sentiment, count(*) AS reviews, CAST(round(sum({MONEY}), 0) AS DOUBLE) AS sum_price,
        CAST(sum(word_count) AS BIGINT) AS sum_words FROM silver GROUP BY ALL""",
    "gold_products": "SELECT * FROM products",
    "gold_top_words": "SELECT sentiment, word, count FROM ranked_words WHERE place <= 25",
    "gold_word_pivot": "SELECT * FROM wide",
    "gold_word_signals": "SELECT * FROM signals WHERE total >= 300",
    "text_tokens": "SELECT * FROM tokens",
    "text_stopwords": "SELECT * FROM kept",
    "text_word_counts": "SELECT * FROM counts",
    "dw_dim_category": "SELECT * FROM category_keys",
    "dw_dim_price_band": "SELECT * FROM band_keys",
    "dw_dim_sentiment": "SELECT k.sentiment_key, k.sentiment, count(l.sentiment) AS reviews FROM sentiment_keys k LEFT JOIN lines l ON l.sentiment = k.sentiment GROUP BY ALL",
    "dw_dim_product": "SELECT product_key, product_name, category_key FROM product_keys JOIN category_keys ON category_name = category",
    "dw_product_lookup": "SELECT product_key, product_name, category AS category_name FROM product_keys",
    "dw_fact_reviews": """SELECT product_key, price_band_key, sentiment_key, rating, price, word_count FROM lines
        JOIN product_keys USING (product_name, category) JOIN band_keys USING (price_band) JOIN sentiment_keys USING (sentiment)""",
    "dw_typed_fact": f"SELECT {FACT_COLUMNS} FROM text_fact",
    "dw_fact_keyed": f"SELECT row_number() OVER (ORDER BY md5({CANON}), {FACT_COLUMNS}) AS review_key, {FACT_COLUMNS} FROM text_fact",
    "dw_load_counts": _load_counts(),
    "dw_dim_upsert": "SELECT id AS name_id, n AS name FROM name_ids",
    "dw_product_merge": """SELECT i.id AS product_id, i.n AS product_name, CAST(c.category_key AS BIGINT) AS category_id FROM name_ids i
        LEFT JOIN all_led a ON a.product_name = i.n LEFT JOIN first_led f ON f.product_name = i.n
        JOIN category_keys c ON c.category_name = coalesce(a.category, f.category)""",
    "dw_dim_rating": "SELECT DISTINCT rating FROM lines",
    "dw_fact_aggregate": """SELECT c.id AS category_id, b.id AS price_band_id, rating, s.id AS sentiment_id, reviews AS review_count,
        CAST(sum_price AS DOUBLE) AS sum_price, CAST(sum_words AS BIGINT) AS sum_words FROM cells
        JOIN cat_ids c ON c.n = category JOIN band_ids b ON b.n = price_band JOIN sent_ids s ON s.n = sentiment""",
    "dw_fact_product_summary": "SELECT product_id, review_count, average_rating, positive_percent, negative_percent, average_price FROM summaries",
    "sql_q01": f"SELECT category AS category_name, count(*) AS reviews, {AVG} AS avg_rating FROM lines GROUP BY category",
    "sql_q02": f"""SELECT category AS category_name, {_share_of('positive')} AS pct_positive, {_share_of('neutral')} AS pct_neutral,
        {_share_of('negative')} AS pct_negative FROM lines GROUP BY category""",
    "sql_q03": f"SELECT price_band, count(*) AS reviews, {AVG} AS avg_rating, {ratio('sum(word_count)', 'count(*)', 1)} AS avg_words FROM lines GROUP BY price_band",
    "sql_q04": f"SELECT rating, count(*) AS reviews, {pct('count(*)', '(SELECT count(*) FROM lines)')} AS pct FROM lines GROUP BY rating",
    "sql_q05": f"""SELECT left(product_name, 60) AS product, category AS category_name, count(*) AS reviews, {AVG} AS avg_rating FROM lines
        GROUP BY product_name, category ORDER BY count(*) DESC, product_name, category LIMIT 10""",
    "sql_q06": f"""SELECT left(product_name, 60) AS product, reviews, p AS pct_negative FROM
        (SELECT product_name, count(*) AS reviews, {_share_of('negative')} AS p FROM lines GROUP BY product_name HAVING count(*) >= {WORST_REVIEWS})
        ORDER BY p DESC, product_name LIMIT 10""",
    "sql_q07": f"""SELECT category AS category_name, price_band, count(*) AS reviews, {AVG} AS avg_rating FROM lines
        GROUP BY category, price_band HAVING count(*) >= 100""",
    "sql_q08": f"""SELECT sentiment, count(*) AS reviews, {ratio('sum(word_count)', 'count(*)', 1)} AS avg_words,
        {ratio(cents(f'sum({MONEY})'), '100 * count(*)', 0)} AS avg_price FROM lines GROUP BY sentiment""",
    "sql_q09": f"""SELECT category AS category_name, left(product_name, 55) AS product, reviews, avg_rating FROM
        (SELECT *, rank() OVER (PARTITION BY category ORDER BY avg_rating DESC, reviews DESC) AS r FROM products) WHERE r = 1""",
    "sql_q10": ALL_METRICS,
    "catalog_partitioned_read": "SELECT product_name, category, price, price_band, rating, sentiment, word_count FROM lines",
    "catalog_partitions": "SELECT DISTINCT 'category=' || category AS partition FROM lines",
    "hive_q1": f"""SELECT category, count(*) AS reviews, {AVG} AS avg_rating, {_share_of('positive')} AS pct_positive,
        {_share_of('negative')} AS pct_negative FROM lines GROUP BY category""",
    "hive_q2": f"SELECT price_band, count(*) AS reviews, {AVG} AS avg_rating, {_share_of('positive')} AS pct_positive FROM lines GROUP BY price_band",
    "hive_q3": f"""SELECT product_name, category, count(*) AS reviews, {AVG} AS avg_rating FROM lines GROUP BY product_name, category
        ORDER BY reviews DESC, product_name, category LIMIT 10""",
    "hive_q4_pruned_count": f"SELECT count(*) AS reviews FROM lines WHERE category = '{CATEGORY}'",
    "serve_summary": _summary(),
    "serve_summary_filtered": _summary(f"category = '{CATEGORY}' AND price_band = '{BAND}'"),
    "serve_summary_empty": _summary("category = 'no such category'"),
    "serve_sentiments": f"SELECT sentiment, CAST(sum(reviews) AS BIGINT) AS reviews FROM cells WHERE category = '{CATEGORY}' GROUP BY sentiment",
    "serve_sentiment_shares": f"""SELECT sentiment, CAST(sum(reviews) AS BIGINT) AS reviews, {pct('sum(reviews)', 'sum(sum(reviews)) OVER ()')} AS share
        FROM cells WHERE category = '{CATEGORY}' GROUP BY sentiment""",
    "serve_filters": "SELECT DISTINCT 'category' AS kind, category AS name FROM lines UNION ALL SELECT DISTINCT 'price_band', price_band FROM lines",
    "serve_products": f"""SELECT product_name, category, review_count AS reviews, average_rating, positive_percent, negative_percent, average_price
        FROM summaries JOIN led USING (product_name) WHERE category = '{CATEGORY}' ORDER BY review_count DESC, product_name, category LIMIT 20""",
    "dash_kpis": _kpis(),
    "dash_isin_filter": _kpis(f"category IN ('ECONOMY', 'PROMO') AND price_band IN ('3. 1,000-2,999', '{BAND}')"),
    "dash_filter_values": "SELECT DISTINCT 'category' AS kind, category AS name FROM cells UNION ALL SELECT DISTINCT 'price_band', price_band FROM cells",
    "dash_rating_dist": _distribution("rating"),
    "dash_sentiment_split": _distribution("sentiment"),
    "dash_category_volume": _distribution("category"),
    "dash_share_by_category": _share("category"),
    "dash_share_by_band": _share("price_band"),
    "dash_rating_by_category": _weighted("category"),
    "dash_rating_by_band": _weighted("price_band"),
    "dash_top_products": _ranked("reviews DESC"),
    "dash_lowest_rated": _ranked("avg_rating"),
    "dash_top15_words": "SELECT sentiment, word, count FROM ranked_words WHERE place <= 15",
    "dash_negative_words": f"SELECT word, neg_share, total FROM signals WHERE total >= {WORD_USES} ORDER BY neg_share DESC, word LIMIT 15",
    "dash_positive_words": f"SELECT word, pos_share, total FROM signals WHERE total >= {WORD_USES} ORDER BY pos_share DESC, word LIMIT 15",
    "dash_metrics_wide": f"""SELECT model, max(value) FILTER (metric = 'accuracy') AS accuracy, max(value) FILTER (metric = 'f1_weighted') AS f1_weighted
        FROM ({ALL_METRICS}) GROUP BY model""",
    "dash_confusion_grid": "SELECT c.actual, "
    + ", ".join(f"count(*) FILTER (p.predicted = '{s}') AS {s}" for s in THREE)
    + " FROM (VALUES ('negative'), ('neutral'), ('positive')) AS c(actual) LEFT JOIN pairs p ON p.actual = c.actual GROUP BY c.actual",
    "ml_input": "SELECT review_text, sentiment FROM silver WHERE length(review_text) > 0",
    "ml_labels": "SELECT product_name, sentiment, CAST(CASE sentiment WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 ELSE 2 END AS DOUBLE) AS label FROM lines",
    "ml_labels_binary": "SELECT product_name, sentiment, CAST(CASE sentiment WHEN 'negative' THEN 0 ELSE 1 END AS DOUBLE) AS label FROM lines WHERE sentiment <> 'neutral'",
    "ml_split": """SELECT product_name, review_text, bucket, CASE WHEN bucket < 80 THEN 'train' ELSE 'test' END AS part FROM
        (SELECT product_name, review_text, CAST(CAST('0x' || substr(md5(review_text), 1, 6) AS INTEGER) % 100 AS INTEGER) AS bucket FROM silver)""",
    "ml_class_weights": """SELECT CAST(CASE sentiment WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 ELSE 2 END AS DOUBLE) AS label, count(*) AS n,
        CAST((SELECT count(*) FROM lines) AS DOUBLE) / ((SELECT count(DISTINCT sentiment) FROM lines) * count(*)) AS weight FROM lines GROUP BY sentiment""",
    "ml_vocabulary": "SELECT word, count, df FROM vocabulary ORDER BY count DESC, word LIMIT 20000",
    "ml_idf": f"SELECT word, df, {settle('ln(((SELECT count(*) FROM silver) + 1) / (df + 1))', 6)} AS idf FROM vocabulary",
    "ml_tfidf": f"""SELECT doc_id, word, tf, {settle('tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1))', 6)} AS tfidf
        FROM (SELECT doc_id, word, count(*) AS tf FROM documents_words GROUP BY ALL) JOIN document_vocabulary USING (word)""",
    "ml_confusion": "SELECT * FROM confusion",
    "ml_class_report": " UNION ALL ".join(
        f"""SELECT '{c}' AS class, coalesce({ratio(f"count(*) FILTER (actual = '{c}' AND predicted = '{c}')", f"count(*) FILTER (predicted = '{c}')", 3)}, 0.0) AS precision,
        coalesce({ratio(f"count(*) FILTER (actual = '{c}' AND predicted = '{c}')", f"count(*) FILTER (actual = '{c}')", 3)}, 0.0) AS recall,
        coalesce({ratio(f"2 * count(*) FILTER (actual = '{c}' AND predicted = '{c}')", f"count(*) FILTER (actual = '{c}') + count(*) FILTER (predicted = '{c}')", 3)}, 0.0) AS f1,
        count(*) FILTER (actual = '{c}') AS reviews FROM pairs"""
        for c in THREE
    ),
    "ml_metrics": _metrics("3-class", "SELECT * FROM pairs", THREE),
    "ml_score": f"SELECT id AS doc_id, status, prediction, p_negative, p_neutral, p_positive FROM ({_scored('SELECT doc_id AS id, text AS txt FROM documents')})",
    "ml_score_unknown": f"SELECT id AS doc_id, status, prediction FROM ({_scored('SELECT doc_id AS id, summary AS txt FROM numbered', 10000)}) WHERE status <> 'ok'",
    "ingest_incremental": f"SELECT product_name, price, rate, review_title, {ONE_LINE} AS summary FROM numbered",
    "inc_cube": f"""SELECT category, price_band, rating, sentiment, count(*) AS reviews, CAST(round(sum({MONEY}), 0) AS DOUBLE) AS sum_price,
        CAST(sum(word_count) AS BIGINT) AS sum_words FROM silver GROUP BY ALL""",
    "inc_products": f"""SELECT product_name, category, count(*) AS reviews, {AVG} AS avg_rating, {_share_of('positive')} AS pct_positive,
        {_share_of('negative')} AS pct_negative, {ratio(cents(f'sum({MONEY})'), '100 * count(*)', 0)} AS avg_price FROM silver GROUP BY product_name, category""",
    "inc_word_pivot": "SELECT * FROM wide",
    "inc_product_keys": """SELECT row_number() OVER (ORDER BY product_name, category) AS product_key, product_name, category FROM first_products
        UNION ALL SELECT (SELECT count(*) FROM first_products) + row_number() OVER (ORDER BY product_name, category), product_name, category
        FROM later_products""",
    "inc_batches": """SELECT 'first' AS batch, (SELECT count(*) FROM first_rows) AS delivered, (SELECT count(*) FROM (SELECT DISTINCT * FROM first_rows)) AS distinct_rows,
        (SELECT count(*) FROM (SELECT DISTINCT * FROM first_rows)) AS added, (SELECT count(*) FROM (SELECT * FROM good_rows INTERSECT SELECT * FROM first_rows)) AS kept
        UNION ALL SELECT 'second', (SELECT count(*) FROM second_rows), (SELECT count(*) FROM (SELECT DISTINCT * FROM second_rows)),
        (SELECT count(*) FROM later_rows), (SELECT count(*) FROM (SELECT * FROM good_rows INTERSECT SELECT * FROM later_rows))""",
    "bench_cat_sentiment": "SELECT category, sentiment, count(*) AS reviews FROM lines GROUP BY ALL",
    "bench_cat_band": "SELECT category, price_band, count(*) AS reviews, avg(rating) AS avg_rating FROM lines GROUP BY ALL",
    "bench_replicated_agg": "SELECT category, price_band, 20 * count(*) AS reviews, avg(rating) AS avg_rating FROM lines GROUP BY ALL",
    "bench_median": f"SELECT event_type AS engine, count(*) AS runs, {settle('quantile_cont(value, 0.5)', 4)} AS seconds FROM events GROUP BY event_type",
    "bench_throughput": f"""SELECT event_type AS engine, user_id AS rows, value AS seconds,
        CASE WHEN value > 0 THEN {settle('user_id / value', 2)} ELSE 0.0 END AS rows_per_second FROM events""",
}


def _needed(body: str) -> set[str]:
    return {name for name in CTES if re.search(rf"\b{name}\b", body)}


def statement(body: str) -> str:
    """``body`` behind the common table expressions it uses, in definition order."""
    names, todo = set(), _needed(body)
    while todo:
        name = todo.pop()
        if name not in names:
            names.add(name)
            todo |= _needed(CTES[name]) - {name}
    used = [f"{name} AS ({CTES[name]})" for name in CTES if name in names]
    return ("WITH " + ",\n".join(used) + "\n" if used else "") + body


def statements() -> dict[str, str]:
    return {name: statement(body) for name, body in BODIES.items()}
