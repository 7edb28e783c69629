"""Bulk scoring of texts from a table of word weights."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from plaudit.functions.rounding import settle
from plaudit.functions.rules import SENTIMENTS, first_match
from plaudit.functions.text import letter_tokens

LONGEST_TEXT = 10_000  # of one request to a scoring service; bulk jobs take texts of any length


def score(
    texts: DataFrame,
    weights: DataFrame,
    intercepts: Mapping[str, float],
    id_cols: Sequence[str],
    text: str = "text",
    max_chars: int | None = None,
) -> DataFrame:
    """Class probabilities for every text of a table.

    ``weights`` holds ``word, idf`` and ``w_<class>``.  ``id_cols`` must identify a
    text.  ``status`` is 'ok', 'unknown' (no word of the text has a weight) or
    'invalid' (empty, or longer than ``max_chars``); only 'ok' rows get a prediction.  The words of a
    text are summed up inside its task, so the shuffle carries ids and sums only.
    """
    length = F.length(text)
    valid = F.coalesce(length >= 1, F.lit(False))
    if max_chars is not None:
        valid = valid & (length <= max_chars)
    words = texts.select(
        *id_cols,
        valid.alias("_valid"),
        F.explode_outer(F.when(valid, letter_tokens(F.col(text)))).alias("word"),
    )
    per_word = weights.select("word", *[(F.col("idf") * F.col(f"w_{c}")).alias(f"_{c}") for c in SENTIMENTS])
    sums = [F.coalesce(F.sum(f"_{c}"), F.lit(0.0)).alias(f"_{c}") for c in SENTIMENTS]
    totals = (
        words.join(per_word, "word", "left")
        .groupBy(*id_cols, "_valid")
        .agg(F.count(f"_{SENTIMENTS[0]}").alias("_known"), *sums)
    )
    # summation order must not decide between equal classes
    raw = totals.withColumns({f"_{c}": F.round(F.col(f"_{c}") + F.lit(float(intercepts[c])), 9) for c in SENTIMENTS})
    raw = raw.withColumn("_peak", F.greatest(*[F.col(f"_{c}") for c in SENTIMENTS]))
    powers = raw.withColumns({f"_e_{c}": F.exp(F.col(f"_{c}") - F.col("_peak")) for c in SENTIMENTS})
    mass = sum((F.col(f"_e_{c}") for c in SENTIMENTS[1:]), F.col(f"_e_{SENTIMENTS[0]}"))
    status = first_match([(~F.col("_valid"), "invalid"), (F.col("_known") == 0, "unknown")], "ok")
    winner = first_match([(F.col(f"_{c}") == F.col("_peak"), c) for c in SENTIMENTS[:-1]], SENTIMENTS[-1])
    scored = powers.withColumn("status", status)
    ok = F.col("status") == "ok"
    return scored.select(
        *id_cols,
        "status",
        F.when(ok, winner).alias("prediction"),
        *[F.when(ok, settle(F.col(f"_e_{c}") / mass, 6)).alias(f"p_{c}") for c in SENTIMENTS],
    )


def parity(scored: DataFrame, predicted: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """Agreement of the weight-table scores with the model's own predictions, over all rows."""
    both = scored.join(predicted.withColumnRenamed("prediction", "_model"), list(id_cols))
    ok = F.col("status") == "ok"
    return both.agg(
        F.count(F.lit(1)).alias("texts"),
        F.count_if(ok).alias("scored"),
        F.count_if(ok & (F.col("prediction") == F.col("_model"))).alias("agree"),
    )
