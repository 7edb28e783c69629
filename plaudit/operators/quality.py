"""Quality funnel, row counts, constraints and orphan checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from plaudit.functions.digest import row_digest
from plaudit.functions.text import has_two_letters
from plaudit.operators.clean import price_fits, price_value, rating_value

# ---- fixed values: step names of the report ---------------------------------
FUNNEL_STEPS = (
    "1. Bronze rows (raw)",
    "2. After removing exact duplicates",
    "3. After removing invalid ratings",
    "4. After removing rows with unreadable price",
    "5. After removing empty review text",
)
# -----------------------------------------------------------------------------


def silver_checks() -> list[Column]:
    """What a distinct row must pass, in funnel order."""
    return [
        rating_value().between(1, 5),
        price_fits(price_value()),
        has_two_letters(F.col("summary")),
    ]


def quality_funnel(raw: DataFrame, checks: Sequence[Column] | None = None, steps: Sequence[str] = FUNNEL_STEPS) -> DataFrame:
    """Rows left after each step and rows each step removed, in one pass over ``raw``.

    Every row is reduced to the step at which it fails and a 256-bit digest before
    the shuffle, so neither texts nor copies travel.
    """
    checks = silver_checks() if checks is None else list(checks)
    passed_all = len(checks) + 2
    failed_at = F.lit(passed_all)
    for position, check in reversed(list(enumerate(checks, start=2))):
        failed_at = F.when(F.coalesce(check, F.lit(False)), failed_at).otherwise(F.lit(position))
    distinct = (
        raw.select(failed_at.alias("passed"), row_digest(raw.columns).alias("digest"))
        .groupBy("passed", "digest")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    left = [F.coalesce(F.sum("copies"), F.lit(0)).alias("s1"), F.count(F.lit(1)).alias("s2")]
    left += [F.count_if(F.col("passed") > n).alias(f"s{n + 1}") for n in range(2, passed_all)]
    rows = F.array(*[F.struct(F.lit(step).alias("step"), F.col(f"s{n}").alias("rows")) for n, step in enumerate(steps, start=1)])
    # five rows: the window holds the report, not the data
    before = F.lag("rows").over(Window.orderBy("step"))
    return (
        distinct.agg(*left)
        .select(F.inline(rows))
        .withColumn("removed", before - F.col("rows"))
    )


def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")


def load_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [row_count(df, name) for name, df in tables.items()])


def assert_written(written: DataFrame, expected: DataFrame) -> int:
    """Check the schema of a table just written and return its row count."""
    want = [(f.name, f.dataType) for f in expected.schema]
    have = [(f.name, f.dataType) for f in written.schema]
    if want != have:
        raise AssertionError(f"written schema {have} differs from {want}")
    return written.count()


def check_constraints(df: DataFrame, rules: Mapping[str, Column], unique: Sequence[str] = ()) -> DataFrame:
    """Violations per rule.  A rule that is NULL for a row is violated.

    ``unique`` columns form a key: each row beyond the first of a key counts.
    """
    counts = [F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"v{n}") for n, rule in enumerate(rules.values())]
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"v{n}").alias("violations")) for n, name in enumerate(rules)])
    report = df.agg(*counts).select(F.inline(pairs))
    if unique:
        surplus = (
            df.groupBy(*unique)
            .agg((F.count(F.lit(1)) - 1).alias("surplus"))
            .agg(F.coalesce(F.sum("surplus"), F.lit(0)).alias("violations"))
            .select(F.lit("unique " + ", ".join(unique)).alias("rule"), "violations")
        )
        report = report.unionByName(surplus)
    return report


def orphans(fact: DataFrame, dim: DataFrame, key: Sequence[str]) -> DataFrame:
    """How many fact rows find a dimension row, and how many do not.

    Fact rows are counted per key first, so a key held by many rows is one row in
    the join.  NULL keys never match, as in an inner join.
    """
    per_key = fact.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(*key).distinct().withColumn("known", F.lit(1))
    total = F.coalesce(F.sum("n"), F.lit(0))
    matched = F.coalesce(F.sum(F.when(F.col("known") == 1, F.col("n"))), F.lit(0))
    return per_key.join(known, list(key), "left").agg(
        total.alias("fact_rows"), matched.alias("matched"), (total - matched).alias("orphans")
    )
