"""Fixed-width digests of whole rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def canonical(columns: Sequence[str]) -> Column:
    """One string per row; length prefixes keep it unambiguous, '~' stands for NULL."""
    parts = []
    for name in columns:
        value = F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("~")))
    return F.concat(*parts)


def row_digest(columns: Sequence[str]) -> Column:
    return F.sha2(canonical(columns), 256)


def row_md5(columns: Sequence[str]) -> Column:
    return F.md5(canonical(columns))
