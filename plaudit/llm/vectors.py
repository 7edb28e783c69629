"""Embedding columns as numpy rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def usable(column: pa.Array) -> tuple[list[np.ndarray | None], np.ndarray]:
    """Vectors in double precision, None where a row is null, empty, zero, or holds null or
    non-finite components; and the number of components of each."""
    out: list[np.ndarray | None] = []
    for value in column:
        row = None
        if value.is_valid and len(value.values):
            numbers = pc.cast(value.values, pa.float64())
            if not numbers.null_count:
                made = numbers.to_numpy()
                if np.isfinite(made).all() and made.any():
                    row = made
        out.append(row)
    return out, np.array([0 if r is None else len(r) for r in out], np.int32)


def unit(row: np.ndarray) -> np.ndarray:
    row = row / np.abs(row).max()
    return row / np.sqrt(row @ row)
