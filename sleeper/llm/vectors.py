"""Arrow list columns of numbers as numpy matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def finite_vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each length that occurs in ``column``: the places of the vectors of that
    length and their entries as doubles. Null and empty vectors and those with null or non-finite
    entries are left out."""
    length = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null entry is a NaN here
    ends = np.cumsum(np.maximum(length, 0))
    for n in np.unique(length[length > 0]):
        rows = np.flatnonzero(length == n)
        matrix = values[(ends[rows] - n)[:, None] + np.arange(n)]
        good = np.isfinite(matrix).all(axis=1)
        if good.any():
            yield rows[good], matrix[good]
