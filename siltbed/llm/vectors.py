"""Vector columns as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vector_table(df: DataFrame, id_col: str, vector_col: str, *more: str) -> DataFrame:
    """``vec_id``, ``x`` and the columns ``more``, so that no other column can clash or be read."""
    return df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"), *more)


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each width of an Arrow column of ``array<double>``.

    Rows whose vector is null, empty, or holds null or non-finite components are in none of them.
    """
    width = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    start = np.cumsum(width) - width
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)  # a null becomes nan
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        matrix = flat[start[rows][:, None] + np.arange(w)]
        whole = np.isfinite(matrix).all(axis=1)
        if whole.any():
            yield rows[whole], matrix[whole]
