"""Batches of embedding vectors as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Integer entries must stay below this, so that squares and sums of products fit into 64 bits.
LARGEST = 1 << 26


def whole_rows(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a list column: the positions of rows with exactly ``dims`` entries, none null or non-finite, and their matrix."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))])[:-1]
    at = np.flatnonzero(lengths == dims)
    matrix = values[starts[at][:, None] + np.arange(dims)] if dims and len(at) else np.zeros((len(at), dims))
    fine = np.isfinite(matrix).all(axis=1)
    return at[fine], matrix[fine]


def integers(matrix: np.ndarray, scale: float) -> np.ndarray:
    """``floor(scale * x)`` of every entry, as int64."""
    out = np.floor(scale * matrix)
    if out.size and np.abs(out).max() >= LARGEST:
        raise ValueError(f"a vector has an entry whose integer is not below {LARGEST}: distances would not fit into 64 bits")
    return out.astype(np.int64)


def doubles(table: DataFrame, key: str, vector: str) -> DataFrame:
    """Two columns, the key and the vector as doubles, whatever else the table holds."""
    return table.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").cast("array<double>").alias("v"))


def kind_of(table: DataFrame, key: str) -> str:
    return table.schema[key].dataType.simpleString()
