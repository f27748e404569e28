"""Vector columns: which rows take part, batches of them as matrices, and matrices as binary rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def finite(vector: Column) -> Column:
    """Whether the vector is there and every component is a finite number."""
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine, F.lit(False))


def numbered(df: DataFrame) -> DataFrame:
    """The rows with a number of their own, `row`, as ids may repeat or be missing. Store the result
    before it is used twice."""
    return df.withColumn("row", F.monotonically_increasing_id())


def matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a batch as doubles; a shorter one ends in zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = int(lengths.max(initial=0))
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    full = np.zeros((len(lengths), width))
    full[np.arange(width) < lengths[:, None]] = values
    return full


def ids_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids as numbers, and which of them are there."""
    return column.fill_null(0).to_numpy(zero_copy_only=False), column.is_valid().to_numpy(zero_copy_only=False)


def as_ids(ids: np.ndarray, named: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=~named)


def one_list(values: pa.Array) -> pa.Array:
    """A column of one row that holds all the values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def packed_body(vectors: np.ndarray) -> tuple[bytes, int, bool]:
    """The matrix as bytes, its width, and whether it is of single precision, where that loses nothing."""
    single = vectors.astype(np.float32)
    exact = bool((single.astype(np.float64) == vectors).all())
    return (single if exact else vectors).tobytes(), vectors.shape[1], exact


def unpacked_body(body: pa.Scalar, rows: int, single: bool) -> np.ndarray:
    flat = np.frombuffer(body.as_buffer(), np.float32 if single else np.float64)
    return flat.reshape(rows, -1) if rows else flat.reshape(0, 0)


def widened(vectors: np.ndarray, width: int) -> np.ndarray:
    return np.pad(vectors, ((0, 0), (0, width - vectors.shape[1]))) if vectors.shape[1] < width else vectors


def first_by_score(at: np.ndarray, score: np.ndarray, ids: np.ndarray, named: np.ndarray, most: int) -> np.ndarray:
    """Of the places `at`, the `most` with the highest scores, ties to smaller ids, rows without an id last."""
    if len(at) > most:
        own = score[at]
        at = at[own >= np.partition(own, len(own) - most)[len(own) - most]]
    return at[np.lexsort((ids[at], ~named[at], -score[at]))[:most]]
