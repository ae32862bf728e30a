"""Vectors between Arrow columns and matrices."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Numbers of a column of lists, one row each, padded with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), flat.dtype)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def packed(rows: np.ndarray) -> pa.BinaryArray:
    """Rows of a matrix as bytes, one value each."""
    rows = np.ascontiguousarray(rows, float)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1] * 8)
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def unpacked(values: Iterable[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), float).reshape(-1, width)
