"""Arrow batches in tasks, a few rows at a time: a batch holds up to 64 MB, which as Python objects is ten times that."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

SLICE_ROWS = 256


def in_slices(work: Callable[..., pa.Array], *columns: pa.Array) -> pa.Array:
    """``work`` on slices of the columns, put together again."""
    return pa.concat_arrays([
        work(*(c.slice(at, SLICE_ROWS) for c in columns)) for at in range(0, max(1, len(columns[0])), SLICE_ROWS)])


def list_ends(lists: pa.ListArray) -> np.ndarray:
    """Where the lists begin and end among their flattened items; a NULL list has none."""
    return np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)


def lists_of(ends: np.ndarray, items: pa.Array, like: pa.ListArray) -> pa.ListArray:
    """Lists of these items, NULL where those of ``like`` are."""
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items, mask=like.is_null())
