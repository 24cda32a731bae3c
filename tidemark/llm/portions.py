"""Portions of Arrow batches, so that a task holds a bounded part of its texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def portions(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in slices whose ``column`` holds about ``most`` bytes, one row at least."""
    for batch in batches:
        values = batch.column(column)
        if not len(values):
            continue
        width = 8 if pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type) else 4
        kind = np.int64 if width == 8 else np.int32
        ends = np.frombuffer(values.buffers()[1], kind, len(values) + 1, values.offset * width).astype(np.int64)
        start = 0
        while start < len(values):
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + most, "right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


class Numbers(dict):
    """Numbers keys in the order in which they are first seen."""

    def __missing__(self, key) -> int:
        number = self[key] = len(self)
        return number


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of several runs one after another: ``starts[0]`` on for ``lengths[0]``, and so forth."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def small(text: str) -> bytes:
    """A text as UTF-8 with A-Z, and nothing else, in small letters."""
    return text.encode().lower()
