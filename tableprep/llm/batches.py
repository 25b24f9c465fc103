"""Small helpers around Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20


def raw(column: pa.Array) -> list[bytes]:
    """The bytes of each text; null counts as empty. Nothing is decoded, so malformed UTF-8 passes."""
    return [b"" if value is None else value for value in column.cast(pa.binary()).to_pylist()]


def text(data: bytes) -> str:
    """Malformed bytes become U+FFFD."""
    return data.decode("utf-8", "replace")


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of each batch that hold about ``most`` bytes of text, or one row where that alone is longer."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.binary())), 0).to_numpy(zero_copy_only=False)
        lot = (np.cumsum(sizes, dtype=np.int64) + 64 * np.arange(len(sizes))) // most
        cuts = np.flatnonzero(np.diff(lot)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(sizes)], strict=True):
            yield batch.slice(int(start), int(end - start))


def lists(values: np.ndarray, lengths: list[int] | np.ndarray) -> pa.ListArray:
    """One list for each length, cut from ``values``."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
