"""Arrow batches of texts in slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task works on at once; a longer text is a slice on its own.
SLICE_BYTES = 2_000_000


def byte_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, in order, with at most ``limit`` bytes in a text column or a single row; nothing is copied."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(at, end - at)
        at = end
