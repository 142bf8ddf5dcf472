"""Arrow batches cut to a bounded size, for Python that turns each body into many times its bytes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20  # of bodies handled at a time in a task; a longer body is a slice of its own


def sliced(batches: Iterable[pa.RecordBatch], column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the bodies in this column stay within the limit. Batches without rows are left out."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < batch.num_rows:
            done = int(ends[lo - 1]) if lo else 0
            hi = max(int(np.searchsorted(ends, done + limit, "right")), lo + 1)
            yield batch.slice(lo, hi - lo)
            lo = hi
