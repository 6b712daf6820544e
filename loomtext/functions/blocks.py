"""Batches of texts handled block by block, so that memory follows a block and not the batch."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of the first column that are handled at once (or one text).
BLOCK_BYTES = 1_000_000


def in_blocks(make: Callable[..., pa.Array], *columns: pa.Array) -> pa.Array:
    """`make` of the columns of a batch, block by block; what it needed goes back to the system after the batch."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(columns[0]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    parts, at = [], 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK_BYTES, "right")))
        rows = pa.array(np.arange(at, stop))  # arrays of their own: not all Arrow functions respect a slice
        parts.append(make(*[c.take(rows) for c in columns]))
        at = stop
    out = pa.concat_arrays(parts) if parts else make(*columns)
    del parts
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library
    return out
