"""Arrow batches in slices, for steps in Python whose memory should not follow the size of a batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(texts: pa.Array, bytes_at_once: int) -> Iterator[tuple[int, pa.Array]]:
    """The texts in slices of at most as many bytes besides one text, each with the place of its first text."""
    if not len(texts):
        return
    before = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)) // bytes_at_once
    starts = np.flatnonzero(np.diff(before, prepend=-1)).tolist()
    for start, end in zip(starts, [*starts[1:], len(texts)], strict=True):
        yield start, texts.slice(start, end - start)
