"""Arrow helpers shared by the executor-side functions of this package.

Worker functions are pickled by value, so executors need no package path.
"""

from __future__ import annotations

import ctypes
import sys as _sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

SLICE_BYTES = 4 << 20
MAPPED = 1 << 20
M_MMAP_THRESHOLD = -3  # of malloc.h


def give_back() -> None:
    """Return freed memory to the system: a worker process outlives its tasks, and what one
    task's peak left behind counts against the next one's.  From then on an array of ``MAPPED``
    bytes goes back as soon as it is freed, which no gap between others keeps."""
    pa.default_memory_pool().release_unused()
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(M_MMAP_THRESHOLD, MAPPED)
        libc.malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps its own house
        pass


def text_slices(batches, column: str = "text", max_bytes: int = SLICE_BYTES):
    """Cut record batches so that one slice holds at most ``max_bytes`` of ``column``
    (a longer single text is a slice of its own).  Bounds a worker's memory."""
    give_back()
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    give_back()


def column(batch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def texts_of(batch, name: str = "text") -> pa.Array:
    """The texts with null as the empty text, copied out of the batch: some string kernels
    return invalid offsets for arrays that are cast from the middle of a buffer."""
    own = column(batch, name).take(pa.array(np.arange(batch.num_rows)))
    return pc.fill_null(own.cast(pa.large_string()), "")


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text, flattened.  Returns (bounds, words):
    the words of text i are ``words[bounds[i]:bounds[i + 1]]``."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    keep = pc.not_equal(flat, "")
    mask = keep.to_numpy(zero_copy_only=False).astype(bool)
    count = np.concatenate([[0], np.cumsum(mask)])
    offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    return count[offsets - offsets[0]], flat.filter(keep)


def word_codes(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(codes, distinct words) with ``words[i] == distinct[codes[i]]``."""
    if len(words) == 0:
        return np.zeros(0, np.int64), words
    enc = words.dictionary_encode()
    return enc.indices.to_numpy(zero_copy_only=False).astype(np.int64), enc.dictionary


def ragged_take(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices that concatenate the ranges [starts[i], starts[i] + lengths[i])."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
