"""Batch helpers shared by the operators that look at text inside tasks."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text looked at together inside a task; bounds a worker's working set whatever the batch size.
SLICE_BYTES = 3_000_000
# ASCII white space: the complement of the word class [^\x20\x09-\x0D].
WHITE = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def per_worker(key: tuple, make):
    """An object kept by a Python worker between its tasks. Functions travel to tasks by value, so a module global
    would begin anew with every task."""
    import sys
    from types import ModuleType

    kept = sys.modules.setdefault("_barlake_worker", ModuleType("_barlake_worker"))
    objects = kept.__dict__.setdefault("objects", {})
    if key not in objects:
        objects[key] = make()
    return objects[key]


def free_name(df, name: str, *more: str) -> str:
    """``name``, with as many underscores before it as set it apart from the columns of ``df`` and from ``more``."""
    taken = {c.lower() for c in (*df.columns, *more)}
    while name.lower() in taken:
        name = "_" + name
    return name


def filled(texts: pa.Array) -> pa.Array:
    """Text column with null as the empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return pc.fill_null(texts.cast(pa.large_string()), "")


def slices(texts: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``max_bytes`` of text; a single longer text is a range of its own."""
    n = len(texts)
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)) if n else []
    lo, base = 0, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        yield lo, hi
        lo, base = hi, int(ends[hi - 1])
    pa.default_memory_pool().release_unused()


def coded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of a slice as (words per row, code of each word in order, distinct words)."""
    lists = pc.ascii_split_whitespace(texts)
    per_row = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.dictionary_encode(lists.flatten())
    codes = coded.indices.to_numpy(zero_copy_only=False)
    vocab = coded.dictionary
    rows = np.repeat(np.arange(len(texts)), per_row)
    empty = pc.index(vocab, pa.scalar("", vocab.type)).as_py()
    if empty >= 0:
        keep = codes != empty
        codes, rows = codes[keep], rows[keep]
    return np.bincount(rows, minlength=len(texts)).astype(np.int64), codes, vocab


def bounds(counts: np.ndarray) -> np.ndarray:
    """Start offsets of rows with the given counts, plus the end."""
    return np.concatenate(([0], np.cumsum(counts)))


def list_array(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds(counts), pa.int32()), values)
