"""Small numpy helpers that several operators share; all work on one task's bounded block of rows."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import zstandard

LAST_ID = np.iinfo(np.int64).max  # stands for a missing id: such a row comes after all others


def ids_of(column) -> np.ndarray:
    """An Arrow integer column as int64; null becomes ``LAST_ID``."""
    import pyarrow.compute as pc

    filled = pc.fill_null(column.cast("int64"), int(LAST_ID))
    return filled.to_numpy(zero_copy_only=False)


def give_back() -> None:
    """At the end of a task: free memory goes back to the system.

    An executor keeps more Python workers alive than it has cores, and what each holds on to adds up.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def squeeze(x: np.ndarray) -> bytes:
    """Numbers, compressed byte by byte: the high bytes of small ones are all zero. ``unsqueeze`` takes them back."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unsqueeze(blob: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, and how often it occurs (or the sum of its ``counts``)."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(np.append(first, len(keys))) if counts is None else np.add.reduceat(counts, first)


def runs(changed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and length of each run, given a mask that is true where a run begins."""
    first = np.flatnonzero(changed)
    return first, np.diff(np.append(first, len(changed)))


def expand(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges [first, first + count): (index of the range, element) for each element of each range."""
    which = np.repeat(np.arange(len(first)), count)
    inside = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    return which, np.repeat(first, count) + inside


def multikey_order(keys: np.ndarray) -> np.ndarray:
    """Order of the rows of a (rows, tokens) matrix of unsigned words.

    Multikey quicksort by whole columns: the rows are sorted by their first token, and only runs that tie go on to
    the next token.
    """
    n, width = keys.shape
    order = np.argsort(keys[:, 0], kind="stable")
    tied = np.arange(n)
    run = np.zeros(n, np.int64)
    for c in range(width):
        if c:
            part = order[tied]
            by = np.lexsort((keys[part, c], run))
            order[tied] = part[by]
        values = keys[order[tied], c]
        same = np.zeros(len(tied), bool)
        if len(tied):
            same[1:] = (values[1:] == values[:-1]) & (run[1:] == run[:-1])
        group = np.cumsum(~same) - 1
        keep = np.bincount(group, minlength=1)[group] > 1 if len(tied) else same
        tied, run = tied[keep], group[keep]
        if not len(tied):
            break
    return order
