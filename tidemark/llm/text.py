"""Byte-level text helpers for the numpy parts of the operators: no Python object per word or character."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in slices of about this many bytes, so that a task's memory follows one long text at most.
SLICE_BYTES = 2 << 20
_ROWS = 512

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_BASE = 0x9E3779B97F4A7C15
_POWERS = 4096


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_WORD = _table("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
_WORD[128:] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32
_POW = np.cumprod(np.full(_POWERS, _BASE, np.uint64), dtype=np.uint64)


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of a string column; a null counts as empty.

    A slice holds whole texts: about ``SLICE_BYTES``, or one longer text.
    """
    for at in range(0, len(column), _ROWS):  # what is copied at once is a part of the batch
        for first, last, body, offsets in _slices(column.slice(at, _ROWS)):
            yield at + first, at + last, body, offsets


def _slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(ends, ends[first] + SLICE_BYTES, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, body[ends[first]:ends[last]], ends[first:last + 1] - ends[first]
        first = last


def fold(body: np.ndarray) -> np.ndarray:
    """Lower case for A-Z and the accented Latin-1 letters (two bytes, the first 0xC3)."""
    out = _FOLD[body]
    if len(out) > 1:
        upper = (out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)
        out[1:][upper] += 32
    return out


def words(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word: a run of ASCII letters, digits and bytes of other characters."""
    inside = np.zeros(len(body) + 1, bool)
    inside[:-1] = _WORD[body]
    cut = np.zeros(len(body) + 1, bool)
    cut[offsets] = True
    before = np.zeros(len(body) + 1, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut))
    ends = np.flatnonzero(before & (~inside | cut))
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * _M1
    h = h ^ (h >> np.uint64(33))
    h = h * _M2
    return h ^ (h >> np.uint64(33))


def hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes (spans are not empty and do not overlap, in ascending order)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    first = np.zeros(len(starts), np.int64)
    np.cumsum(sizes[:-1], out=first[1:])
    total = int(first[-1] + sizes[-1])
    within = np.arange(total, dtype=np.int64) - np.repeat(first, sizes)
    at = within + np.repeat(starts, sizes)
    parts = (body[at].astype(np.uint64) + np.uint64(1)) * _POW[within % _POWERS]
    return mix(np.add.reduceat(parts, first) + sizes.astype(np.uint64))


def word_hash(word: str) -> int:
    """The hash that :func:`hashes` gives for one word."""
    body = fold(np.frombuffer(word.encode(), np.uint8))
    return int(hashes(body, np.array([0]), np.array([len(body)]))[0])
