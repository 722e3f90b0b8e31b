"""Words between white space as Arrow values with exact numbers: equal words of a slice have equal numbers."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: What separates words: the space and the five control characters from tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Words(NamedTuple):
    """All words of a slice of texts; text ``t`` has the words ``edges[t]`` up to ``edges[t + 1]``."""

    values: pa.Array
    ids: np.ndarray
    distinct: pa.Array
    edges: np.ndarray


def split_words(body: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the texts that ``offsets`` cut ``body`` into; a word never crosses a text."""
    inside = np.zeros(len(body) + 1, bool)
    np.logical_not(SPACE[body], out=inside[:-1])
    cut = np.zeros(len(body) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside & (np.append(True, ~inside[:-1]) | cut))
    ends = np.flatnonzero(np.append(False, inside[:-1]) & (~inside | cut))
    bounds = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=bounds[1:])
    values = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(body[inside[:-1]])])
    numbered = values.dictionary_encode()
    return Words(values, numbered.indices.to_numpy(), numbered.dictionary, np.searchsorted(starts, offsets))


def per_text(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sum of ``values`` from each edge to the next."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return np.diff(sums[edges])
