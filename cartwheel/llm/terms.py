"""Terms of the texts of an Arrow batch, found on the UTF-8 bytes of all texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from cartwheel.llm.common import text_bytes

#: A-Z become a-z, every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of the bytes in closed ranges."""
    out = np.zeros(256, bool)
    for first, last in ranges:
        out[first:last + 1] = True
    return out


#: Fixed values, after lower-casing: letters are a-z and all beyond ASCII; words are all but blanks.
LETTERS = byte_class((97, 122), (128, 255))
WORDS = ~byte_class((0x20, 0x20), (0x09, 0x0D))


class Terms:
    """The runs of ``inside`` bytes of every text, as ranges [start, end) of one lower-cased byte array, with their texts' places."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray, inside: np.ndarray) -> None:
        offsets, raw = text_bytes(texts)
        first, last = int(offsets[0]), int(offsets[-1])
        self.data = LOWER[raw[first:last]]
        offsets = offsets - first
        member = inside[self.data]
        cut = np.zeros(len(member) + 1, bool)
        cut[offsets] = True  # a term ends with its text
        self.starts = np.flatnonzero(member & (~np.r_[False, member[:-1]] | cut[:-1]))
        self.ends = np.flatnonzero(member & (~np.r_[member[1:], False] | cut[1:])) + 1
        self.text = np.searchsorted(offsets, self.starts, side="right") - 1

    def strings(self, which: np.ndarray | None = None) -> pa.LargeStringArray:
        """The terms (or some of them) as strings."""
        starts, ends = (self.starts, self.ends) if which is None else (self.starts[which], self.ends[which])
        lengths = ends - starts
        offsets = np.r_[0, np.cumsum(lengths)].astype(np.int64)
        places = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
        return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(self.data[places]))


def codes(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(place of every value among the distinct ones, the distinct values)."""
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def pairs(a: np.ndarray, b: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs (a, b < width) in ascending order, and how often each occurs."""
    width = max(width, 1)
    both, n = np.unique(a * width + b, return_counts=True)
    return both // width, both % width, n
