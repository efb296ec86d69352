"""Words of texts as stretches of their UTF-8 bytes, found with array operations.

A word is a longest run of bytes that are no ASCII white space; A-Z are lower-cased.
"""

import numpy as np
import pyarrow as pa

from clearspark.llm.pretokens import hashed, slices

_SOLID = np.ones(256, bool)
_SOLID[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes handled as one array.
SLICE = 1 << 20


class ByteWords:
    """The words of neighbouring texts: bytes, hashes and the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.symbols = _LOWER[data]
        solid = _SOLID[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begins, finishes = solid.copy(), solid.copy()
        begins[1:] &= ~solid[:-1] | edge[1:-1]
        finishes[:-1] &= ~solid[1:] | edge[1:-1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
        self.hashes = hashed(self.symbols, self.starts, self.ends)
        self.firsts = np.searchsorted(self.starts, offsets)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array without nulls and the offsets of its texts in them."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if offsets is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def sliced(texts: pa.Array, most: int = SLICE):
    """(first text, past last text, words) for stretches of the texts of bounded size."""
    data, offsets = raw(texts)
    for a, b in slices(np.diff(offsets).tolist(), most):
        yield a, b, ByteWords(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
