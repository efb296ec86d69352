"""Where words stand in the bytes of neighbouring texts, by any choice of word bytes."""

import numpy as np


def byte_set(members: bytes) -> np.ndarray:
    """A table telling of each byte whether it is a member."""
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


def word_spans(solid: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest runs of solid bytes; a text's edge at `offsets` parts words."""
    edge = np.zeros(len(solid) + 1, bool)
    edge[offsets] = True
    begins, finishes = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    finishes[:-1] &= ~solid[1:] | edge[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(finishes) + 1
