"""Scores of symbol sequences under models that back off from long contexts to short ones."""

import numpy as np

from clearspark.llm.pretokens import hashed


def find(table: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each hash in a sorted array, -1 where it has none."""
    if not len(table):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return np.where(table[at] == wanted, at, -1)


def framed(words: list[np.ndarray], edge: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words joined, an edge symbol before and after each; every predicted place; its place in its word.

    A word's own first edge is not predicted, the one after it is.
    """
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    starts = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    symbols = np.full(total, edge, np.uint32)
    inner = np.ones(total, bool)
    inner[starts] = False
    inner[starts + sizes - 1] = False
    if words:
        symbols[inner] = np.concatenate(words)
    within = np.arange(total) - np.repeat(starts, sizes)
    places = np.flatnonzero(within > 0)
    return symbols, places, within[places]


class Backoff:
    """Sorted hash arrays: n-grams with log10 probabilities, contexts with log10 weights.

    A place's log10 probability is that of the longest n-gram listed there; each longer
    context that is listed, but not with this symbol, adds its weight. One column for each
    model that is scored at once.
    """

    def __init__(self, order: int, grams, logs, contexts, weights, floor):
        self.order, self.floor = order, floor
        self.grams, self.logs = grams, logs
        self.contexts, self.weights = contexts, weights

    def places(self, symbols: np.ndarray, places: np.ndarray, within: np.ndarray) -> np.ndarray:
        """log10 probabilities, a row for each place."""
        out = np.zeros((len(places), self.logs.shape[1]), np.float64)
        open_ = np.arange(len(places))
        size = np.minimum(within + 1, self.order)
        for n in range(self.order, 0, -1):
            now = open_[size[open_] >= n]
            spots = places[now]
            at = find(self.grams, hashed(symbols, spots - n + 1, spots + 1))
            hit = at >= 0
            out[now[hit]] += self.logs[at[hit]]
            rest = now[~hit]
            context = find(self.contexts, hashed(symbols, places[rest] - n + 1, places[rest]))
            listed = context >= 0
            out[rest[listed]] += self.weights[context[listed]]
            open_ = np.concatenate([open_[size[open_] < n], rest])
        out[open_] += self.floor
        return out

    def words(self, words: list[np.ndarray], edge: int) -> np.ndarray:
        """The log10 probability of each word and of its end, a row for each word."""
        symbols, places, within = framed(words, edge)
        each = self.places(symbols, places, within)
        sizes = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
        return np.add.reduceat(each, np.cumsum(sizes) - sizes, 0) if len(words) else np.zeros((0, self.logs.shape[1]))


class WordScores:
    """Scores of words by hash, kept in a bounded direct-mapped cache."""

    def __init__(self, model: Backoff, edge: int, bits: int = 20):
        self.model, self.edge = model, edge
        self.shift = np.uint64(64 - bits)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.scores = np.zeros((1 << bits, model.logs.shape[1]), np.float32)

    def of(self, hashes: np.ndarray, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        slots = (hashes >> self.shift).astype(np.int64)
        scores = self.scores[slots]
        missing = np.flatnonzero(self.keys[slots] != hashes)
        if len(missing):
            new, first, which = np.unique(hashes[missing], return_index=True, return_inverse=True)
            spots = missing[first]
            words = [symbols[a:b] for a, b in zip(starts[spots].tolist(), ends[spots].tolist(), strict=True)]
            found = self.model.words(words, self.edge).astype(np.float32)
            at = (new >> self.shift).astype(np.int64)
            self.keys[at], self.scores[at] = new, found
            scores[missing] = found[which]
        return scores
