"""All runs of a sequence of numbers, by suffix trees of it and of its reversal.

A run is a longest stretch with smallest period q and at least 2q members. Each one
holds a Lyndon word (under the order of the numbers or its reverse) of length q that is the
longest one from its first place on. So each place gives two candidates; each is extended
to both sides by the common extension of two places, which is the depth of the lowest
common ancestor of two leaves: a range minimum over the Euler tour of the tree.
"""

import numpy as np


class SuffixTree:
    """Ukkonen's suffix tree of a sequence of numbers from 1 on, with an end mark 0."""

    def __init__(self, numbers: list[int]):
        symbols = [*numbers, 0]
        self.n, self.size = len(symbols), max(symbols) + 1
        self.begin, self.finish, self.child = self._grown(symbols)
        self.keys = np.fromiter(self.child.keys(), np.int64, len(self.child))
        self.nodes = np.fromiter(self.child.values(), np.int64, len(self.child))
        self.child = {}

    def _grown(self, symbols: list[int]):
        """First and past-last place of the edge above each node; (node, symbol) to child."""
        n, size = self.n, self.size
        begin, finish, link, child = [0], [0], [0], {}
        node = edge = length = waiting = 0
        for i, symbol in enumerate(symbols):
            waiting, unlinked = waiting + 1, 0
            while waiting:
                if not length:
                    edge = i
                key = node * size + symbols[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(begin)
                    begin.append(i), finish.append(n), link.append(0)
                    if unlinked:
                        link[unlinked] = node
                    unlinked = node
                else:
                    span = finish[below] - begin[below]
                    if length >= span:
                        node, edge, length = below, edge + span, length - span
                        continue
                    at = begin[below] + length
                    if symbols[at] == symbol:
                        length += 1
                        if unlinked:
                            link[unlinked] = node
                        break
                    fork = len(begin)
                    begin.append(begin[below]), finish.append(at), link.append(0)
                    begin.append(i), finish.append(n), link.append(0)
                    begin[below] = at
                    child[key] = fork
                    child[fork * size + symbols[at]] = below
                    child[fork * size + symbol] = fork + 1
                    if unlinked:
                        link[unlinked] = fork
                    unlinked = fork
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        return begin, finish, child

    def tour(self, falling: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of the Euler tour, and the least depth passed before each.

        Children are visited by their symbols, rising or falling; the end mark is least in both.
        """
        keys, n = self.keys, self.n
        if falling:
            keys = keys - keys % self.size + (-keys) % self.size
        order = np.argsort(keys)
        first = np.searchsorted(keys[order] // self.size, np.arange(len(self.begin) + 1)).tolist()
        below = self.nodes[order].tolist()
        spans = (np.array(self.finish) - np.array(self.begin)).tolist()
        depth, above = [0] * len(spans), [0] * len(spans)
        suffixes, lows, low, stack = [], [], n, [0]
        while stack:
            node = stack.pop()
            if above[node] < low:
                low = above[node]
            own = depth[node]
            children = below[first[node] : first[node + 1]]
            if children:
                for child in reversed(children):
                    above[child] = own
                    depth[child] = own + spans[child]
                    stack.append(child)
            else:
                suffixes.append(n - own)
                lows.append(low)
                low = n
        return np.array(suffixes), np.array(lows)


class Extension:
    """How far the sequence reads alike from two places on, in constant time for each pair."""

    def __init__(self, suffixes: np.ndarray, lows: np.ndarray):
        self.rank = np.empty(len(suffixes), np.int64)
        self.rank[suffixes] = np.arange(len(suffixes))
        self.rows = [lows.astype(np.int32)]
        width = 1
        while 2 * width <= len(lows):
            row = self.rows[-1]
            self.rows.append(np.minimum(row[:-width], row[width:]))
            width *= 2

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Of different places."""
        a, b = self.rank[left], self.rank[right]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.zeros(len(low), np.int64)
        for k in np.unique(level):
            own = level == k
            row = self.rows[k]
            out[own] = np.minimum(row[low[own]], row[high[own] - (1 << k)])
        return out


def next_smaller(values: list[int]) -> np.ndarray:
    """For each place the next one with a smaller value; the last place has the least of all."""
    out, stack = [0] * len(values), []
    for i, value in enumerate(values):
        while stack and values[stack[-1]] > value:
            out[stack.pop()] = i
        stack.append(i)
    return np.array(out)[:-1]


def runs(numbers: list[int], least: int = 2) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least `least` members, by start, then period."""
    n = len(numbers)
    if n < 2:
        return []
    tree = SuffixTree(numbers)
    rising, lows = tree.tour()
    ahead = Extension(rising, lows)
    back = Extension(*SuffixTree(numbers[::-1]).tour())
    places, found = np.arange(n), []
    for suffixes in (rising, tree.tour(falling=True)[0]):
        rank = np.empty(n + 1, np.int64)
        rank[suffixes] = np.arange(n + 1)
        follow = next_smaller(rank.tolist())
        period = follow - places
        # The suffix at n is the end mark alone and shares nothing with any other.
        end = follow + ahead(places, follow)
        start = places - back(n - places, n - follow)
        long = end - start >= np.maximum(2 * period, least)
        found.append(np.stack([start[long], (end - start)[long], period[long]], 1))
    unique = np.unique(np.concatenate(found), axis=0)
    order = np.lexsort((unique[:, 2], unique[:, 0]))
    return [tuple(r) for r in unique[order].tolist()]
