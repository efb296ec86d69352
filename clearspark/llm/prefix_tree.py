"""A trie over sets, in which each set looks for the sets it overlaps enough.

Sets are sequences under one order of their members, the most shared ones first, so that
sets that overlap share the trie's upper edges. A search carries the overlap with the path
so far; it is counted once for all sets below. A subtree is left where the members still to
come, on the set's side or on the subtree's longest side, cannot make up the overlap that
even its shortest set needs.
"""

import numpy as np


class Threshold:
    """Two sets are alike when percent * |union| <= 100 * |intersection|."""

    def __init__(self, percent: int):
        self.percent = percent

    def overlap(self, both: int) -> int:
        """The least intersection of two sets whose sizes add up to `both`."""
        return -(-self.percent * both // (100 + self.percent))

    def shortest(self, size: int) -> int:
        """The least size of a set that is alike to one of this size; also their least intersection."""
        return -(-self.percent * size // 100)

    def common(self, size: int) -> int:
        """How many members the prefixes of two alike sets share at least, the smaller of this size."""
        return max(1, size // 10)

    def prefix(self, size: int) -> int:
        """So many first members of a set.

        Alike sets x and y overlap in at least max(shortest(|x|), shortest(|y|)) members, so
        prefixes longer by k than what may be missing share at least k.
        """
        return size - self.shortest(size) + self.common(size) if size else 0


class Node:
    __slots__ = ("start", "end", "low", "high", "short", "long", "kids")

    def __init__(self, start, end, low, high, short, long, kids):
        self.start, self.end, self.low, self.high = start, end, low, high
        self.short, self.long, self.kids = short, long, kids


class Trie:
    """Sets of member numbers, each an ascending array; `order` lists them as the leaves do."""

    def __init__(self, sets: list[np.ndarray]):
        keys = [s.astype(">u4").tobytes() for s in sets]
        self.order = sorted(range(len(sets)), key=keys.__getitem__)
        self.sets = [sets[i] for i in self.order]
        self.shared = [0] + [_common(a, b) for a, b in zip(self.sets, self.sets[1:], strict=False)]
        self.roots = self._below(0, len(sets), 0)

    def _below(self, low: int, high: int, depth: int) -> list[Node]:
        """The edges out of the node that leaves [low, high) share to `depth`."""
        out: list[Node] = []
        todo = [(low, high, depth, out)]
        while todo:
            low, high, depth, into = todo.pop()
            at = low
            while at < high:
                stop = at + 1
                while stop < high and self.shared[stop] > depth:
                    stop += 1
                sizes = [len(self.sets[i]) for i in range(at, stop)]
                end = min(self.shared[at + 1 : stop], default=sizes[0])
                node = Node(depth, end, at, stop, min(sizes), max(sizes), [])
                into.append(node)
                inner = at
                while inner < stop and len(self.sets[inner]) == end:
                    inner += 1
                if inner < stop and stop - at > 1:
                    todo.append((inner, stop, end, node.kids))
                at = stop
        return out

    def leaves_alike(self, own: np.ndarray, member: np.ndarray, limit: Threshold, skip):
        """Yields leaves whose sets are alike to `own`; `member` flags its numbers.

        skip(low, high) says whether none of these leaves is wanted; it is asked again
        after each leaf that was yielded.
        """
        size, least = len(own), limit.shortest(len(own))
        todo = [(node, 0) for node in reversed(self.roots)]
        while todo:
            node, overlap = todo.pop()
            if node.long < least or limit.shortest(node.short) > size or skip(node.low, node.high):
                continue
            edge = self.sets[node.low][node.start : node.end]
            if len(edge):
                overlap += int(np.count_nonzero(member[edge]))
                passed = int(np.searchsorted(own, edge[-1], "right"))
            else:
                passed = 0
            most = overlap + min(size - passed, node.long - node.end)
            if most < limit.overlap(size + max(node.short, least)):
                continue
            first_kid = node.kids[0].low if node.kids else node.high
            for leaf in range(node.low, first_kid):
                if not skip(leaf, leaf + 1) and overlap >= limit.overlap(size + len(self.sets[leaf])):
                    yield leaf
            todo.extend((kid, overlap) for kid in reversed(node.kids))


def _common(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    different = np.flatnonzero(a[:n] != b[:n])
    return int(different[0]) if len(different) else n


def numbered(sets: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """The sets with members numbered from the most shared on, ascending, and the number of members."""
    flat = np.concatenate(sets)
    _, which, counts = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
    cuts = np.cumsum([len(s) for s in sets])[:-1]
    return [np.sort(s) for s in np.split(rank[which], cuts)], len(counts)


def forest(sets: list[np.ndarray], limit: Threshold, probes: list[np.ndarray] | None = None) -> list[tuple[int, int]]:
    """Links that connect what links of like sets connect, and no others.

    Each set is held against all others, or with `probes` each of those against each set;
    a probe's number follows the sets'. Sets that are connected already are not compared.
    """
    if not sets or (probes is None and len(sets) < 2):
        return []
    everything, members = numbered([*sets, *(probes or [])])
    trie = Trie(everything[: len(sets)])
    part = np.arange(len(everything))
    leaf_of = np.array(trie.order)
    flags = np.zeros(members, bool)
    links = []
    asked = [(i, own, k + 1) for k, (i, own) in enumerate(zip(trie.order, trie.sets, strict=True))]
    if probes is not None:
        asked = [(len(sets) + i, own, 0) for i, own in enumerate(everything[len(sets) :])]
    for number, own, after in asked:
        flags[own] = True

        def skip(low, high, number=number, after=after):
            return high <= after or bool((part[leaf_of[max(low, after) : high]] == part[number]).all())

        for leaf in trie.leaves_alike(own, flags, limit, skip):
            other = int(leaf_of[leaf])
            links.append((number, other))
            part[part == part[other]] = part[number]
        flags[own] = False
    return links
