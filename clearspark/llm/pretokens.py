"""Pre-tokens of whole batches of texts with array operations, and a bounded cache of their ids.

Byte-pair encoding works on each pre-token alone, so a text's ids are those of its
pre-tokens joined. A batch is cut as one code point array; the pieces are hashed there, and
only pieces that the cache does not hold go to the tokenizers library. Texts with
characters outside a conservative set, or with text that may spell a special token, are
encoded whole by the library.
"""

import functools
import unicodedata

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

SPACE, LETTER, NUMBER, OTHER, EDGE, UNSURE = range(6)
#: Code points whose class no Unicode version in use disputes and that stand alone under NFC.
SAFE_END = 0x250
SAFE_BEYOND = "".join(map(chr, range(0x2010, 0x2016))) + "\u2018\u2019\u201c\u201d\u2022\u20ac\u2122"
#: Letters whose lower case is longer or depends on what follows.
ODD_CASE = "\u0130\u017f\u0149"
#: Characters of a batch that are handled as one array.
SLICE = 1 << 19
_M = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15


@functools.cache
def _classes() -> np.ndarray:
    table = np.full(0x110000 + 1, UNSURE, np.uint8)
    for point in [*range(SAFE_END), *map(ord, SAFE_BEYOND)]:
        char = chr(point)
        kind = unicodedata.category(char)[0]
        if char in ODD_CASE or 0x1C <= point <= 0x1F or point == 0x85:
            continue
        if char.isspace():
            table[point] = SPACE
        else:
            table[point] = {"L": LETTER, "N": NUMBER}.get(kind, OTHER)
    return table


@functools.cache
def _lower() -> np.ndarray:
    table = np.arange(0x110000 + 1, dtype=np.uint32)
    for point in range(SAFE_END):
        low = chr(point).lower()
        if len(low) == 1:
            table[point] = ord(low)
    return table


class _Powers:
    """Powers of the hash base and of its inverse, as far as they were needed."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            with np.errstate(over="ignore"):
                for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                    steps = np.full(n + 1, base, np.uint64)
                    steps[0] = 1
                    setattr(cls, name, np.cumprod(steps))
        return cls.up[:n], cls.down[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@functools.cache
def _symbols() -> np.ndarray:
    return mixed(np.arange(1, 0x110000 + 2, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def hashed(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the pieces [start, end) of an array of code points or bytes."""
    up, down = _Powers.to(len(symbols) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(_symbols()[symbols] * up[: len(symbols)], out=sums[1:])
        words = (sums[ends] - sums[starts]) * down[starts]
        return mixed(words + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def hashed_rows(symbols: np.ndarray) -> np.ndarray:
    """The same hash of each row of a matrix of symbols."""
    total = np.zeros(len(symbols), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(symbols.shape[1]):
            total += _symbols()[symbols[:, i]] * np.uint64(pow(_BASE, i, 1 << 64))
        return mixed(total + np.uint64(symbols.shape[1] * 0xA0761D6478BD642F & _M))


def slices(sizes: list[int], most: int = SLICE):
    """Ranges of neighbours whose sizes add up to at most `most`; a larger one stands alone."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


class Cut:
    """The pre-tokens of some texts: hashes, place in `joined`, and the first one of each text."""

    def __init__(self, texts: list[str], words_only: bool):
        self.joined = "\n".join(texts) + "\n"
        points = np.frombuffer(self.joined.encode("utf-32-le"), np.uint32)
        edges = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
        kinds = _classes()[points]
        kinds[edges] = EDGE
        if words_only:
            points = _lower()[points]
        flags = _word_flags(points, kinds) if words_only else _spaced_flags(points, kinds)
        starts = np.flatnonzero(flags)
        ends = np.append(starts[1:], len(points))
        keep = kinds[starts] != EDGE
        if words_only:
            keep &= kinds[starts] != SPACE
        self.starts, self.ends = starts[keep], ends[keep]
        self.hashes = hashed(points, self.starts, self.ends)
        self.firsts = np.searchsorted(self.starts, np.append(0, edges + 1))


def _contractions(points: np.ndarray, kinds: np.ndarray, flags: np.ndarray) -> None:
    """Marks 's 't 'm 'd 're 've 'll after an apostrophe that starts a piece."""
    at = np.flatnonzero((points[:-1] == 39) & flags[:-1] & (kinds[1:] == LETTER))
    if not len(at):
        return
    one = points[at + 1]
    two = points[np.minimum(at + 2, len(points) - 1)]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = np.zeros(len(at), bool)
    for a, b in ("re", "ve", "ll"):
        long |= (one == ord(a)) & (two == ord(b))
    for which, size in ((short, 2), (long & ~short, 3)):
        flags[at[which] + 1] = False
        flags[at[which] + size] = True


def _runs(kinds: np.ndarray) -> np.ndarray:
    begins = np.ones(len(kinds), bool)
    begins[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == EDGE)
    return begins


def _spaced_flags(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Piece starts where a single space goes with the run it precedes."""
    begins = _runs(kinds)
    flags = begins.copy()
    space = kinds == SPACE
    solid = begins & ~space & (kinds != EDGE)
    solid[0] = False
    after = np.flatnonzero(solid)
    flags[after[points[after - 1] == 32]] = False
    # The previous character may belong to another text: an edge is a line feed there.
    last = np.flatnonzero(space[:-1] & ~space[1:] & (kinds[1:] != EDGE))
    flags[last] = True
    _contractions(points, kinds, flags)
    return flags


def _word_flags(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Piece starts where white space is dropped and each number character stands alone."""
    flags = _runs(kinds)
    flags |= kinds == NUMBER
    _contractions(points, kinds, flags)
    return flags


def plain(text: str) -> bool:
    """Whether the array rules hold for this text."""
    if text.isascii():
        return "<|" not in text and not any(c in text for c in "\x1c\x1d\x1e\x1f")
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return "<|" not in text and not (_classes()[points] == UNSURE).any()


class Cache:
    """Hash -> a row of the arena, direct-mapped: a later key takes an earlier one's place."""

    def __init__(self, bits: int, arena: int, kind: type):
        self.shift = np.uint64(64 - bits)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.place = np.zeros(1 << bits, np.uint32)
        self.size = np.zeros(1 << bits, np.uint32)
        self.arena = np.zeros(arena, kind)
        self.used = 0

    def room(self, n: int) -> None:
        """Makes room for n values, forgetting all others if the arena is full."""
        if self.used + n > len(self.arena):
            self.keys[:] = 0
            self.used = 0
            if n > len(self.arena):
                self.arena = np.zeros(n, self.arena.dtype)


class Encoder:
    """Ids of texts as the tokenizers library gives them, without added special tokens."""

    def __init__(self, path: str, bits: int = 21, arena: int = 1 << 24):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.kind = np.uint16 if self.library.get_vocab_size() <= 1 << 16 else np.uint32
        self.words_only = self.library.normalizer is not None
        self.cache = Cache(bits, arena, self.kind)
        letters = [ord(c) for c in sorted(pre_tokenizers.ByteLevel.alphabet())]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = iter(sorted(c for c in letters if c not in printable))
        self.alphabet = {b: (b if b in printable else next(rest)) for b in range(256)}

    def piece(self, text: str) -> list[int]:
        """The ids of one pre-token."""
        if self.words_only:
            text = text.lower()
        spelled = text.encode().decode("latin-1").translate(self.alphabet)
        return [t.id for t in self.model.tokenize(spelled)]

    def _rows(self, cut: Cut) -> tuple[np.ndarray, np.ndarray]:
        cache = self.cache
        slots = (cut.hashes >> cache.shift).astype(np.int64)
        known = cache.keys[slots] == cut.hashes
        place, size = cache.place[slots], cache.size[slots]
        missing = np.flatnonzero(~known)
        if len(missing):
            new, first, which = np.unique(cut.hashes[missing], return_index=True, return_inverse=True)
            spots = missing[first]
            found = [
                self.piece(cut.joined[a:b])
                for a, b in zip(cut.starts[spots].tolist(), cut.ends[spots].tolist(), strict=True)
            ]
            sizes = np.fromiter(map(len, found), np.uint32, len(found))
            values = np.fromiter((i for ids in found for i in ids), self.kind, int(sizes.sum()))
            if cache.used + len(values) > len(cache.arena):
                cache.room(len(cache.arena))
                return self._rows(cut) if len(values) <= len(cache.arena) else self._grown(cut, len(values))
            places = (cache.used + np.cumsum(sizes) - sizes).astype(np.uint32)
            cache.arena[cache.used : cache.used + len(values)] = values
            cache.used += len(values)
            at = (new >> cache.shift).astype(np.int64)
            cache.keys[at], cache.place[at], cache.size[at] = new, places, sizes
            place[missing], size[missing] = places[which], sizes[which]
        return place, size

    def _grown(self, cut: Cut, n: int) -> tuple[np.ndarray, np.ndarray]:
        self.cache.room(2 * n)
        return self._rows(cut)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.library.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind) for e in found]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[np.ndarray | None] = [None] * len(texts)
        easy = [i for i, t in enumerate(texts) if plain(t)]
        odd = sorted(set(range(len(texts))) - set(easy))
        for i in odd:
            out[i] = self._whole([texts[i]])[0]
        for a, b in slices([len(texts[i]) for i in easy]):
            cut = Cut([texts[i] for i in easy[a:b]], self.words_only)
            place, size = self._rows(cut)
            ends = np.append(0, np.cumsum(size, dtype=np.int64))
            at = np.repeat(place.astype(np.int64) - ends[:-1], size) + np.arange(ends[-1])
            ids, edges = self.cache.arena[at], ends[cut.firsts]
            for k, i in enumerate(easy[a:b]):
                out[i] = ids[edges[k] : edges[k + 1]]
        return out


def proved_whole(path: str) -> np.ndarray:
    """Sorted hashes of the vocabulary's strings that encode alone, as one pre-token, to one token.

    Bounded by the vocabulary. Each is proved by encoding it with the library.
    """
    library = Tokenizer.from_file(path)
    byte_of = {point: b for b, point in Encoder(path).alphabet.items()}
    suffix = library.model.end_of_word_suffix or ""
    strings = []
    for spelled in library.get_vocab(with_added_tokens=False):
        if not spelled.endswith(suffix):
            continue
        raw = bytes(byte_of.get(ord(c), 0) for c in spelled.removesuffix(suffix))
        text = raw.decode("utf-8", "replace")
        if text and plain(text):
            strings.append(text)
    one = [t for t, e in zip(strings, library.encode_batch(strings, add_special_tokens=False), strict=True) if len(e) == 1]
    cut = Cut(one, library.normalizer is not None)
    alone = np.flatnonzero(np.diff(cut.firsts) == 1)
    return np.unique(cut.hashes[cut.firsts[alone]])


class Counter:
    """Token counts: proved whole tokens count as one, only other pre-tokens are merged."""

    def __init__(self, path: str, whole: np.ndarray, bits: int = 21):
        self.encoder = Encoder(path, bits, 1)
        self.whole = whole

    def _sizes(self, cut: Cut) -> np.ndarray:
        cache = self.encoder.cache
        slots = (cut.hashes >> cache.shift).astype(np.int64)
        size = cache.size[slots]
        missing = np.flatnonzero(cache.keys[slots] != cut.hashes)
        if len(missing):
            new, first, which = np.unique(cut.hashes[missing], return_index=True, return_inverse=True)
            at = np.minimum(np.searchsorted(self.whole, new), max(len(self.whole) - 1, 0))
            merged = np.ones(len(new), np.uint32)
            rest = np.flatnonzero(self.whole[at] != new) if len(self.whole) else np.arange(len(new))
            for k, spot in zip(rest.tolist(), missing[first[rest]].tolist(), strict=True):
                merged[k] = len(self.encoder.piece(cut.joined[cut.starts[spot] : cut.ends[spot]]))
            slot = (new >> cache.shift).astype(np.int64)
            cache.keys[slot], cache.size[slot] = new, merged
            size[missing] = merged[which]
        return size

    def count(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        easy = []
        for i, text in enumerate(texts):
            if plain(text):
                easy.append(i)
            else:
                out[i] = len(self.encoder.library.encode(text, add_special_tokens=False))
        for a, b in slices([len(texts[i]) for i in easy]):
            cut = Cut([texts[i] for i in easy[a:b]], self.encoder.words_only)
            sums = np.append(0, np.cumsum(self._sizes(cut), dtype=np.int64))
            out[easy[a:b]] = np.diff(sums[cut.firsts])
        return out


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(path)
