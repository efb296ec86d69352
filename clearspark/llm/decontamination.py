"""Benchmark decontamination: every passage queries a BM25 index of the test items.

Weights are BM25's, as shares of what the item scores against itself. A passage is `2 L`
words long and starts every `L` words, L being the longest item's length, so that a stretch
of an item's length lies whole in one of them. Items are numbered, and a block is `BLOCK`
neighbours; a term's block maximum is its largest weight there. A passage is left where no
item can reach the threshold with the weights of the item's rare terms in the passage and
of all its common ones, for all passages of a stretch at once; the rest traverse the
postings by WAND with block maxima, which finds every item at or above the threshold. Found items are verified by the share of the word n-grams of their
question (all but the last sentence) and of their answer (the last one) in the passage.

The index is sent to the tasks in parts of at most `most` items; each part is held against
all rows in turn.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearspark.llm.backoff import find
from clearspark.llm.bytewords import ByteWords, sliced
from clearspark.llm.names import free
from clearspark.llm.ngram_join import shingle_sets, shingles_of, short_shingle

K1, B = 1.2, 0.75
BLOCK_BITS = 3
#: A term is common when more than this share of the items, and more than two, have it.
COMMON = 0.05
WIDTH = 5
#: Items of fewer words say too little to tell a leak from chance.
SHORTEST = 5


def words_of(texts: list[str]) -> ByteWords:
    data = [t.encode() for t in texts]
    offsets = np.append(0, np.cumsum([len(d) for d in data])).astype(np.int64)
    return ByteWords(np.frombuffer(b"".join(data), np.uint8), offsets)


def parted(text: str) -> tuple[str, str]:
    """Question and answer: all but the last sentence, and the last one; a single sentence is a question."""
    ends = [m.end() for m in re.finditer(r"[.?!](?=\s)", text.rstrip())]
    cut = ends[-1] if ends else len(text)
    return text[:cut], text[cut:]


@dataclass
class Index:
    """Postings of some items, by term number: items ascending, weights, block maxima."""

    items: list
    hashes: np.ndarray
    firsts: np.ndarray
    numbers: np.ndarray
    weights: np.ndarray
    most: np.ndarray
    longest: int
    question: list[np.ndarray]
    answer: list[np.ndarray]
    threshold: float
    widths: set[int]

    def __post_init__(self):
        terms = np.repeat(np.arange(len(self.hashes)), np.diff(self.firsts))
        self.blocks = max(1, (len(self.items) + (1 << BLOCK_BITS) - 1) >> BLOCK_BITS)
        pairs, which = np.unique(terms * self.blocks + (self.numbers >> BLOCK_BITS), return_inverse=True)
        peak = np.zeros(len(pairs))
        np.maximum.at(peak, which, self.weights)
        self.peak_of = {int(p): float(v) for p, v in zip(pairs, peak, strict=True)}
        self.rare = np.diff(self.firsts) <= max(2, COMMON * len(self.items))
        self.rest = np.bincount(self.numbers, np.where(self.rare[terms], 0.0, self.weights), max(len(self.items), 1))

    def survivors(self, passages: np.ndarray, terms: np.ndarray, count: int) -> np.ndarray:
        """Passages in which an item may reach the threshold, by their distinct rare terms."""
        spread = np.diff(self.firsts)[terms]
        at = np.repeat(self.firsts[terms] - np.cumsum(spread) + spread, spread) + np.arange(spread.sum())
        size = len(self.rest)
        cells, which = np.unique(np.repeat(passages, spread) * size + self.numbers[at], return_inverse=True)
        total = np.bincount(which, self.weights[at], len(cells)) + self.rest[cells % size]
        alive = np.zeros(count, bool)
        alive[cells[total >= self.threshold - 1e-9] // size] = True
        return alive

    def search(self, terms: np.ndarray) -> list[tuple[int, float]]:
        """Items whose weights for these distinct terms add up to the threshold, by block-max WAND."""
        lists = [
            (self.numbers[a:b].tolist(), self.weights[a:b].tolist(), float(self.most[t]), int(t))
            for t, a, b in zip(terms.tolist(), self.firsts[terms].tolist(), self.firsts[terms + 1].tolist(), strict=True)
        ]
        at = [0] * len(lists)
        live = list(range(len(lists)))
        need, found = self.threshold - 1e-9, []

        def seek(k: int, target: int) -> None:
            numbers = lists[k][0]
            while at[k] < len(numbers) and numbers[at[k]] < target:
                at[k] += 1

        while True:
            live = sorted((k for k in live if at[k] < len(lists[k][0])), key=lambda k: lists[k][0][at[k]])
            bound, pivot = 0.0, -1
            for i, k in enumerate(live):
                bound += lists[k][2]
                if bound >= need:
                    pivot = i
                    break
            if pivot < 0:
                return found
            item = lists[live[pivot]][0][at[live[pivot]]]
            while pivot + 1 < len(live) and lists[live[pivot + 1]][0][at[live[pivot + 1]]] == item:
                pivot += 1
            block = item >> BLOCK_BITS
            peak = sum(self.peak_of.get(lists[k][3] * self.blocks + block, 0.0) for k in live[: pivot + 1])
            if peak >= need:
                if lists[live[0]][0][at[live[0]]] == item:
                    score = sum(lists[k][1][at[k]] for k in live[: pivot + 1])
                    if score >= need:
                        found.append((item, score))
                    for k in live[: pivot + 1]:
                        at[k] += 1
                else:
                    for k in live[:pivot]:
                        seek(k, item)
            else:
                target = (block + 1) << BLOCK_BITS
                if pivot + 1 < len(live):
                    target = min(target, lists[live[pivot + 1]][0][at[live[pivot + 1]]])
                for k in live[: pivot + 1]:
                    seek(k, target)


def build(items: list, texts: list[str], frequency: dict[int, int], total: int, mean: float, threshold: float) -> Index:
    """The index of some items; frequencies, number and mean length are those of all items."""
    words = words_of(texts)
    sizes = np.diff(words.firsts)
    owner = np.repeat(np.arange(len(items)), sizes)
    hashes, which = np.unique(words.hashes, return_inverse=True)
    pairs, tf = np.unique(which * len(items) + owner, return_counts=True) if len(items) else (np.zeros(0, int), np.zeros(0, int))
    terms, numbers = pairs // max(len(items), 1), pairs % max(len(items), 1)
    df = np.array([frequency.get(int(h), 1) for h in hashes.view(np.int64)], float)
    idf = np.log(1 + (total - df + 0.5) / (df + 0.5))
    weights = idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[numbers] / max(mean, 1e-9)))
    own = np.bincount(numbers, weights, len(items))
    weights = weights / np.maximum(own[numbers], 1e-12)
    most = np.zeros(len(hashes))
    np.maximum.at(most, terms, weights)
    firsts = np.searchsorted(terms, np.arange(len(hashes) + 1))
    question, answer = zip(*map(parted, texts), strict=True) if texts else ((), ())
    spoken = [words_of(list(p)) for p in (question, answer)]
    grams = [shingle_sets(w, WIDTH) for w in spoken]
    widths = {min(int(n), WIDTH) for w in spoken for n in np.diff(w.firsts)} - {0}
    return Index(items, hashes, firsts, numbers, weights, most, int(sizes.max(initial=32)), *grams, threshold, widths)


def indexes(items: DataFrame, key: str, text: str, threshold: float, most: int) -> list[Index]:
    """Indexes of at most about `most` items each, with statistics over all items.

    Null texts and those of fewer than SHORTEST words are not indexed.
    """

    def termed(batches):
        for batch in batches:
            for a, _, words in sliced(batch.column(0)):
                sizes = np.diff(words.firsts)
                for i, n in enumerate(sizes.tolist(), a):
                    own = np.unique(words.hashes[words.firsts[i - a] : words.firsts[i - a + 1]])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own.view(np.int64)), pa.array([n] + [0] * (len(own) - 1) if n else [], pa.int64())], names=["h", "n"]
                    )

    rows = items.filter(F.col(text).isNotNull() & (F.size(F.split(F.trim(text), r"[\x20\x09-\x0D]+")) >= SHORTEST))
    terms = rows.select(text).mapInArrow(termed, "h bigint, n bigint")
    frequency = terms.groupBy("h").agg(F.count("*").alias("df"), F.sum("n").alias("n"))
    total = rows.count()
    parts = max(1, -(-total // most))
    mean = (frequency.agg(F.sum("n")).first()[0] or 0) / max(total, 1)
    out = []
    for part in range(parts):
        own = rows.filter(F.pmod(F.xxhash64(key, text), F.lit(parts)) == part)
        listed = own.select(key, text).toPandas()
        used = own.select(text).mapInArrow(termed, "h bigint, n bigint").select("h").distinct()
        df = dict(frequency.join(used, "h").select("h", "df").toPandas().itertuples(index=False, name=None))
        out.append(build(listed[key].tolist(), listed[text].tolist(), df, total, mean, threshold))
    return out


def _share(wanted: np.ndarray, there: np.ndarray) -> float:
    return float((find(there, wanted) >= 0).mean()) if len(wanted) else 1.0


def _found(index: Index, words: ByteWords, overlap: float) -> dict[int, dict[int, tuple]]:
    """By text of the stretch and item: score, question and answer shares of the best passage."""
    step = index.longest
    at = find(index.hashes, words.hashes)
    hits = np.flatnonzero(at >= 0)
    if not len(hits):
        return {}
    sizes = np.diff(words.firsts)
    counts = np.maximum(-(-sizes // step), 1)
    bases = np.cumsum(counts) - counts
    rare = hits[index.rare[at[hits]]]
    owner = np.searchsorted(words.firsts, rare, "right") - 1
    window = bases[owner] + (rare - words.firsts[owner]) // step
    early = window > bases[owner]
    size = len(index.hashes)
    pairs = np.concatenate([window, window[early] - 1]) * size + np.concatenate([at[rare], at[rare][early]])
    pairs = np.unique(pairs)
    alive = index.survivors(pairs // size, pairs % size, int(counts.sum()))
    # Items of common terms alone may be in any passage.
    if (index.rest >= index.threshold - 1e-9).any():
        alive[:] = True
    out: dict[int, dict[int, tuple]] = {}
    for p in np.flatnonzero(alive).tolist():
        text = int(np.searchsorted(bases, p, "right")) - 1
        start = int(words.firsts[text]) + (p - int(bases[text])) * step
        end = min(start + 2 * step, int(words.firsts[text + 1]))
        own = np.unique(at[start:end])
        own = own[own >= 0]
        items = index.search(own)
        if not items:
            continue
        grams = passage_grams(words.hashes[start:end], index.widths)
        for item, score in items:
            q, a = _share(index.question[item], grams), _share(index.answer[item], grams)
            n, m = len(index.question[item]), len(index.answer[item])
            both = (q * n + a * m) / max(n + m, 1)
            if both >= overlap:
                best = out.setdefault(text, {})
                best[item] = max(best.get(item, (0.0,)), (both, score, q, a))
    return out


def passage_grams(words: np.ndarray, widths: set[int]) -> np.ndarray:
    """The distinct n-grams of a passage, for each n asked for, as `shingle_sets` names them."""
    parts = [np.zeros(0, np.uint64)]
    for n in widths:
        if len(words) < n:
            continue
        if n == WIDTH:
            parts.append(shingles_of(words, WIDTH))
        else:
            parts.append(short_shingle([words[k : len(words) - n + k + 1] for k in range(n)]))
    return np.unique(np.concatenate(parts))


def with_leaks(
    docs: DataFrame,
    items: DataFrame,
    keep: list[str] | None = None,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    threshold: float = 0.4,
    overlap: float = 0.5,
    most: int = 50_000,
    into: str = "leaks",
) -> DataFrame:
    """The columns `keep` (default: all) and one named `into`: the items that a row's text holds.

    An item is a leak when a passage scores at least `threshold` of the item's own score
    and holds at least `overlap` of its word n-grams; each leak has the item's key, both
    figures and the question's and answer's shares. Null and empty texts have none. Every
    row is kept; no shuffle. Only the text goes to Python and only the leaks come back.
    """
    keep = keep if keep is not None else docs.columns
    parts = indexes(items, item_key, item_text, threshold, most)
    content, *found = free([*keep, into], "content", *["found"] * len(parts))
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias(content))
    for index, name in zip(parts, found, strict=True):
        search = _searcher(docs.sparkSession.sparkContext.broadcast(index), overlap)
        rows = rows.withColumn(name, search(F.col(content)))
    leaks = F.concat(F.expr(f"cast(array() as {_KIND})"), *map(F.col, found))
    return rows.select(*keep, leaks.alias(into))


_KIND = "array<struct<item_id: bigint, overlap: double, score: double, question: double, answer: double>>"
_ARROW_KIND = pa.list_(pa.struct([("item_id", pa.int64()), *[(n, pa.float64()) for n in ("overlap", "score", "question", "answer")]]))


def _searcher(sent, overlap: float):
    def searched(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = sent.value
        for texts in batches:
            leaks = [[] for _ in range(len(texts))]
            for a, _, words in sliced(texts):
                for k, own in _found(index, words, overlap).items():
                    leaks[a + k] = [
                        {"item_id": index.items[i], "overlap": v[0], "score": v[1], "question": v[2], "answer": v[3]}
                        for i, v in sorted(own.items())
                    ]
            yield pa.array(leaks, _ARROW_KIND)

    # Else a later filter on the leaks is pushed below and the texts are searched twice.
    return F.arrow_udf(searched, _KIND).asNondeterministic()
