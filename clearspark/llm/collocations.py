"""Phrases whose words stand together more often than apart, mined in two passes.

The first pass counts fingerprints of all phrases into Misra-Gries summaries, one for each
hash partition. Tasks send partial counts; a partition merges them into a summary of a
capacity above its mass divided by the threshold, out of which no phrase at the threshold
falls. What a summary counts is short of the truth by at most what it took off, so whatever
cannot reach the threshold even with that goes too. The second pass counts the phrases that
survive exactly.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clearspark.llm.bytewords import raw
from clearspark.llm.pretokens import hashed, mixed, slices
from clearspark.llm.wordspans import byte_set, word_spans
from clearspark.session import landed

_CUT = byte_set(b".,;:!?\x0a\x0b\x0c\x0d")
_SOLID = ~(_CUT | byte_set(b"\x20\x09"))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Words of a phrase at most.
LONGEST = 3
#: Bytes handled as one array, and fingerprints gathered before a task sends their counts.
SLICE, GATHERED = 1 << 19, 1 << 21
#: Occurrences that one hash partition is laid out for, the most partitions, and what a summary keeps at least.
MASS, PARTITIONS, CAPACITY = 1 << 21, 1 << 16, 1 << 19
#: Bits of the filter of survivors: for each of them, and at most in all. It only saves work.
BITS_EACH, MOST_BITS = 16, 1 << 28
#: Copies of a part's count, so that the phrases of a frequent word spread over as many tasks.
SPREAD = 16
_MULTIPLIERS = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]


class Grams:
    """The words of neighbouring texts and the phrases of each size among them."""

    def __init__(self, data: np.ndarray, edges: np.ndarray, seeds: np.ndarray):
        self.symbols = _LOWER[data]
        cut = _CUT[data]
        self.starts, self.ends = word_spans(_SOLID[data], edges)
        self.texts = np.searchsorted(edges, self.starts, "right") - 1
        piece = np.cumsum(cut)[self.starts] if len(data) else self.starts
        joined = (piece[1:] == piece[:-1]) & (self.texts[1:] == self.texts[:-1])
        self.tight = self.starts[1:] - self.ends[:-1] == 1
        if len(data):
            self.tight &= data[self.ends[:-1]] == 0x20
        words = hashed(self.symbols, self.starts, self.ends) ^ seeds[self.texts]
        self.firsts, self.keys = [], []
        for size in range(1, LONGEST + 1):
            fits = np.ones(max(0, len(words) - size + 1), bool)
            for k in range(size - 1):
                fits &= joined[k : k + len(fits)]
            at = np.flatnonzero(fits)
            total = np.full(len(at), size, np.uint64)
            with np.errstate(over="ignore"):
                for k in range(size):
                    total += mixed(words[at + k] * _MULTIPLIERS[k])
            self.firsts.append(at)
            self.keys.append(mixed(total))

    def spelled(self, size: int, at: np.ndarray) -> list[bytes]:
        """The phrases of `size` words from each of the words `at` on, joined by one space."""
        data = self.symbols.tobytes()
        tight = np.ones(len(at), bool)
        for k in range(size - 1):
            tight &= self.tight[at + k]
        spans = zip(tight.tolist(), self.starts[at].tolist(), self.ends[at + size - 1].tolist(), at.tolist(), strict=True)
        return [
            data[a:b] if whole else b" ".join(data[x:y] for x, y in zip(self.starts[i : i + size].tolist(), self.ends[i : i + size].tolist(), strict=True))
            for whole, a, b, i in spans
        ]


def grams(batches):
    """(languages of the texts, Grams) for slices of batches of (language, text)."""
    for batch in batches:
        langs, texts = batch.column(0), batch.column(1)
        data, offsets = raw(texts)
        if not len(offsets) > 1:
            continue
        coded = langs.dictionary_encode()
        listed = coded.dictionary.to_pylist()
        seeds = _seeds(listed) if listed else np.zeros(0, np.uint64)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        for a, b in slices(np.diff(offsets).tolist(), SLICE):
            part = Grams(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], seeds[codes[a:b]])
            yield listed, codes[a:b], part


def _seeds(listed: list[str]) -> np.ndarray:
    spelled = [t.encode() for t in listed]
    ends = np.cumsum([len(t) for t in spelled])
    starts = np.append(0, ends[:-1]).astype(np.int64)
    return mixed(hashed(np.frombuffer(b"".join(spelled), np.uint8), starts, ends))


def merged(keys: list[np.ndarray], counts: list[np.ndarray], capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The Misra-Gries summary of all of them: at most `capacity` keys with their counts, and what was taken off each."""
    unique, which = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(which, np.concatenate(counts), len(unique)).astype(np.int64)
    if len(unique) <= capacity:
        return unique, total, 0
    off = int(np.partition(total, len(total) - capacity - 1)[len(total) - capacity - 1])
    stays = total > off
    return unique[stays], total[stays] - off, off


def survivors(rows: DataFrame, partitions: int, threshold: int) -> DataFrame:
    """(part, keys): the fingerprints that a summary of each hash partition keeps, none lost at the threshold."""
    shift = np.uint64(64 - int(math.log2(partitions)))

    def counted(batches):
        gathered, size = [], 0
        for _, _, part in grams(batches):
            gathered += part.keys
            size += sum(len(k) for k in part.keys)
            if size >= GATHERED:
                yield sent(gathered)
                gathered, size = [], 0
        if size:
            yield sent(gathered)

    def sent(gathered):
        keys, n = np.unique(np.concatenate(gathered), return_counts=True)
        parts = (keys >> shift).astype(np.int64) if partitions > 1 else np.zeros(len(keys), np.int64)
        low = (keys & np.uint64(0xFFFFFFFF)).astype("<u4")
        # One byte a count; a larger one repeats its key.
        times = -(-n // 255)
        parts, low = np.repeat(parts, times), np.repeat(low, times)
        last = np.cumsum(times) - 1
        ones = np.full(len(low), 255, np.uint8)
        ones[last] = (n - 255 * (times - 1)).astype(np.uint8)
        listed, first = np.unique(parts, return_index=True)
        ends = np.append(first[1:], len(parts)).tolist()
        spans = list(zip(first.tolist(), ends, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(listed), pa.array([low[a:b].tobytes() for a, b in spans]), pa.array([ones[a:b].tobytes() for a, b in spans])],
            names=["part", "keys", "counts"],
        )

    def summed(sent: pd.DataFrame) -> pd.DataFrame:
        mass = sum(int(np.frombuffer(c, np.uint8).sum(dtype=np.int64)) for c in sent["counts"])
        capacity = max(CAPACITY, mass // threshold + 1)
        keys, counts = [], []
        size = off = 0
        for k, c in zip(sent["keys"], sent["counts"], strict=True):
            keys.append(np.frombuffer(k, "<u4")), counts.append(np.frombuffer(c, np.uint8).astype(np.int64))
            size += len(keys[-1])
            if size > 2 * capacity:
                own, total, less = merged(keys, counts, capacity)
                keys, counts, size, off = [own], [total], len(own), off + less
        own, total, less = merged(keys, counts, capacity)
        own = own[total + off + less >= threshold]
        return pd.DataFrame({"part": [int(sent["part"].iloc[0])], "n": [len(own)], "keys": [own.astype("<u4").tobytes()]})

    sent_rows = rows.mapInArrow(counted, "part bigint, keys binary, counts binary")
    return sent_rows.groupBy("part").applyInPandas(summed, "part bigint, n bigint, keys binary")


def survivor_filter(kept: DataFrame, partitions: int) -> np.ndarray:
    """Bits by partition and fingerprint, two for each survivor; at most MOST_BITS in all."""
    total = kept.agg(F.sum("n")).first()[0] or 0
    bits = min(MOST_BITS, 1 << max(3, math.ceil(math.log2(BITS_EACH * total + 1))))
    each = max(8, bits // partitions)

    def marked(batches):
        for batch in batches:
            out = []
            for keys in batch.column(1).to_pylist():
                own = np.zeros(each, bool)
                for at in probes(np.frombuffer(keys, "<u4"), each):
                    own[at] = True
                out.append(np.packbits(own).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["part", "bits"])

    filled = np.zeros((partitions, each // 8), np.uint8)
    for row in kept.select("part", "keys").mapInArrow(marked, "part bigint, bits binary").toLocalIterator():
        filled[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return filled


def probes(low: np.ndarray, each: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of a fingerprint among `each` (a power of two)."""
    spread = mixed(low.astype(np.uint64))
    return (spread & np.uint64(each - 1)).astype(np.int64), ((spread >> np.uint64(32)) & np.uint64(each - 1)).astype(np.int64)


def exact_counts(rows: DataFrame, filled: np.ndarray) -> DataFrame:
    """(lang, size, phrase, n): exact counts of the phrases that pass the filter; size 0 counts all words of a language."""
    partitions, each = filled.shape[0], filled.shape[1] * 8
    shift = np.uint64(64 - int(math.log2(partitions)))
    sent = rows.sparkSession.sparkContext.broadcast(filled)

    def counted(batches):
        bits, gathered, size = sent.value, [], 0
        for listed, codes, part in grams(batches):
            n = np.bincount(codes[part.texts], minlength=len(listed))
            own = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for at, keys in zip(part.firsts, part.keys, strict=True):
                places = (keys >> shift).astype(np.int64) if partitions > 1 else np.zeros(len(keys), np.int64)
                stays = np.ones(len(keys), bool)
                for probe in probes(keys & np.uint64(0xFFFFFFFF), each):
                    stays &= (bits[places, probe >> 3] >> (7 - (probe & 7)).astype(np.uint8)) & 1 == 1
                unique, first, times = np.unique(keys[stays], return_index=True, return_counts=True)
                own.append((unique, at[stays][first], times))
                size += len(keys)
            gathered.append((listed, codes, part, n, own))
            if size >= GATHERED:
                yield summed(gathered)
                gathered, size = [], 0
        if gathered:
            yield summed(gathered)

    def summed(gathered):
        langs, sizes, phrases, counts = [], [], [], []
        for listed, _, _, n, _ in gathered:
            for code in np.flatnonzero(n).tolist():
                langs.append(listed[code]), sizes.append(0), phrases.append(b""), counts.append(int(n[code]))
        for words in range(1, LONGEST + 1):
            found = [own[words] for *_, own in gathered]
            edges = np.cumsum([0, *(len(keys) for keys, _, _ in found)])
            unique, first, which = np.unique(np.concatenate([f[0] for f in found]), return_index=True, return_inverse=True)
            total = np.bincount(which, np.concatenate([f[2] for f in found]), len(unique)).astype(np.int64)
            # Spelled by the slice that has a phrase first.
            source = np.searchsorted(edges, first, "right") - 1
            for k, (listed, codes, part, _, _) in enumerate(gathered):
                mine = np.flatnonzero(source == k)
                at = found[k][1][first[mine] - edges[k]]
                langs += [listed[c] for c in codes[part.texts[at]].tolist()]
                sizes += [words] * len(mine)
                phrases += part.spelled(words, at)
                counts += total[mine].tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(sizes, pa.int32()), pa.array(phrases, pa.string()), pa.array(counts, pa.int64())],
            names=["lang", "size", "phrase", "n"],
        )

    found = rows.mapInArrow(counted, "lang string, size int, phrase string, n bigint")
    return found.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def frequent(docs: DataFrame, threshold: int, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, size, phrase, n): all words and phrases with at least `threshold` occurrences, and all words of each language as size 0."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # A word takes two bytes with what parts it from the next, and begins as many phrases as there are sizes.
    most = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) * LONGEST // 2
    partitions = min(PARTITIONS, 1 << math.ceil(math.log2(max(1, most / MASS))))
    kept = landed(survivors(rows, partitions, threshold), "survivors")
    counts = exact_counts(rows, survivor_filter(kept, partitions))
    return landed(counts.filter((F.col("n") >= threshold) | (F.col("size") == 0)), "phrase-counts")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", threshold: int = 10, most: int = 2000, inside: int = 50) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of 2 to 3 words.

    Words are lower-cased (A-Z), parted by spaces and tabs, and phrases end at `.,;:!?` and
    line ends. a is the phrase's count, at least `threshold`; l and r are those of the two
    parts of the cut with the least score floor(1000000*a*a/(l*r)), the first one of ties; n
    counts all words of the language. A phrase inside a longer one that has `inside` percent
    of its count or more is left out. Ranks go by score, a, phrase; `most` is the
    report's length. Null languages are `und`; null, empty and white texts have no
    words; repeated rows count as often as they stand. No rows give no phrases.
    """
    counts = frequent(docs, threshold, text, lang)
    words = F.split("phrase", " ")
    candidates = counts.filter("size > 1").withColumnRenamed("n", "a")
    cuts = F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.struct(
        k.alias("k"),
        F.array_join(F.slice(words, F.lit(1), k), " ").alias("first"),
        F.array_join(F.slice(words, k + 1, F.col("size") - k), " ").alias("rest"),
    ))
    cut = candidates.select("lang", "size", "phrase", "a", F.explode(cuts).alias("cut"))
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("cut.first").alias("part")), F.struct(F.lit(1).alias("side"), F.col("cut.rest").alias("part"))))
    asked = cut.select("lang", "size", "phrase", "a", F.col("cut.k").alias("k"), sides.alias("s"))
    asked = asked.select("lang", "size", "phrase", "a", "k", "s.side", "s.part", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD)).alias("copy"))
    parts = counts.filter((F.col("size") > 0) & (F.col("size") < LONGEST)).select(
        "lang", F.col("phrase").alias("part"), F.col("n").alias("f"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SPREAD - 1).cast("bigint"))).alias("copy")
    )
    met = asked.join(parts, ["lang", "part", "copy"])
    both = met.groupBy("lang", "size", "phrase", "a", "k").agg(
        F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r")
    )
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    share = F.expr("(cast(a AS decimal(19,0)) * cast(a AS decimal(19,0)) * 1000000BD) div (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))")
    scored = both.withColumn("score", share)
    least = scored.groupBy("lang", "size", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("least"))
    outer = candidates.filter(F.col("size") > 2)
    shorter = F.transform(F.sequence(F.lit(1), F.lit(2)), lambda i: F.array_join(F.slice(words, i, F.col("size") - 1), " "))
    covering = outer.select("lang", F.explode(shorter).alias("phrase"), F.col("a").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    free = least.join(covering, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.lit(100).cast("decimal(3,0)") * exact("longer") < F.lit(inside).cast("decimal(3,0)") * exact("a"))
    )
    rows = free.select("lang", "phrase", "a", "least.l", "least.r", "least.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of each share of a language first, so that no task sorts a whole language.
    near = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    rows = rows.withColumn("_near", F.row_number().over(near)).filter(F.col("_near") <= most).drop("_near")
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    rows = rows.filter(F.col("rank") <= most)
    totals = counts.filter("size = 0").select("lang", "n")
    return rows.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
