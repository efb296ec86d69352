"""Language model scores by a probabilistic suffix tree.

The tree predicts a word's bytes and its end from the longest state that is a suffix of
what precedes them in the text, up to `DEPTH` bytes across the words before, which one edge
parts, and with `DEPTH` edges as the text's beginning.
A context becomes a state when its next bytes diverge from those of its own suffix by more
than their number and weight explain; distributions are smoothed with the suffix's. All
counts are gathered over all training texts, distributed and pre-aggregated. The tree is a
table of all states; each distinct byte with its context is scored once, beside the states
that end in the same three bytes. What is sent to the tasks only saves joins and is bounded: the
scores of at most `often` of these and the counts of at most `frequent` words; all others are
joined.
"""

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from clearspark.llm.backoff import Backoff, find
from clearspark.llm.bytewords import ByteWords, sliced
from clearspark.llm.pretokens import hashed_rows
from clearspark.llm.wordspans import byte_set
from clearspark.session import landed

_SOLID = ~byte_set(b"\x20\x09\x0a\x0b\x0c\x0d")
DEPTH = 6
EDGE = 32
#: The weight a context needs before its divergence is tested.
WEIGHT = 12
SYMBOLS = 257
#: Bytes that a task counts at once, and distinct bytes with contexts that one group scores.
GATHERED, GROUP = 1 << 23, 1 << 18


@dataclass
class Model:
    """Counts of all training tokens (a table), their sums, and the next bytes of the tree's states (a table)."""

    counts: DataFrame
    tokens: int
    distinct: int
    texts: int
    edges: DataFrame
    grams: DataFrame
    common: tuple[np.ndarray, np.ndarray]
    common_from: int
    often: int

    @cached_property
    def tree(self) -> Backoff:
        """The whole tree in memory, to look into a small one; `score` does not use it."""
        return tree(self.edges.toPandas())


def word_counts(texts: DataFrame, text: str) -> DataFrame:
    """(h, word, n): every distinct token and its count; the empty word is a text's end."""

    def counted(batches):
        held: list[tuple] = []
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([0], pa.int64()), pa.array([b""], pa.binary()), pa.array([batch.num_rows], pa.int64())], names=names
            )
            for _, _, words in sliced(batch.column(0)):
                held.append((*np.unique(words.hashes, return_index=True, return_counts=True), words))
                if len(held) == 8:
                    yield summed(held)
                    held.clear()
        if held:
            yield summed(held)

    def summed(held):
        edges = np.cumsum([0, *(len(h[0]) for h in held)])
        new, first, which = np.unique(np.concatenate([h[0] for h in held]), return_index=True, return_inverse=True)
        n = np.bincount(which, np.concatenate([h[2] for h in held]), len(new)).astype(np.int64)
        source = np.searchsorted(edges, first, "right") - 1
        spelled: list[bytes] = [b""] * len(new)
        for k, (_, places, _, words) in enumerate(held):
            mine = np.flatnonzero(source == k)
            at, data = places[first[mine] - edges[k]], words.symbols.tobytes()
            for i, a, b in zip(mine.tolist(), words.starts[at].tolist(), words.ends[at].tolist(), strict=True):
                spelled[i] = data[a:b]
        return pa.RecordBatch.from_arrays([pa.array(new.view(np.int64)), pa.array(spelled, pa.binary()), pa.array(n)], names=names)

    names = ["h", "word", "n"]
    content = texts.select(F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = content.mapInArrow(counted, "h bigint, word binary, n bigint")
    return rows.groupBy("h", "word").agg(F.sum("n").alias("n"))


class Slots:
    """Values of 64-bit keys by hashed place: nearly all lie in their first slot, a look instead of a search."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys)).bit_length() + 1)
        self.levels = []
        for level in range(3):
            shift = np.uint64(64 - max(4, bits - 3 * level))
            held = np.zeros(1 << int(64 - shift), np.uint64)
            logs = np.full(len(held), np.nan, np.float32)
            at = self._place(keys, level, shift)
            held[at], logs[at] = keys, values
            lost = held[at] != keys
            self.levels.append((shift, held, logs))
            keys, values = keys[lost], values[lost]
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    @staticmethod
    def _place(keys: np.ndarray, level: int, shift: np.uint64) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys + np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, NaN where it has none."""
        out, rest = np.full(len(keys), np.nan, np.float32), None
        for level, (shift, held, logs) in enumerate(self.levels):
            own = keys if rest is None else keys[rest]
            at = self._place(own, level, shift)
            hit = held[at] == own
            if rest is None:
                out = np.where(hit, logs[at], out)
                rest = np.flatnonzero(~hit)
            else:
                out[rest[hit]] = logs[at][hit]
                rest = rest[~hit]
            if not len(rest):
                return out
        if len(self.keys):
            at = find(self.keys, keys[rest])
            out[rest] = np.where(at >= 0, self.values[at], out[rest])
        return out


def bounded_from(rows: DataFrame, measure: Column, most: int) -> float:
    """A threshold of a positive measure that at most `most` rows reach."""
    step = F.floor(F.log2(measure) * 8)
    found = rows.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    total, least = 0, None
    for row in found:
        total += row["count"]
        if total > most:
            break
        least = row["step"]
    return float("inf") if least is None else 2.0 ** (least / 8)


def long_contexts(texts: DataFrame, text: str) -> DataFrame:
    """(gram, n): each predicted byte with the DEPTH bytes before it, packed, and how often the texts have it."""

    def cut(batches):
        held: list[np.ndarray] = []
        for batch in batches:
            for _, _, words in sliced(batch.column(0)):
                held.append(packed(words)[0])
                if sum(map(len, held)) >= GATHERED:
                    yield counted(held)
                    held.clear()
        if held:
            yield counted(held)

    def counted(held):
        grams, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(n)], names=["gram", "n"])

    content = texts.select(F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return content.mapInArrow(cut, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def packed(words: ByteWords) -> tuple[np.ndarray, np.ndarray]:
    """Each word's bytes and its end with the DEPTH bytes before each, 8 bits a byte, the last one lowest; the first of each text.

    The bytes before run over the words before, one edge after each; edges fill what a text's beginning leaves.
    """
    sizes = words.ends - words.starts
    before = np.zeros(len(sizes), np.int64)
    before[words.firsts[:-1][np.diff(words.firsts) > 0]] = DEPTH
    starts = np.cumsum(before + sizes + 1) - sizes - 1
    total = int((before + sizes + 1).sum())
    symbols = np.full(total, EDGE, np.uint64)
    solid = words.symbols[_SOLID[words.symbols]]
    symbols[np.arange(len(solid)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)] = solid
    predicted = np.ones(total, bool)
    for k in range(1, DEPTH + 1):
        predicted[(starts - k)[before >= k]] = False
    # Two bytes from one, four from two, and so on; the text's first edges are predicted nowhere.
    out, have = symbols, 1
    while have <= DEPTH:
        step = min(have, DEPTH + 1 - have)
        wider = out.copy()
        # What overlaps is the same byte twice.
        wider[step:] |= out[:-step] << np.uint64(8 * step)
        out, have = wider, have + step
    out = out[predicted] & np.uint64((1 << (8 * (DEPTH + 1))) - 1)
    ends = np.append(0, np.cumsum(sizes + 1))
    return out, ends[words.firsts]


def shorter(size: int, packed_bytes: Column) -> Column:
    """The last `size` bytes of packed ones."""
    return packed_bytes.bitwiseAND((1 << (8 * size)) - 1)


def nodes_of(edges: DataFrame) -> DataFrame:
    """(context, total, kinds, ns): each context's count, and the counts of its next bytes, at most 256."""
    own = F.map_from_entries(F.collect_list(F.struct("byte", "n")))
    return edges.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), own.alias("ns"))


def states(grams: DataFrame) -> DataFrame:
    """(size, context, byte, n): next bytes of all contexts that pass the divergence test, suffix-closed.

    The counts of a size come from those of the next larger one, so each step has fewer rows.
    Only contexts of some weight are compared with their suffix, which weighs no less.
    """
    byte = F.col("gram").bitwiseAND(255).cast("int").alias("byte")
    edges = grams.select(F.shiftright("gram", 8).alias("context"), byte, "n")
    nodes, root = {}, None
    for size in range(DEPTH, -1, -1):
        if size < DEPTH:
            edges = edges.groupBy(shorter(size, F.col("context")).alias("context"), "byte").agg(F.sum("n").alias("n"))
            edges = landed(edges, "edges")
        nodes[size] = landed(nodes_of(edges).filter(F.col("total") >= WEIGHT), "nodes")
        root = edges
    kept, out = None, root.select(F.lit(0).alias("size"), "context", "byte", "n")
    for size in range(DEPTH, 0, -1):
        suffix = shorter(size - 1, F.col("context")).alias("suffix")
        child = nodes[size].select("*", suffix)
        parent = nodes[size - 1].select(F.col("context").alias("suffix"), F.col("total").alias("up_total"), F.col("ns").alias("up"))
        gain = F.aggregate(
            F.map_entries("ns"),
            F.lit(0.0),
            lambda total, own: total + own["value"] * F.log((own["value"] / F.col("total")) / (F.element_at("up", own["key"]) / F.col("up_total"))),
        )
        passed = child.join(parent, "suffix").filter(gain > F.lit(0.5) * F.col("kinds") * F.log("total")).select("context")
        if kept is not None:
            passed = passed.union(kept.select(shorter(size, F.col("context")).alias("context"))).distinct()
        kept = landed(passed, "kept")
        own = nodes[size].join(kept, "context")
        out = out.unionByName(own.select(F.lit(size).alias("size"), "context", F.explode("ns").alias("byte", "n")))
    return out


def _smoothed(found: Column, total: Column, kinds: Column, lower: Column) -> Column:
    return (found + kinds * lower) / (total + kinds)


def chances(grams: DataFrame, edges: DataFrame) -> DataFrame:
    """(gram, n, log): the log10 probability of each gram's byte after its context.

    From the empty context up, a state smooths its counts with its suffix's probability and
    any other context has its suffix's. Up to two bytes of context that is done for the
    distinct last four bytes of the grams; there are at most 257 shorter contexts. Grams then
    meet all longer states by the last three bytes of their contexts, in groups of bounded size.
    """
    ends = grams.select(shorter(4, F.col("gram")).alias("end")).distinct()
    lower = F.lit(1 / SYMBOLS)
    rows = ends.select("end", F.col("end").bitwiseAND(255).cast("int").alias("byte"), lower.alias("lower"))
    for size in range(3):
        own = nodes_of(edges.filter(F.col("size") == size))
        own = own.withColumn("kinds", F.col("kinds").cast("double"))
        rows = rows.withColumn("context", shorter(size, F.shiftright("end", 8)))
        rows = rows.join(F.broadcast(own) if size < 2 else own, "context", "left")
        seen = F.coalesce(F.try_element_at("ns", F.col("byte")), F.lit(0))
        value = F.coalesce(_smoothed(seen, F.col("total"), F.col("kinds"), F.col("lower")), F.col("lower"))
        rows = rows.select("end", "byte", value.alias("lower"))
    last = lambda packed_bytes: shorter(3, packed_bytes)
    longer = edges.filter("size >= 3")
    side = longer.select(last(F.col("context")).alias("end3"), "size", F.col("context").alias("gram"), "byte", "n", F.lit(0.0).alias("lower"))
    side = side.unionByName(rows.select(F.shiftright("end", 8).alias("end3"), F.lit(-1).alias("size"), F.col("end").alias("gram"), "byte", F.lit(0).cast("bigint").alias("n"), "lower"))
    asked = grams.withColumn("end3", last(F.shiftright("gram", 8)))
    crowds = asked.groupBy("end3").count()
    groups = max(1, -(-(crowds.agg(F.sum("count")).first()[0] or 0) // GROUP))
    # An end that many grams share is asked in several groups, each with its states.
    hot = landed(crowds.filter(F.col("count") > GROUP).select("end3", F.ceil(F.col("count") / GROUP).cast("bigint").alias("parts")), "crowds")
    asked = asked.join(hot, "end3", "left").withColumn("part", F.pmod(F.xxhash64("gram"), F.coalesce("parts", F.lit(1))))
    side = side.join(hot, "end3", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("parts", F.lit(1)) - 1)))
    group = F.pmod(F.xxhash64("end3", "part"), F.lit(groups)).alias("grp")
    asked, side = asked.select(group, "gram", "n"), side.select(group, "size", "gram", "byte", "n", "lower")
    return asked.groupBy("grp").cogroup(side.groupBy("grp")).applyInPandas(_logs, "gram bigint, n bigint, log double")


def _logs(asked: pd.DataFrame, side: pd.DataFrame) -> pd.DataFrame:
    grams = asked["gram"].to_numpy(np.int64)
    byte, context = grams & 255, grams >> 8
    size, packed_bytes, n = side["size"].to_numpy(), side["gram"].to_numpy(np.int64), side["n"].to_numpy(np.int64)
    ends = size < 0
    keys, first = np.unique(packed_bytes[ends], return_index=True)
    if not len(grams):
        return pd.DataFrame({"gram": grams, "n": grams, "log": np.zeros(0)})
    chance = side["lower"].to_numpy(np.float64)[ends][first][np.searchsorted(keys, grams & 0xFFFFFFFF)]
    for k in range(3, DEPTH + 1):
        own = size == k
        if not own.any():
            continue
        edges = (packed_bytes[own] << 8) | side["byte"].to_numpy(np.int64)[own]
        # Several groups' states may stand here twice: a hot end's parts can share a group.
        edges, first = np.unique(edges, return_index=True)
        counts = n[own][first]
        listed, which = np.unique(edges >> 8, return_inverse=True)
        total, kinds = np.bincount(which, counts), np.bincount(which)
        short = context & ((1 << (8 * k)) - 1)
        state = find(listed, short)
        at = find(edges, (short << 8) | byte)
        seen = np.where(at >= 0, counts[at], 0)
        chance = np.where(state >= 0, (seen + kinds[state] * chance) / (total[state] + kinds[state]), chance)
    return pd.DataFrame({"gram": grams, "n": asked["n"].to_numpy(np.int64), "log": np.log10(chance)})


def tree(edges: pd.DataFrame) -> Backoff:
    """Smoothed log probabilities of the states' next bytes, in sorted hash arrays."""
    size, context = edges["size"].to_numpy(np.int64), edges["context"].to_numpy(np.int64).astype(np.uint64)
    byte, n = edges["byte"].to_numpy(np.uint32), edges["n"].to_numpy(float)
    grams, contexts = np.zeros(len(edges), np.uint64), np.zeros(len(edges), np.uint64)
    chance, weight = np.zeros(len(edges)), np.zeros(len(edges))
    known, values = np.zeros(0, np.uint64), np.zeros(0)
    for k in range(DEPTH + 1):
        rows = np.flatnonzero(size == k)
        if not len(rows):
            continue
        symbols = np.zeros((len(rows), k + 1), np.uint8)
        for i in range(k):
            symbols[:, i] = (context[rows] >> np.uint64(8 * (k - 1 - i))) & np.uint64(255)
        symbols[:, k] = byte[rows]
        grams[rows], contexts[rows] = hashed_rows(symbols), hashed_rows(symbols[:, :k])
        lower = np.full(len(rows), 1 / SYMBOLS)
        if k:
            lower = values[find(known, hashed_rows(symbols[:, 1:]))]
        _, which = np.unique(contexts[rows], return_inverse=True)
        total, kinds = np.bincount(which, n[rows])[which], np.bincount(which)[which]
        chance[rows] = (n[rows] + kinds * lower) / (total + kinds)
        weight[rows] = kinds / (total + kinds)
        order = np.argsort(grams[rows])
        known, values = grams[rows][order], chance[rows][order]
    order = np.argsort(grams)
    listed, first = np.unique(contexts, return_index=True)
    logs = np.log10(chance[order]).astype(np.float32)[:, None]
    weights = np.log10(weight[first]).astype(np.float32)[:, None]
    return Backoff(DEPTH + 1, grams[order], logs, listed, weights, np.array([-np.log10(SYMBOLS)]))


def fit(texts: DataFrame, text: str = "text", frequent: int = 1 << 19, often: int = 1 << 21) -> Model:
    """The model of all rows' whole texts; null texts are empty ones. No rows: no counts, every byte alike."""
    counts = landed(word_counts(texts, text), "word-counts")
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v"), F.sum(F.when(F.length("word") == 0, F.col("n"))).alias("t")).first()
    least = bounded_from(counts.filter("n > 0"), F.col("n"), frequent)
    own = counts.filter((F.col("n") >= least) & (F.length("word") > 0)).select("h", "n").toPandas()
    h, n = own["h"].to_numpy(np.int64).view(np.uint64), own["n"].to_numpy(np.int64)
    order = np.argsort(h)
    grams = landed(long_contexts(texts, text), "long-contexts")
    edges = landed(states(grams), "states")
    return Model(counts, sums["n"] or 0, sums["v"] or 0, sums["t"] or 0, edges, grams, (h[order], n[order]), least, often)


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text", trained: Column | None = None) -> DataFrame:
    """The columns `keep` with n_tokens, n_known, train_tokens, base_score and score.

    A text's tokens are its words and one end. `base_score` is the sum of log10
    ((c+1)/(N+V+1)) over them with the training counts c; `score` is the tree's log10
    probability of the text, whose end comes after a word with the training share of ends.
    Null and empty texts are an end alone. Rows stay as they are, repeated ones too. With
    `trained` telling which rows the model was fitted on, theirs need not be counted again.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    if trained is None:
        grams = long_contexts(docs.select(content.alias("_text")), "_text")
    else:
        other = long_contexts(docs.filter(~trained).select(content.alias("_text")), "_text")
        grams = model.grams.unionByName(other).groupBy("gram").agg(F.sum("n").alias("n"))
    logs = landed(chances(landed(grams, "long-contexts"), model.edges), "chances")
    often = bounded_from(logs, F.col("n"), model.often)
    own = logs.filter(F.col("n") >= often).select("gram", F.col("log").cast("float").alias("log")).toArrow()
    best = own.column(0).to_numpy().view(np.uint64), own.column(1).to_numpy()
    del own
    sent = docs.sparkSession.sparkContext.broadcast((best, model.common))
    below = np.log10(model.tokens + model.distinct + 1)
    ends = (model.texts + 1) / (model.tokens + 2)
    stop, go = np.log10(ends), np.log10(1 - ends) if ends < 1 else -np.inf
    end_count, kept = model.texts, len(keep)

    def scored(batches):
        best, (common, counts) = sent.value
        slots = Slots(*best)
        # Places up to 2^24 are exact.
        listed_at = Slots(common, np.arange(len(common), dtype=np.float32))
        weights = np.log10(counts + 1.0) - below
        serial = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = batch.num_rows
            tokens, known = np.ones(rows, np.int64), np.full(rows, int(end_count > 0), np.int64)
            base, value = np.full(rows, np.log10(end_count + 1) - below), np.full(rows, stop)
            rare: list[np.ndarray] = [np.zeros(0, np.int64)] * rows
            unlisted: list[np.ndarray] = [np.zeros(0, np.int64)] * rows
            for a, b, words in sliced(batch.column(kept)):
                at = listed_at.of(words.hashes)
                listed = ~np.isnan(at)
                shares = np.zeros(len(at))
                shares[listed] = weights[at[listed].astype(np.int64)]
                spelled, starts = packed(words)
                logs = slots.of(spelled).astype(np.float64)
                unsent = np.isnan(logs)
                logs[unsent] = 0.0
                tokens[a:b] += np.diff(words.firsts)
                value[a:b] += np.diff(words.firsts) * go
                for sums, part, firsts in ((known, listed, words.firsts), (base, shares, words.firsts), (value, logs, starts)):
                    sums[a:b] += _sums(part, firsts)
                for lists, left, missed, firsts in ((rare, words.hashes, ~listed, words.firsts), (unlisted, spelled, unsent, starts)):
                    others = np.flatnonzero(missed)
                    edges = np.searchsorted(others, firsts)
                    left = left[others].view(np.int64)
                    for k in range(b - a):
                        lists[a + k] = left[edges[k] : edges[k + 1]]
            columns = [pa.array(np.arange(serial, serial + rows)), pa.array(tokens), pa.array(known), pa.array(base), pa.array(value)]
            serial += rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:kept], *columns, _lists(rare), _lists(unlisted)], names=[*keep, *names]
            )

    names = ["serial", "n_tokens", "known", "base", "score", "rare", "unlisted"]
    schema = docs.select(*keep).schema
    for name, kind in zip(names, ("long", "long", "long", "double", "double", ArrayType(LongType()), ArrayType(LongType())), strict=True):
        schema = schema.add(name, kind)
    rows = docs.select(*keep, content.alias("_text"))
    rows = landed(rows.mapInArrow(scored, schema), "scored")
    rest = rows.select("serial", F.explode("rare").alias("h"))
    uncommon = model.counts.filter((F.col("n") < model.common_from) & (F.length("word") > 0)).select("h", F.col("n").alias("c"))
    share = F.log10(F.coalesce(F.col("c"), F.lit(0)) + 1) - F.lit(float(below))
    added = rest.join(uncommon, "h", "left").groupBy("serial").agg(F.count("c").alias("_known"), F.sum(share).alias("_base"))
    others = rows.select("serial", F.explode("unlisted").alias("gram")).join(logs.filter(F.col("n") < often).select("gram", "log"), "gram")
    others = others.groupBy("serial").agg(F.sum("log").alias("_score"))
    total = rows.drop("rare", "unlisted").join(added, "serial", "left").join(others, "serial", "left")
    return total.select(
        *keep,
        "n_tokens",
        (F.col("known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(int(model.tokens)).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("_score", F.lit(0.0))).alias("score"),
    )


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    sizes = np.append(0, np.cumsum([len(r) for r in parts])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64)))


def _sums(part: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sums of the stretches between neighbouring `firsts`."""
    total = np.zeros(len(part) + 1, np.int64 if part.dtype == bool else np.float64)
    np.cumsum(part, out=total[1:])
    return np.diff(total[firsts])
