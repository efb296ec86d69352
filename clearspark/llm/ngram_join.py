"""Near-duplicates by an exact Jaccard join of word n-gram sets with prefix trees.

Documents with one set of shingles are one class. Under a global order, rare shingles
first, two alike sets share a known number of their first members (the prefix bound), so a
class that shares fewer with all others together is like none. The rest meet in the group
of the smallest class that has a shared member, so a class goes to few groups whatever the
length of its prefix. A group is dealt into blocks of bounded size, its first class in
each, and every block is joined with itself by a trie. What a block does not connect to
that class is then held against the other blocks of its group, in tries again. Links are found only between sets that are not connected already;
their components are those of all links.

Shingles are 64-bit hashes. The global order needs the shingles that many classes share:
tasks report what recurs within them, and at most `common` of the most frequent ones are
sent out; any other shingle comes before those, by its hash. The order decides the work,
never the result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from clearspark.llm.bytewords import ByteWords, sliced
from clearspark.llm.components import components
from clearspark.llm.prefix_tree import Threshold, forest
from clearspark.llm.pretokens import mixed
from clearspark.llm.suffix_tree import bounded_from
from clearspark.session import landed

#: Shingles of a stretch that report their own repetitions, and how often they must recur.
BUFFER, RECUR = 1 << 21, 4
#: Bits of the filter of classes that have a partner; what passes by chance is left out later.
FILTER_BITS = 23
_STEPS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def shingles_of(words: np.ndarray, width: int) -> np.ndarray:
    """The hash of each stretch of `width` word hashes."""
    total = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            step = np.uint64(pow(_STEPS[0], k + 1, 1 << 64) | 1)
            total += mixed(words[k : k + len(total)] * step + np.uint64(k))
        return mixed(total)


def short_shingle(columns: list[np.ndarray]) -> np.ndarray:
    """The hash of each row of fewer word hashes than a shingle has, given by columns."""
    short = np.full(len(columns[0]), len(columns), np.uint64)
    with np.errstate(over="ignore"):
        for column in columns:
            short = mixed(short * np.uint64(_STEPS[1]) + column)
    return short


def shingle_sets(words: ByteWords, width: int) -> list[np.ndarray]:
    """The ascending distinct shingle hashes of each text; a shorter text is one shingle, one without words none."""
    counts, h = np.diff(words.firsts), words.hashes
    shingles = shingles_of(h, width)
    out = []
    for first, n in zip(words.firsts[:-1].tolist(), counts.tolist(), strict=True):
        if n >= width:
            out.append(np.unique(shingles[first : first + n - width + 1]))
        elif n:
            out.append(short_shingle([h[first + k : first + k + 1] for k in range(n)]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def class_of(shingles: np.ndarray) -> int:
    """A 64-bit name of a set, the same in any task."""
    with np.errstate(over="ignore"):
        total = shingles.sum(dtype=np.uint64) * np.uint64(_STEPS[2])
        both = total ^ np.bitwise_xor.reduce(mixed(shingles ^ np.uint64(_STEPS[3])), initial=np.uint64(len(shingles)))
    return int(mixed(np.array([both], np.uint64)).view(np.int64)[0])


def _texts(docs: DataFrame, text: str, *columns) -> DataFrame:
    return docs.select(*columns, F.coalesce(F.col(text), F.lit("")).alias("_text"))


def profiles(docs: DataFrame, key: str, text: str, width: int) -> tuple[DataFrame, DataFrame]:
    """(key, n, class) of every row, and (token, n) of shingles that recur within a task's stretch of classes."""

    def profiled(batches):
        seen: set[int] = set()
        kept, held = [], 0
        for batch in batches:
            n, names = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for a, b, words in sliced(batch.column(1)):
                for i, s in enumerate(shingle_sets(words, width), a):
                    n[i], names[i] = len(s), class_of(s)
                    if len(s) and names[i] not in seen:
                        seen.add(int(names[i]))
                        kept.append(s)
                        held += len(s)
                if held >= BUFFER:
                    yield recurring(kept)
                    seen, kept, held = set(), [], 0
            empty = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(names), empty], names=fields)
        if kept:
            yield recurring(kept)

    def recurring(kept):
        tokens, n = np.unique(np.concatenate(kept), return_counts=True)
        often = n >= RECUR
        column = [pa.nulls(int(often.sum()), kind), pa.array(n[often].astype(np.int64)), pa.nulls(int(often.sum()), pa.int64())]
        return pa.RecordBatch.from_arrays([*column, pa.array(tokens[often].view(np.int64))], names=fields)

    fields = ["_key", "n", "class", "token"]
    kind = to_arrow_type(docs.schema[key].dataType)
    # The rows of tokens have no key, so the column is nullable whatever the key is.
    schema = StructType().add("_key", docs.schema[key].dataType, True).add("n", "long").add("class", "long").add("token", "long")
    rows = landed(_texts(docs, text, F.col(key).alias("_key")).mapInArrow(profiled, schema), "profiles")
    return rows.filter("token IS NULL").drop("token"), rows.filter("token IS NOT NULL").select("token", "n")


def prefixes(docs: DataFrame, text: str, width: int, limit: Threshold, often: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(token, class): the first members of each class's set in the global order."""
    sent = docs.sparkSession.sparkContext.broadcast(often)

    def cut(batches):
        common, counts = sent.value
        for batch in batches:
            for _, _, words in sliced(batch.column(0)):
                tokens, names, seen = [], [], set()
                for s in shingle_sets(words, width):
                    name = class_of(s)
                    if not len(s) or name in seen:
                        continue
                    seen.add(name)
                    if len(common):
                        at = np.minimum(np.searchsorted(common, s), len(common) - 1)
                        weight = np.where(common[at] == s, counts[at], 0)
                        if weight.any():
                            s = s[np.argsort(weight, kind="stable")]
                    s = s[: limit.prefix(len(s))]
                    tokens.append(s)
                    names.append(np.full(len(s), name))
                if tokens:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(names))], names=["token", "class"]
                    )

    return _texts(docs, text).mapInArrow(cut, "token bigint, class bigint")


def _runs(batches):
    """Per batch of rows sorted by (token, class), repeated rows left out: tokens, classes, each token's
    first class, whether a row is its token's first, and whether the token's second row is here for the
    first one, which may be in a batch before."""
    token = hub = last = None
    met = False
    for batch in batches:
        tokens, names = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(tokens):
            continue
        fresh = np.append(True, (tokens[1:] != tokens[:-1]) | (names[1:] != names[:-1]))
        fresh[0] = tokens[0] != token or names[0] != last
        tokens, names = tokens[fresh], names[fresh]
        if not len(tokens):
            continue
        first = np.append(True, tokens[1:] != tokens[:-1])
        first[0] = tokens[0] != token
        at = np.maximum.accumulate(np.where(first, np.arange(len(tokens)), -1))
        hubs = np.where(at >= 0, names[np.maximum(at, 0)], hub if hub is not None else 0)
        second = np.append(False, first[:-1]) & ~first
        second[0] = not first[0] and not met
        met = bool(not first[-1])
        token, hub, last = tokens[-1], hubs[-1], names[-1]
        yield tokens, names, hubs, first, second


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.select("token", "class").repartition("token").sortWithinPartitions("token", "class")


def shared(prefix: DataFrame) -> DataFrame:
    """The distinct rows (token, class) of tokens that several classes have; a task keeps one token's state."""

    def kept(batches):
        for tokens, names, hubs, first, second in _runs(batches):
            pairs = [np.concatenate(c) for c in ((tokens[~first], tokens[second]), (names[~first], hubs[second]))]
            if len(pairs[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in pairs], names=["token", "class"])

    return _sorted(prefix).mapInArrow(kept, "token bigint, class bigint")


def candidates(rows: DataFrame, classes: DataFrame, limit: Threshold, rounds: int = 2) -> DataFrame:
    """(hub, class, n): groups in which all alike classes meet.

    A class that shares fewer prefix members with all others together than alike sets share
    is left out, and again among those that remain. A class goes to the groups of its
    members' smallest classes, but for its smallest groups that together hold under half of
    what alike sets share: two classes cannot both miss each other so.
    """
    shortest = F.expr(f"-floor(-n * {limit.percent} / 100.0BD)").cast("bigint")
    least = F.greatest(F.lit(1), F.floor(shortest / 10))
    rows = landed(shared(rows), "shared")
    for _ in range(rounds):
        total = rows.groupBy("class").agg(F.count("*").alias("total")).join(classes, "class")
        enough = total.filter(F.col("total") >= least).select("class")
        rows = landed(shared(rows.join(enough, "class")), "shared")

    def met(batches):
        for _, names, hubs, first, second in _runs(batches):
            pairs = np.concatenate([np.stack([hubs[~first], names[~first]], 1), np.stack([hubs[second], hubs[second]], 1)])
            if len(pairs):
                pairs, count = np.unique(pairs, axis=0, return_counts=True)
                columns = [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(count.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["hub", "class", "count"])

    groups = _sorted(rows).mapInArrow(met, "hub bigint, class bigint, count bigint")
    groups = groups.groupBy("hub", "class").agg(F.sum("count").alias("count")).join(classes, "class")
    by = Window.partitionBy("class").orderBy("count", "hub")
    passed = F.sum("count").over(by.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("count").over(Window.partitionBy("class"))
    groups = groups.withColumn("passed", passed).withColumn("total", total)
    groups = groups.filter((F.col("total") >= least) & (F.col("passed") * 2 > least - 1)).select("hub", "class", "n")
    groups = landed(groups, "groups")
    several = groups.groupBy("hub").agg(F.count("*").alias("k")).filter("k > 1").select("hub")
    return groups.join(several, "hub")


def sets_of(docs: DataFrame, text: str, width: int, wanted: DataFrame) -> DataFrame:
    """(class, n, members) of the classes in `wanted`, which a filter of bounded size finds in the texts."""
    bits = wanted.select(F.pmod(F.xxhash64("class"), F.lit(1 << FILTER_BITS)).alias("bit")).distinct()
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(bit & 63))")).alias("bits")
    )
    found = words.toPandas()
    table = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    table[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def drawn(batches):
        flags = sent.value
        for batch in batches:
            for _, _, words in sliced(batch.column(0)):
                new = {}
                for s in shingle_sets(words, width):
                    if len(s):
                        new.setdefault(class_of(s), s)
                if not new:
                    continue
                names = np.fromiter(new, np.int64, len(new))
                bit = (_spark_hash(names) % np.uint64(1 << FILTER_BITS)).astype(np.int64)
                hit = ((flags[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
                chosen = [new[k] for k in names[hit].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names[hit]),
                        pa.array([len(s) for s in chosen], pa.int64()),
                        pa.array([s.tobytes() for s in chosen], pa.binary()),
                    ],
                    names=["class", "n", "members"],
                )

    rows = _texts(docs, text).mapInArrow(drawn, "class bigint, n bigint, members binary")
    known = rows.join(wanted.select("class").distinct(), "class", "left_semi")
    return known.groupBy("class").agg(F.first("n").alias("n"), F.first("members").alias("members"))


def _spark_hash(values: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of a bigint column, seed 42, as in the public XXH64 specification."""
    p1, p2, p3, p4, p5 = (
        np.uint64(x)
        for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
    )
    turn = lambda x, r: (x << np.uint64(r)) | (x >> np.uint64(64 - r))
    with np.errstate(over="ignore"):
        h = np.uint64(42) + p5 + np.uint64(8)
        h = h ^ (turn(values.view(np.uint64) * p2, 31) * p1)
        h = turn(h, 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        return h ^ (h >> np.uint64(32))


def _grouped(batches, columns: list[str]):
    """Runs of equal values of the first `columns` of sorted batches, as lists of rows."""
    at, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            own = tuple(row[c] for c in columns)
            if own != at and rows:
                yield rows
                rows = []
            at = own
            rows.append(row)
    if rows:
        yield rows


def _sets(rows: list[dict]) -> list[np.ndarray]:
    return [np.frombuffer(r["members"], np.uint64) for r in rows]


def links(met: DataFrame, sets: DataFrame, limit: Threshold, block: int, weight: int) -> DataFrame:
    """(a, b): links that connect the classes which links of alike classes connect.

    A block has about `block` classes and about `weight` members at most.
    """
    sizes = met.groupBy("hub").agg(F.count("*").alias("k"), F.sum("n").alias("w"), F.min("class").alias("centre"))
    parts = F.greatest(F.ceil(F.col("k") / block), F.ceil(F.col("w") / weight)).cast("long")
    sizes = sizes.select("hub", "centre", parts.alias("parts"))
    dealt = met.join(sizes, "hub").withColumn("block", F.pmod(F.xxhash64("class"), F.col("parts")))
    dealt = landed(dealt.select("hub", "block", "class", "n", "centre", "parts"), "blocks")
    seeds = dealt.filter("class = centre AND parts > 1")
    seeds = seeds.withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)"))).filter("other <> block")
    seeds = seeds.drop("block").withColumnRenamed("other", "block")
    fields = ["hub", "block", "class", "members", "centre", "parts"]
    blocks = dealt.unionByName(seeds).join(sets.select("class", "members"), "class").select(*fields)

    def joined(batches):
        for rows in _grouped(batches, ["hub", "block"]):
            found = forest(_sets(rows), limit)
            names = [r["class"] for r in rows]
            out = [(names[i], names[j], None, None, None) for i, j in found]
            if rows[0]["parts"] > 1:
                part = _reached(len(rows), found, names.index(rows[0]["centre"]))
                out += [(None, None, r["hub"], r["class"], r["block"]) for i, r in enumerate(rows) if not part[i]]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=shape)

    shape = ["a", "b", "hub", "class", "block"]
    schema = ", ".join(f"{c} bigint" for c in shape)
    first = blocks.repartition("hub", "block").sortWithinPartitions("hub", "block", "class").mapInArrow(joined, schema)
    first = landed(first, "block-links")
    apart = first.filter("hub IS NOT NULL").select("hub", "class", "block")
    inside = first.filter("hub IS NULL").select("a", "b")
    if apart.isEmpty():
        return inside
    return inside.unionByName(_between(apart, dealt, sets, limit, block, weight))


def _reached(n: int, found: list[tuple[int, int]], start: int) -> list[bool]:
    near: list[list[int]] = [[] for _ in range(n)]
    for i, j in found:
        near[i].append(j)
        near[j].append(i)
    seen, todo = [False] * n, [start]
    while todo:
        at = todo.pop()
        if not seen[at]:
            seen[at] = True
            todo += near[at]
    return seen


def _between(apart: DataFrame, dealt: DataFrame, sets: DataFrame, limit: Threshold, block: int, weight: int) -> DataFrame:
    """Links of classes that their block left apart from its group's first class with those of other blocks.

    The former are dealt into tries, and each block of the group asks each of them.
    """
    rows = apart.join(dealt.select("hub", "class", "block", "n", "parts"), ["hub", "class", "block"])
    sizes = rows.groupBy("hub").agg(F.count("*").alias("k"), F.sum("n").alias("w"))
    tries = F.greatest(F.ceil(F.col("k") / block), F.ceil(F.col("w") / weight)).cast("long")
    sizes = landed(sizes.select("hub", tries.alias("tries")), "trie-sizes")
    own = rows.join(sizes, "hub").withColumn("trie", F.pmod(F.xxhash64(F.lit("trie"), "class"), F.col("tries")))
    fields = ["hub", "trie", "asker", "listed", "class"]
    listed = own.withColumn("asker", F.explode(F.expr("sequence(0L, parts - 1)"))).withColumn("listed", F.lit(True)).select(*fields)
    asking = dealt.join(sizes, "hub").withColumn("trie", F.explode(F.expr("sequence(0L, tries - 1)")))
    asking = asking.withColumn("listed", F.lit(False)).withColumn("asker", F.col("block")).select(*fields)

    def joined(batches):
        for rows in _grouped(batches, ["hub", "trie", "asker"]):
            own, others = [r for r in rows if r["listed"]], [r for r in rows if not r["listed"]]
            mine = {r["class"] for r in own}
            others = [r for r in others if r["class"] not in mine]
            names = [r["class"] for r in own + others]
            found = [(names[i], names[j]) for i, j in forest(_sets(own), limit, _sets(others))]
            if rows[0]["asker"] == 0:
                found += [(names[i], names[j]) for i, j in forest(_sets(own), limit)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

    # Classes of one trie are held against each other where the first block asks.
    both = listed.unionByName(asking).join(sets.select("class", "members"), "class")
    both = both.repartition("hub", "trie", "asker").sortWithinPartitions("hub", "trie", "asker", "listed")
    return both.select(*fields, "members").mapInArrow(joined, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
    common: int = 1 << 18,
    block: int = 256,
    weight: int = 1 << 21,
) -> DataFrame:
    """(key, n_shingles, component_id) of every row.

    Two rows are linked when `percent` * |union| <= 100 * |intersection| of their sets of
    `width`-word shingles; component_id is the smallest key reachable by links, the row's
    own included. Null and empty texts have no shingles and are linked with nothing. Rows
    with a null key take part, and have a null component_id when alone. Repeated rows are
    linked like any copies. Other columns are not read; an empty table gives no rows.
    """
    limit = Threshold(percent)
    rows, often = profiles(docs, key, text, width)
    often = often.groupBy("token").agg(F.sum("n").alias("n"))
    often = landed(often, "recurring")
    found = often.filter(F.col("n") >= bounded_from(often, F.col("n"), common)).toPandas().sort_values("token")
    tokens = found["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    order = (tokens[order], found["n"].to_numpy(np.int64)[order])
    classes = landed(rows.filter("n > 0").select("class", "n").distinct(), "classes")
    met = landed(candidates(prefixes(docs, text, width, limit, order), classes, limit), "meetings")
    wanted = met.select("class").distinct()
    sets = landed(sets_of(docs, text, width, wanted), "sets")
    roots = components(links(met, sets, limit, block, weight)).withColumnRenamed("node", "class")
    classed = rows.filter("n > 0").join(roots, "class", "left").select("_key", "n", F.coalesce("root", "class").alias("root"))
    least = classed.groupBy("root").agg(F.min("_key").alias("component_id"))
    whole = classed.join(least, "root").select(F.col("_key").alias(key), F.col("n").alias("n_shingles"), "component_id")
    alone = rows.filter("n = 0").select(F.col("_key").alias(key), F.col("n").alias("n_shingles"), F.col("_key").alias("component_id"))
    return whole.unionByName(alone)
