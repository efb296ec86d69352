"""Token ids in binary shard files, and a minimal perfect hash index of their places.

A shard file holds, in this order: the ids of its documents in ascending key order, each
document followed by the end id, as little-endian words of the narrowest width the
vocabulary allows; a footer with the documents' keys and lengths; one word more, as each
record of the writer ends with the end id. Spark's own writer commits the files, so a task
that is lost or repeated leaves no second copy, and any file system Spark knows will do.

The index maps a key to the runs of its records. Keys are dealt into buckets by hash, and
a bucket is one row: a displacement for each small group of keys sends every key to a slot
of its own, with no slot left empty, and the slot has the key's fingerprint and runs. A
lookup hashes the key, reads one displacement and one slot, and compares the fingerprint.
"""

import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clearspark.llm.pretokens import Encoder, encoder, mixed
from clearspark.session import landed

MAGIC = b"TOKS"
_TAIL = struct.Struct("<QQQI4s")
#: Keys for which one displacement is sought together, on average.
SMALL = 4


def write(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    shards: int | None = None,
) -> None:
    """Writes every row's ids below `path`, in ascending order of key, null keys first.

    Null and empty texts have the end id alone. Rows of one key stand together in order of
    their text, also where they are so many that they span shards. `shards` is the number
    of files, by default the session's shuffle partitions. `end_id` is below 128, so that
    each of its bytes is a character of the writer's record separator.
    """
    if not 0 <= end_id < 128:
        raise ValueError("end_id must be from 0 to 127")
    width = np.dtype(Encoder(vocabulary, 1, 1).kind).itemsize

    def encoded(batches):
        encode, lengths, keys = encoder(vocabulary).encode, [], []
        for batch in batches:
            found = encode(batch.column(1).to_pylist())
            lengths += [len(ids) + 1 for ids in found]
            keys += batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([i.tobytes() for i in found], pa.binary())], names=["value"])
        if lengths:
            tail = pa.array([_footer(keys, lengths, width)], pa.binary())
            yield pa.RecordBatch.from_arrays([tail], names=["value"])

    parts = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    ordered = rows.repartitionByRange(parts, F.col("_key").asc_nulls_first(), F.xxhash64("_text"))
    ordered = ordered.sortWithinPartitions(F.col("_key").asc_nulls_first(), F.xxhash64("_text"), "_text")
    payload = ordered.select(F.col("_key").cast("string"), "_text").mapInArrow(encoded, "value binary")
    words = end_id.to_bytes(width, "little").decode()
    payload.select(F.col("value").cast("string")).write.option("lineSep", words).text(path)


def _footer(keys: list[str | None], lengths: list[int], width: int) -> bytes:
    spelled = [b"" if k is None else k.encode() for k in keys]
    sizes = [-1 if k is None else len(s) for k, s in zip(keys, spelled, strict=True)]
    blob = b"".join(spelled)
    numbers = np.array(sizes, "<i4").tobytes() + np.array(lengths, "<i8").tobytes()
    return numbers + blob + _TAIL.pack(len(keys), sum(lengths), len(blob), width, MAGIC)


def opened(content: bytes) -> tuple[list[str | None], np.ndarray, np.ndarray]:
    """Keys, lengths and ids (end ids included) of a shard file."""
    width = next(w for w in (2, 4) if content[-w - 4 : len(content) - w] == MAGIC)
    end = len(content) - width
    count, total, blob, width, _ = _TAIL.unpack_from(content, end - _TAIL.size)
    at = total * width
    sizes = np.frombuffer(content, "<i4", count, at)
    lengths = np.frombuffer(content, "<i8", count, at + 4 * count)
    at += 12 * count
    keys = []
    for n in sizes.tolist():
        keys.append(None if n < 0 else content[at : at + n].decode())
        at += max(n, 0)
    return keys, lengths, np.frombuffer(content, f"<u{width}", total)


RECORD = "shard int, record bigint, key string, run bigint, offset bigint, n_tokens bigint, ids_crc32 bigint"


def records(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row for each document in the files, in no order.

    (shard, record, key, run, offset, n_tokens, ids_crc32[, ids]): its place counts ids in
    its shard, `run` is the place of the first of neighbours with its key, and the checksum
    is that of its ids as little-endian unsigned 32-bit words.
    """

    def read(batches):
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys, lengths, ids = opened(content.as_py())
                starts = (np.cumsum(lengths) - lengths).tolist()
                runs = list(starts)
                for i in range(1, len(keys)):
                    if keys[i] == keys[i - 1]:
                        runs[i] = runs[i - 1]
                wide = (ids[a : a + n].astype("<u4") for a, n in zip(starts, lengths.tolist(), strict=True))
                raw = [w.tobytes() for w in wide] if with_ids else wide
                sums = pa.array((zlib.crc32(w) for w in raw), pa.int64())
                columns = [
                    pa.array([shard] * len(keys), pa.int32()),
                    pa.array(range(len(keys)), pa.int64()),
                    pa.array(keys, pa.string()),
                    pa.array(runs, pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    sums,
                ] + ([pa.array(raw, pa.binary())] if with_ids else [])
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = RECORD + ", ids binary" * with_ids
    names = [f.split()[0] for f in schema.split(", ")]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    shard = F.regexp_extract("path", r"part-(\d+)", 1).cast("int")
    return files.filter("length > 0").select(shard.alias("shard"), "content").mapInArrow(read, schema)


def hashes(key: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a key's text; null is a key like any other."""
    return F.xxhash64(key, key.isNull()), F.xxhash64(F.lit("slot"), key, key.isNull())


def perfect(slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacements, and the slot of each of so many distinct hashes, a permutation.

    A group of one takes the next free slot, written as its negative number less one.
    """
    n = len(slots)
    groups = max(1, -(-n // SMALL))
    group = (slots % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    sizes = np.bincount(group, minlength=groups)
    firsts = np.cumsum(sizes) - sizes
    free, out, displaced = np.ones(n, bool), np.zeros(n, np.int64), np.zeros(groups, np.int32)
    for g in np.argsort(-sizes, kind="stable").tolist():
        members = order[firsts[g] : firsts[g] + sizes[g]]
        if len(members) < 2:
            break
        tried = 0
        while True:
            steps = np.arange(tried, tried + 64)
            spots = place(slots[members][None, :], steps[:, None], n)
            good = free[spots].all(1)
            ranked = np.sort(spots, 1)
            good &= (ranked[:, 1:] != ranked[:, :-1]).all(1)
            if good.any():
                k = int(np.argmax(good))
                displaced[g], out[members] = tried + k, spots[k]
                free[spots[k]] = False
                break
            tried += 64
    single = np.flatnonzero(sizes == 1)
    left = np.flatnonzero(free)
    out[order[firsts[single]]] = left
    displaced[single] = -left - 1
    return displaced, out


def place(slots: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        moved = mixed(slots + displacement.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (moved % np.uint64(n)).astype(np.int64)


INDEX = "bucket bigint, keys int, displacements binary, prints binary, firsts binary, shards binary, offsets binary, tokens binary, counts binary"


def index(rows: DataFrame, bucket_keys: int = 2048) -> DataFrame:
    """The index of the rows of `records`, one row for each bucket of about `bucket_keys` keys.

    `buckets` of the result says how many there are. A key with records in several shards
    has a run for each, so a key is bounded by the shards whatever its records.
    """
    runs = rows.groupBy("key", "shard").agg(
        F.min("offset").alias("offset"), F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_records")
    )
    runs = landed(runs, "runs")
    buckets = max(1, -(-runs.select("key").distinct().count() // bucket_keys))
    first, second = hashes(F.col("key"))
    dealt = runs.select(
        F.pmod(first, F.lit(buckets)).alias("bucket"), first.alias("a"), second.alias("b"), "shard", "offset", "n_tokens", "n_records"
    )

    def built(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["b", "a", "shard"], ignore_index=True)
        b = rows["b"].to_numpy().view(np.uint64)
        new = np.append(True, b[1:] != b[:-1])
        displaced, slot = perfect(b[new])
        rows["slot"] = slot[np.cumsum(new) - 1]
        rows = rows.sort_values(["slot", "shard"], ignore_index=True)
        keys = int(new.sum())
        firsts = np.searchsorted(rows["slot"].to_numpy(), np.arange(keys + 1))
        prints = (rows["a"].to_numpy().view(np.uint64) >> np.uint64(32)).astype("<u4")[firsts[:-1]]
        return pd.DataFrame(
            {
                "bucket": [int(rows["bucket"].iloc[0])],
                "keys": [keys],
                "displacements": [displaced.astype("<i4").tobytes()],
                "prints": [prints.tobytes()],
                "firsts": [firsts.astype("<i4").tobytes()],
                "shards": [rows["shard"].to_numpy("<i4").tobytes()],
                "offsets": [rows["offset"].to_numpy("<i8").tobytes()],
                "tokens": [rows["n_tokens"].to_numpy("<i8").tobytes()],
                "counts": [rows["n_records"].to_numpy("<i8").tobytes()],
            }
        )

    found = dealt.groupBy("bucket").applyInPandas(built, INDEX)
    return found.withColumn("buckets", F.lit(buckets))


def lookup(indexed: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, shard, run, n_tokens, n_records) of every run of the distinct keys of a column `key`.

    Absent keys give no row, but for one in 2^32 whose fingerprint agrees; `fetch` and
    whoever joins with `records` on the key leave those out. `indexed` is a landed index.
    """
    first, second = hashes(F.col("key"))
    size = indexed.agg(F.max("buckets")).first()[0] or 1
    asked = keys.select("key").distinct().select("key", first.alias("a"), second.alias("b"))
    asked = asked.withColumn("bucket", F.pmod("a", F.lit(size)))

    def found(keys: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(keys):
            return pd.DataFrame({"key": np.zeros(0, object), **{name: np.zeros(0, np.int64) for name in ("shard", "run", "n_tokens", "n_records")}})
        row = rows.iloc[0]
        n = int(row["keys"])
        take = lambda name, kind: np.frombuffer(row[name], kind)
        displaced, prints, firsts = take("displacements", "<i4"), take("prints", "<u4"), take("firsts", "<i4")
        b = keys["b"].to_numpy().view(np.uint64)
        step = displaced[(b % np.uint64(len(displaced))).astype(np.int64)]
        slot = np.where(step < 0, -step.astype(np.int64) - 1, place(b, np.maximum(step, 0), n))
        own = (keys["a"].to_numpy().view(np.uint64) >> np.uint64(32)).astype("<u4")
        hit = np.flatnonzero(prints[slot] == own)
        many = firsts[slot[hit] + 1] - firsts[slot[hit]]
        at = np.concatenate([np.arange(firsts[s], firsts[s + 1]) for s in slot[hit]]) if len(hit) else np.zeros(0, int)
        return pd.DataFrame(
            {
                "key": keys["key"].to_numpy()[np.repeat(hit, many)],
                "shard": take("shards", "<i4")[at],
                "run": take("offsets", "<i8")[at],
                "n_tokens": take("tokens", "<i8")[at],
                "n_records": take("counts", "<i8")[at],
            }
        )

    schema = "key string, shard int, run bigint, n_tokens bigint, n_records bigint"
    return asked.groupBy("bucket").cogroup(indexed.groupBy("bucket")).applyInPandas(found, schema)


def located(indexed: DataFrame, rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of `records` that the index finds for the keys; the key itself is compared too."""
    places = lookup(indexed, keys).select(F.col("key").alias("_key"), F.col("shard").alias("_shard"), F.col("run").alias("_run"))
    same = (F.col("shard") == F.col("_shard")) & (F.col("run") == F.col("_run")) & F.col("key").eqNullSafe(F.col("_key"))
    return rows.join(places, same).drop("_key", "_shard", "_run")


def with_starts(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """`start`: the ids of all documents before each one, over all shards of `sizes`."""
    totals = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("_total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    return rows.join(bases, "shard").withColumn("start", F.col("_base") + F.col("offset")).drop("_base")
