"""Dropping repeated deliveries."""

from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearspark.operators import sequence, shipping
from clearspark.session import landed

shipping.send_by_value(__name__)

LOG_ORDER = ("partition", "offset")


def keep_first(
    rows: DataFrame, keys: Sequence[str] = ("trade_id",), order: Sequence[str] = LOG_ORDER
) -> DataFrame:
    """The first row of each key in log order.

    A rank limit of one is applied per map task before the shuffle, so a key that
    fills a third of the rows sends one row per task, not all of them. A row without a
    key repeats nothing and is kept.
    """
    missing = F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0)) == 1
    alone = F.when(missing, F.struct(*order))
    turn = Window.partitionBy(*keys, alone).orderBy(*order)
    ranked = rows.withColumn("_turn", F.row_number().over(turn))
    return ranked.filter(F.col("_turn") == 1).drop("_turn")


def memory_shard(key: Column, shards: int) -> Column:
    """Shard of a key: every copy of one id meets the same memory. A missing key is a key like any other."""
    shard = F.pmod(F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("bigint"), shards)
    return F.coalesce(shard, F.lit(0).cast("bigint"))


def _replayed(keys: Iterable, memory: Iterable, capacity: int) -> tuple[list[bool], dict]:
    """Which of the keys are new to a memory, oldest key first, and the memory after them."""
    seen, admitted = dict.fromkeys(memory), []
    for key in keys:
        fresh = key not in seen
        if fresh:
            # A dict keeps admission order, so its first key is the oldest.
            if len(seen) == capacity:
                del seen[next(iter(seen))]
            seen[key] = None
        admitted.append(fresh)
    return admitted, seen


CHUNK = ("_shard", "_serial")


def bounded_memory_verdicts(
    rows: DataFrame,
    key: str = "trade_id",
    capacity: int = 100_000,
    shards: int = 1,
    chunk_bits: int = sequence.CHUNK_BITS,
) -> DataFrame:
    """(partition, offset, admitted) under a memory of the last `capacity` admitted keys.

    One shard is one memory over the whole log. More `shards` are independent memories of
    `capacity` keys each, by key hash; a key is then remembered longer. The log is cut into
    chunks of 2^chunk_bits offsets, and no task replays more than a chunk and a memory. What
    a chunk leaves behind rarely depends on what it found, as later keys push earlier ones
    out. So all chunks are replayed at once from what their predecessors left in the round
    before, and those alone again whose beginning has changed, until none has: the first
    n chunks are right after n rounds, nearly always all of them after two or three. Copies that
    directly follow one another in a chunk and shard are repeats and are not replayed.
    """
    capacity = max(capacity, 1)
    slim = rows.select(
        memory_shard(F.col(key), shards).alias("_shard"),
        F.col("partition"),
        F.col("offset"),
        F.col(key).alias("_key"),
        F.shiftright("offset", chunk_bits).alias("_chunk"),
    )
    # Offsets are unique in a partition, which bounds the rows of a chunk.
    local = Window.partitionBy("partition", "_chunk", "_shard").orderBy("offset")
    marked = slim.withColumn(
        "_follows", F.coalesce(F.lag("_key").over(local) == F.col("_key"), F.lit(False))
    )
    marked = landed(marked, "keys")
    # One small row for each chunk is all that is ordered over the whole log.
    turn = Window.partitionBy("_shard").orderBy("partition", "_chunk")
    chunks = marked.select("_shard", "partition", "_chunk").distinct().withColumn("_serial", F.row_number().over(turn).cast("bigint"))
    position = ["partition", "offset"]
    replayed = marked.filter(~F.col("_follows")).join(chunks, ["_shard", "partition", "_chunk"])
    replayed = landed(replayed.select(*CHUNK, *position, "_key"), "chunks")
    memories = _memories(replayed, capacity)

    def judged(rows: pd.DataFrame, memory: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("offset")
        admitted, _ = _replayed(rows["_key"], memory.sort_values("_place")["_key"], capacity)
        return rows[position].assign(admitted=admitted)

    verdicts = replayed.groupBy(*CHUNK).cogroup(memories.groupBy(*CHUNK)).applyInPandas(
        judged, "partition int, offset bigint, admitted boolean"
    )
    settled = marked.filter("_follows").select(*position, F.lit(False).alias("admitted"))
    return verdicts.unionByName(settled)


def _memories(replayed: DataFrame, capacity: int) -> DataFrame:
    """(_shard, _serial, _place, _key): the memory that each chunk begins with."""
    kind = replayed.schema["_key"].dataType
    schema = T.StructType().add("_shard", "long").add("_serial", "long").add("_place", "long").add("_key", kind)

    def left(rows: pd.DataFrame, memory: pd.DataFrame) -> pd.DataFrame:
        # Of a chunk without rows, as after the last one, nothing is left.
        if not len(rows):
            return pd.DataFrame({"_shard": np.zeros(0, np.int64), "_serial": np.zeros(0, np.int64), "_place": np.zeros(0, np.int64), "_key": np.zeros(0, object)})
        _, seen = _replayed(rows.sort_values("offset")["_key"], memory.sort_values("_place")["_key"], capacity)
        own = rows.iloc[0]
        return pd.DataFrame({"_shard": own["_shard"], "_serial": own["_serial"] + 1, "_place": np.arange(len(seen)), "_key": pd.Series(list(seen), dtype=object)})

    def beginnings(memories: DataFrame) -> DataFrame:
        sums = F.sum(F.xxhash64("_place", "_key").cast("decimal(38,0)")).alias("_sum")
        return landed(memories.groupBy(*CHUNK).agg(F.count("*").alias("_n"), sums), "beginnings")

    memories = replayed.sparkSession.createDataFrame([], schema)
    todo, known = replayed, beginnings(memories)
    while True:
        found = todo.groupBy(*CHUNK).cogroup(memories.groupBy(*CHUNK)).applyInPandas(left, schema)
        again = todo.select("_shard", (F.col("_serial") + 1).alias("_serial")).distinct()
        memories = landed(memories.join(again, list(CHUNK), "left_anti").unionByName(found), "memories")
        now = beginnings(memories)
        old = known.select(*CHUNK, F.col("_n").alias("_m"), F.col("_sum").alias("_was"))
        changed = now.join(old, list(CHUNK), "left").filter(~(F.col("_n").eqNullSafe(F.col("_m")) & F.col("_sum").eqNullSafe(F.col("_was"))))
        changed = landed(changed.select(*CHUNK), "changed")
        todo, known = replayed.join(changed, list(CHUNK), "left_semi"), now
        if todo.isEmpty():
            return memories
