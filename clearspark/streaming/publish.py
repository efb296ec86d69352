"""Streaming batches that equal the batch form wherever micro-batches end.

A micro-batch emits the batches that are closed and hands the rows of open ones,
less than one batch per partition, to the next. All of it is written before the
checkpoint moves on; a replay reads the same hand-over and writes the same ids.
"""

import os
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearspark.functions import codec
from clearspark.operators import batching
from clearspark.session import keeping
from clearspark.streaming import tables

BATCHES, DRAINED, OPEN, CLOCKS = "batches", "drained", "open", "clocks"
ROW = ("partition", "offset", "timestamp", "trade")


def wall_clock_us() -> int:
    return time.time_ns() // 1000


def _pinned_clock(
    spark: SparkSession, folder: str, step: int, now_us: Callable[[], int]
) -> int:
    """The clock of a micro-batch, written ahead so that a replay closes the same batches."""
    clocks = os.path.join(folder, CLOCKS)
    pinned = tables.read_step(spark, clocks, step)
    if pinned is None:
        tables.write_step(
            spark.range(1).select(F.lit(now_us()).cast("bigint").alias("now_us")), clocks, step
        )
        pinned = tables.read_step(spark, clocks, step)
    return pinned.first()["now_us"]


def _open_batches(labelled: DataFrame, flush: batching.Flush, now_us: int | None) -> DataFrame:
    """(partition, batch_key) of the batch still open in each partition."""
    is_trade = batching.is_trade(labelled)
    batches = labelled.groupBy("partition", "batch_key").agg(
        F.max("offset").alias("hi"),
        F.count_if(is_trade).alias("n"),
        F.min(F.when(is_trade, F.col("clock_us"))).alias("first"),
    )
    last = batches.groupBy("partition").agg(
        F.max(F.struct("hi", "batch_key", "n", "first")).alias("b")
    )
    still_open = F.col("b.n") < flush.size
    if now_us is not None:
        due = F.coalesce(F.lit(now_us) - F.col("b.first") >= flush.wait, F.lit(False))
        still_open = still_open & ~due
    return last.filter(still_open).select("partition", F.col("b.batch_key").alias("batch_key"))


def publisher(
    folder: str,
    flush: batching.Flush,
    created_at_ms: Column | None = None,
    now_us: Callable[[], int] | None = None,
    **options: int,
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` handler for a stream of normalized trades.

    Without `now_us` a batch closes by time when a later record says so; with it,
    also when the wall clock does.
    """

    def handle(micro: DataFrame, step: int) -> None:
        spark = micro.sparkSession
        rows = codec.with_trade(micro).select(*ROW)
        tables.claim(spark, folder)
        carried = tables.handed_over(spark, os.path.join(folder, OPEN), step)
        if carried is not None:
            rows = rows.unionByName(carried.select(*ROW))
        now = _pinned_clock(spark, folder, step, now_us) if now_us else None
        # The passes that only place batches read the flag and not the trade.
        rows = rows.withColumn("is_trade", F.col("trade").isNotNull())
        with keeping(spark) as keep:
            labelled = keep(batching.label_by_size_or_time(keep(rows), flush, keep=keep, **options))
            # One row per partition at most, found once and sent to the rows: no trade moves for it.
            unfinished = F.broadcast(keep(_open_batches(labelled, flush, now)))
            keys = ["partition", "batch_key"]
            closed = labelled.join(unfinished, keys, "left_anti")
            built = batching.build(closed, flush, created_at_ms)
            tables.write_step(built, os.path.join(folder, BATCHES), step)
            held = labelled.join(unfinished, keys, "left_semi").select(
                "partition",
                "offset",
                F.timestamp_micros("clock_us").alias("timestamp"),
                "trade",
            )
            tables.write_step(held, os.path.join(folder, OPEN), step)

    return handle


def drain(
    spark: SparkSession,
    folder: str,
    last_step: int,
    flush: batching.Flush,
    created_at_ms: Column | None = None,
) -> None:
    """On a stop for good, the open batches go out with reason `time`.

    They are written before the hand-over is emptied; run again, it writes the same.
    """
    held = tables.read_step(spark, os.path.join(folder, OPEN), last_step)
    if held is None:
        return
    built = batching.build(held.withColumn("batch_key", F.lit(0)), flush, created_at_ms)
    if built.isEmpty():
        return
    tables.write_step(built, os.path.join(folder, DRAINED), last_step)
    nothing = spark.createDataFrame([], held.schema)
    tables.write_step(nothing, os.path.join(folder, OPEN), last_step)


def published(spark: SparkSession, folder: str) -> DataFrame:
    """Every batch a publisher or a drain has written."""
    written = [
        tables.read_table(spark, os.path.join(folder, part), batching.BUILT)
        for part in (BATCHES, DRAINED)
    ]
    return written[0].unionByName(written[1])
