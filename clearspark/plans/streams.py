"""Streaming forms of the flows, run over logs that land step by step."""

import contextlib
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clearspark.operators import batching
from clearspark.session import fresh_folder, landed, settings
from clearspark.sources import logs
from clearspark.streaming import ingest, memory, publish, reconcile, settle, timeflush

STEPS = 4

Handler = Callable[[DataFrame, int], None]


class Interrupted(Exception):
    """Stands for a lost driver in a restart drill."""


def arrival_step(clock_us, low: int, high: int, steps: int = STEPS):
    """Which of `steps` equal stretches of [low, high] a clock falls into."""
    return F.floor((clock_us - low) * steps / (high - low + 1)).cast("int")


def arrival_bounds(events: DataFrame, clock_us) -> tuple[int, int]:
    row = events.agg(F.min(clock_us).alias("low"), F.max(clock_us).alias("high")).first()
    return row["low"], row["high"]


def staged_steps(log: DataFrame) -> DataFrame:
    """The log with one folder per step, so that landing a step reads no other.

    A task keeps a file open for each step, so that it need not sort whole messages by step.
    """
    with settings(log.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(STEPS)}):
        return landed(log, "staged", "step")


def land_step(log: DataFrame, folder: str, step: int) -> None:
    """Appends the rows of one step to a file log; later steps give later files."""
    rows = log.filter(F.col("step") == step).drop("step")
    rows.write.mode("append").parquet(folder)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_KEYED_STATE = {
    # Keys that grow with the log stay on disk, and a micro-batch writes down only what it changed.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # What has expired is dropped by the next micro-batch with rows, not by one of its own.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def keyed_state(spark: SparkSession, **but: str) -> contextlib.AbstractContextManager[None]:
    """Settings for queries that start inside and keep keys in the state store."""
    return settings(spark, _KEYED_STATE | but)


def run_handler(
    spark: SparkSession, log_folder: str, checkpoint: str, handler: Handler
) -> StreamingQuery:
    """Handles all that has landed since the last run with this checkpoint."""
    query = (
        logs.stream_log(spark, log_folder)
        .writeStream.foreachBatch(handler)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def stream_ingest(spark: SparkSession, log: DataFrame, horizon: str, steps: int = STEPS) -> DataFrame:
    """U1 on a stream: what a streaming ingest has written after all steps landed."""
    root = fresh_folder(spark, "ingest")
    arrived, out = os.path.join(root, "trades"), os.path.join(root, "normalized")
    staged = staged_steps(log)
    for step in range(steps):
        land_step(staged, arrived, step)
        with keyed_state(spark):
            query = (
                ingest.ingest_stream(logs.stream_log(spark, arrived), horizon)
                .writeStream.format("parquet")
                .option("checkpointLocation", os.path.join(root, "progress"))
                .trigger(availableNow=True)
                .start(out)
            )
            query.awaitTermination()
    return logs.read_log(spark, out)


def stream_forward(
    spark: SparkSession, log: DataFrame, horizon_us: int, steps: int = STEPS
) -> DataFrame:
    """U1 on a stream, by table: what a forwarder has written after all steps landed."""
    root = fresh_folder(spark, "forward")
    arrived, out = os.path.join(root, "trades"), os.path.join(root, "normalized")
    handle = ingest.forwarder(out, horizon_us)
    staged = staged_steps(log)
    for step in range(steps):
        land_step(staged, arrived, step)
        run_handler(spark, arrived, os.path.join(root, "progress"), handle)
    return ingest.forwarded(spark, out)


def stream_publish(
    spark: SparkSession,
    log: DataFrame,
    flush: batching.Flush,
    steps: int = STEPS,
    fail_at: int | None = None,
) -> DataFrame:
    """B1 and T7 on a stream: all batches after the last step and a drain.

    With `fail_at` the run of that step is cut off after its writes, and repeated.
    """
    root = fresh_folder(spark, "publish")
    arrived, out = os.path.join(root, "normalized"), os.path.join(root, "out")
    progress = os.path.join(root, "progress")
    handle = publish.publisher(out, flush, F.lit(0).cast("bigint"))

    def cut_off(micro: DataFrame, step: int) -> None:
        handle(micro, step)
        raise Interrupted(f"after micro-batch {step}")

    staged = staged_steps(log)
    for step in range(steps):
        land_step(staged, arrived, step)
        if step == fail_at:
            try:
                run_handler(spark, arrived, progress, cut_off)
            except Exception as error:
                if Interrupted.__name__ not in str(error):
                    raise
        run_handler(spark, arrived, progress, handle)
    publish.drain(spark, out, steps - 1, flush, F.lit(0).cast("bigint"))
    return publish.published(spark, out)


def stream_time_flush(
    spark: SparkSession, log: DataFrame, flush: batching.Flush, seconds: float = 300
) -> DataFrame:
    """B1, B2 on a stream that no record follows: all batches, the last ones closed by timers alone."""
    root = fresh_folder(spark, "time-flush")
    arrived, out = os.path.join(root, "normalized"), os.path.join(root, "out")
    log.write.parquet(arrived)
    trades = logs.read_log(spark, arrived).count()
    with keyed_state(spark, **{"spark.sql.streaming.noDataMicroBatches.enabled": "true"}):
        query = timeflush.start(
            logs.stream_log(spark, arrived), out, os.path.join(root, "progress"), flush, F.lit(0).cast("bigint"), "5 seconds"
        )
        try:
            published = lambda: publish.published(spark, out).agg(F.sum("trade_count")).first()[0] or 0
            # A log of any size gets the time it needs: only a stretch in which nothing more comes out is too long.
            seen = -1
            while (now := published()) != trades:
                reading = query.isActive and query.lastProgress is None
                if now == seen and not reading:
                    raise TimeoutError(f"{now} of {trades} trades are published")
                seen = now
                timeflush.wait_until(query, lambda: published() == trades, seconds, 1.0)
        finally:
            timeflush.stop(query)
    return publish.published(spark, out)


def stream_settle(
    spark: SparkSession,
    log: DataFrame,
    attempts: DataFrame,
    max_attempts: int,
    steps: int = STEPS,
) -> str:
    """T2 on a stream: the folder holding ledger and dead letters after all steps."""
    root = fresh_folder(spark, "settle")
    arrived, out = os.path.join(root, "batches"), os.path.join(root, "out")
    tries = os.path.join(root, "attempts")
    # Read by every micro-batch, so computed once.
    attempts.write.parquet(tries)
    handle = settle.settler(out, spark.read.parquet(tries), max_attempts, F.lit(0).cast("bigint"))
    staged = staged_steps(log)
    for step in range(steps):
        land_step(staged, arrived, step)
        run_handler(spark, arrived, os.path.join(root, "progress"), handle)
    return out


def stream_reconcile(
    spark: SparkSession, log: DataFrame, batches: str, letters: str, steps: int = STEPS
) -> DataFrame:
    """R1-R3 on a stream: the totals after each step."""
    root = fresh_folder(spark, "reconcile")
    arrived, out = os.path.join(root, "log"), os.path.join(root, "out")
    staged = staged_steps(log)
    for step in range(steps):
        land_step(staged, arrived, step)
        with keyed_state(spark):
            query = reconcile.follow(
                logs.stream_log(spark, arrived), out, os.path.join(root, "progress"), batches, letters, availableNow=True
            )
            query.awaitTermination()
    return reconcile.totals(spark, out)


def stream_remember(
    spark: SparkSession, log: DataFrame, capacity: int, shards: int, steps: int = STEPS
) -> DataFrame:
    """U2 on a stream: rows admitted by a memory of the last keys; the key is the log's key."""
    root = fresh_folder(spark, "memory")
    arrived, out = os.path.join(root, "log"), os.path.join(root, "out")
    handle = memory.remember(out, "key", capacity, shards)
    staged = staged_steps(log)
    for step in range(steps):
        land_step(staged, arrived, step)
        run_handler(spark, arrived, os.path.join(root, "progress"), handle)
    return spark.read.parquet(os.path.join(out, memory.ADMITTED))
