"""Streaming ingest: judge, then drop repeats within a bounded time.

No form loses a row, however late it comes. `ingest_stream` keeps ids in the state store for
a time counted from when they were read: the work of a micro-batch does not depend on it,
but all copies of one id pass through one task. `forwarder` looks ids up in tables it has
written: copies are folded before the shuffle. It reads the ids of its horizon, and for rows
from before that the ids that share their hash bucket, so that a repeat is known however old.
"""

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearspark import schemas
from clearspark.operators import dedup, validate
from clearspark.streaming import tables

NORMALIZED = T.StructType([*schemas.LOG.fields, T.StructField("trade_id", T.StringType())])


#: The trades that a forwarder has written, their ids by hash, and the newest clock that a micro-batch has seen.
FORWARDED, IDS, CLOCKS = "forwarded", "ids", "clocks"
ID_ROWS = T.StructType().add("trade_id", "string").add("timestamp", "timestamp").add("bucket", "long")


def ingest_stream(trades: DataFrame, horizon: str = "1 hour", strict_notional: bool = True) -> DataFrame:
    """Valid, distinct trades of a stream, `value` untouched.

    An id is remembered for `horizon` after the micro-batch that read it, on the clock of
    the stream and not of its records, which bounds the state. So no record is late; a
    repeat that is read later than that is forwarded again.
    """
    # The clock of a micro-batch is kept in the stream's log, so a replay has the same one.
    read_at = trades.withColumn("_read_at", F.current_timestamp()).withWatermark("_read_at", horizon)
    kept = dedup_columns(validate.judge_trades(read_at, strict_notional))
    return kept.dropDuplicatesWithinWatermark(["trade_id"]).drop("trade_id", "_read_at")


def dedup_columns(judged: DataFrame) -> DataFrame:
    """What `validate.forwardable` gives, with the clock of reading."""
    return validate.accepted(judged).select(
        F.lit(validate.NORMALIZED_TOPIC).alias("topic"),
        "partition",
        "offset",
        "timestamp",
        F.col("trade.coin").cast("binary").alias("key"),
        "value",
        F.col("trade.trade_id").alias("trade_id"),
        "_read_at",
    )


def forwarder(
    folder: str, horizon_us: int | None = None, strict_notional: bool = True, buckets: int = 64
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` handler that appends the valid, new trades of a stream to a table.

    A row's id is looked up among those forwarded within `horizon_us` before the newest
    clock of earlier micro-batches. A row from before that is behind the horizon: its id is
    looked up among all older ones in its hash bucket, of which only those that such rows
    touch are read. Either way no row is lost and a copy with the clock of its first delivery
    is known. None looks back to the beginning.
    """

    def handle(micro: DataFrame, step: int) -> None:
        spark = micro.sparkSession
        bucket = F.pmod(F.xxhash64("trade_id"), F.lit(buckets)).alias("bucket")
        firsts = dedup.keep_first(validate.forwardable(micro, strict_notional)).select("*", bucket).persist()
        try:
            clock = tables.handed_over(spark, os.path.join(folder, CLOCKS), step)
            newest = clock.agg(F.max("newest")).first()[0] if clock is not None else None
            seen = tables.before_step(tables.read_table(spark, os.path.join(folder, IDS), ID_ROWS), step)
            if horizon_us is not None and newest is not None:
                # Plain bounds on stored columns, which file statistics and folder names answer.
                bound = F.timestamp_micros(F.lit(newest - horizon_us))
                behind = firsts.filter(F.col("timestamp") < bound).select("bucket").distinct()
                touched = [r["bucket"] for r in behind.collect()]
                recent, older = seen.filter(F.col("timestamp") >= bound), seen.filter(F.col("timestamp") < bound)
                seen = recent.unionByName(older.filter(F.col("bucket").isin(touched))) if touched else recent
            fresh = firsts.join(seen.select("trade_id"), "trade_id", "left_anti")
            tables.write_step(fresh.select(*NORMALIZED.names), os.path.join(folder, FORWARDED), step)
            # The ids of what was written, read from there: two narrow columns, and no second copy of the rows is held.
            written = spark.read.schema(NORMALIZED).parquet(tables.step_path(os.path.join(folder, FORWARDED), step))
            ids = written.select("trade_id", "timestamp", bucket).repartition("bucket")
            tables.write_step(ids, os.path.join(folder, IDS), step, ("bucket",))
            latest = firsts.agg(F.greatest(F.max(F.unix_micros("timestamp")), F.lit(newest).cast("bigint")).alias("newest"))
            tables.write_step(latest, os.path.join(folder, CLOCKS), step)
        finally:
            firsts.unpersist()

    return handle


def forwarded(spark: SparkSession, folder: str) -> DataFrame:
    """Every trade that a forwarder has written."""
    return tables.read_table(spark, os.path.join(folder, FORWARDED), NORMALIZED)
