"""Streaming dedup by the last N admitted keys.

The memory of a micro-batch is a table: the last N admitted keys of each shard in
admission order. Read ahead of the new rows it rebuilds the memory exactly, as each
of those keys is admitted again and pushes out nothing newer.
"""

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clearspark.operators import dedup, sequence
from clearspark.streaming import tables

ADMITTED, MEMORY = "admitted", "memory"


def remember(
    folder: str,
    key: str,
    capacity: int = 100_000,
    shards: int = 1,
    chunk_bits: int = sequence.CHUNK_BITS,
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` handler that writes the admitted rows of a log stream."""

    def handle(micro: DataFrame, step: int) -> None:
        spark = micro.sparkSession
        rows = micro.persist()
        try:
            slim = rows.select("partition", "offset", key)
            tables.claim(spark, folder)
            remembered = tables.handed_over(spark, os.path.join(folder, MEMORY), step)
            if remembered is not None:
                # Partition -1 sorts before the log; the offset is the place in the memory.
                slim = slim.unionByName(
                    remembered.select(
                        F.lit(-1).alias("partition"), F.col("place").alias("offset"), key
                    )
                )
            verdicts = dedup.bounded_memory_verdicts(slim, key, capacity, shards, chunk_bits)
            admitted = slim.join(
                verdicts.filter("admitted").drop("admitted"), ["partition", "offset"]
            ).persist()
            try:
                fresh = rows.join(
                    admitted.filter("partition >= 0").select("partition", "offset"),
                    ["partition", "offset"],
                    "left_semi",
                )
                tables.write_step(fresh, os.path.join(folder, ADMITTED), step)
                shard = dedup.memory_shard(F.col(key), shards)
                newest = Window.partitionBy("_shard").orderBy(
                    F.desc("partition"), F.desc("offset")
                )
                # The newest of each chunk first, so that no task sorts a whole shard.
                chunk = F.shiftright("offset", chunk_bits)
                lately = Window.partitionBy("_shard", "partition", chunk).orderBy(F.desc("offset"))
                kept = (
                    admitted.withColumn("_shard", shard)
                    .withColumn("_age", F.row_number().over(lately))
                    .filter(F.col("_age") <= max(capacity, 1))
                    .withColumn("_age", F.row_number().over(newest))
                    .filter(F.col("_age") <= max(capacity, 1))
                )
                # Places need only order keys within a shard; a shard's ages do that.
                tables.write_step(
                    kept.select(
                        (F.col("_shard") * F.lit(1 << 32) - F.col("_age")).alias("place"), key
                    ),
                    os.path.join(folder, MEMORY),
                    step,
                )
            finally:
                admitted.unpersist()
        finally:
            rows.unpersist()

    return handle
