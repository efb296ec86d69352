"""Reconciliation that follows the logs: totals after each micro-batch (R1-R4 on streams).

What is to be counted becomes facts, each with a key of its own: a record by its position, a
trade by its id, a trade among the dead letters by its id. Keyed state lets each fact
through once, ever, so totals grow by the facts of a micro-batch and nothing that was counted
is read again.
"""

import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clearspark.functions import codec
from clearspark.operators import reconcile
from clearspark.streaming import tables

TOTALS = "totals"
_FACTS = "kind string, id string, declared bigint"
_KEY = ["kind", "id"]
_BATCH, _LETTER, _TRADE, _DEAD = "batch", "letter", "trade", "dead"

TOTALS_SCHEMA = T.StructType(
    [
        T.StructField(name, T.LongType())
        for name in ("batches", "sum_trade_count", "distinct_trade_ids", "dead_letter_records", "dead_letter_distinct_trade_ids")
    ]
)


def _fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Repeats within a part of a task are left out, so a hot id sends few rows to its state."""
    for part in parts:
        yield part.drop_duplicates(_KEY)


def facts(log: DataFrame, batches: str, letters: str) -> DataFrame:
    """What a log of batches and dead letters, told apart by topic, adds to be counted.

    An undecodable batch is no fact, an undecodable letter counts as a record; trades
    without an id are not counted.
    """
    topic = F.col("topic")
    own = log.filter(topic.isin(batches, letters)).withColumns(
        {"_batch": F.when(topic == batches, F.col("value")), "_letter": F.when(topic == letters, F.col("value"))}
    )
    read = codec.with_dead_letter(codec.with_batch(own, "_batch"), "_letter")
    position = F.concat_ws("-", "topic", "partition", "offset")

    def fact(kind: str, key, declared=0):
        return F.struct(F.lit(kind).alias("kind"), key.alias("id"), F.lit(declared).cast("bigint").alias("declared"))

    def each(trades: str, kind: str):
        ids = F.coalesce(F.array_compact(F.array_distinct(F.col(f"{trades}.trade_id"))), F.array().cast("array<string>"))
        return F.transform(ids, lambda trade_id: fact(kind, trade_id))

    dead = "dead_letter.original_batch.trades"
    record = fact(_BATCH, position).withField("declared", F.coalesce("batch.trade_count", F.lit(0)).cast("bigint"))
    of_batch = F.concat(F.array(record), each("batch.trades", _TRADE))
    of_letter = F.concat(F.array(fact(_LETTER, position)), each(dead, _TRADE), each(dead, _DEAD))
    found = F.when(topic == letters, of_letter).when(F.col("batch").isNotNull(), of_batch)
    return read.select(F.inline(found)).mapInPandas(_fold, _FACTS)


def totals_after(folder: str) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` handler for new facts: writes the totals up to this micro-batch, one row."""
    path = os.path.join(folder, TOTALS)

    def handle(micro: DataFrame, step: int) -> None:
        spark = micro.sparkSession
        tables.claim(spark, folder)
        count = lambda kind: F.count_if(F.col("kind") == kind)
        columns = [count(_BATCH), F.coalesce(F.sum("declared"), F.lit(0)), count(_TRADE), count(_LETTER), count(_DEAD)]
        names = TOTALS_SCHEMA.fieldNames()
        added = micro.agg(*[c.alias(n) for c, n in zip(columns, names)])
        before = tables.handed_over(spark, path, step)
        if before is not None:
            added = added.unionByName(before).agg(*[F.sum(n).alias(n) for n in names])
        tables.write_step(added, path, step)

    return handle


def follow(
    log: DataFrame, folder: str, checkpoint: str, batches: str, letters: str, **trigger
) -> StreamingQuery:
    """A running query that keeps totals in `folder`; state grows with the distinct ids.

    The session's state store should be RocksDB where ids do not fit in memory.
    """
    return (
        facts(log, batches, letters)
        .dropDuplicates(_KEY)
        .writeStream.foreachBatch(totals_after(folder))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def totals(spark: SparkSession, folder: str) -> DataFrame:
    """R1-R3 after each micro-batch."""
    return tables.read_table(spark, os.path.join(folder, TOTALS), TOTALS_SCHEMA)


def verdicts(spark: SparkSession, folder: str, expected_minimum: int) -> DataFrame:
    """R4 after each micro-batch."""
    return reconcile.verdict(totals(spark, folder), expected_minimum)
