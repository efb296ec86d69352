"""The three flows as compositions of operators: ingest, publish, settle."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspark.functions import codec
from clearspark.operators import batching, dedup, settle, validate
from clearspark.session import landed


def ingest(trades: DataFrame, strict_notional: bool = True) -> DataFrame:
    """Log of raw trades to log of valid, distinct ones; `value` is passed on as received.

    Rows are judged before the shuffle of the dedup, and only id, position and the
    untouched message go through it.
    """
    good = validate.forwardable(trades, strict_notional)
    return dedup.keep_first(good).drop("trade_id")


def publish(
    normalized: DataFrame,
    flush: batching.Flush,
    created_at_ms: Column | None = None,
    **options: int,
) -> DataFrame:
    """Log of normalized trades to batches; undecodable records count in the offset span.

    Placing batches reads the log more than once. So it is parsed once into a table;
    the passes that only place batches read three narrow columns and a flag of it.
    """
    decoded = codec.with_trade(normalized).select(
        "partition", "offset", "timestamp", "trade", F.col("trade").isNotNull().alias("is_trade")
    )
    rows = landed(decoded, "decoded")
    return batching.build(batching.label(rows, flush, **options), flush, created_at_ms)


def batch_log(batches: DataFrame) -> DataFrame:
    """Batches as a log; each takes the position of its first record."""
    return batching.to_messages(batches).select(
        F.lit("settlement_batches").alias("topic"),
        F.col("first_partition").alias("partition"),
        F.col("first_offset").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        "key",
        "value",
    )


def decide(
    batches: DataFrame, attempts: DataFrame, max_attempts: int, strict_notional: bool = False
) -> DataFrame:
    """Log of batches and table of submission tries to outcomes."""
    judged = settle.judge_batches(batches, strict_notional)
    results = settle.submission_results(attempts, max_attempts)
    return settle.decide(judged, results, max_attempts)
