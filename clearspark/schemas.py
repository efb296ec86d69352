"""Record layouts of the four logs and of the log itself."""

from pyspark.sql import types as T

# Sides, flush reasons, failure reasons, batch producer tag.
SIDES = ("buy", "sell")
FLUSH_SIZE, FLUSH_TIME = "size", "time"
UNPARSEABLE_BATCH = "unparseable_batch"
VALIDATION_FAILED = "validation_failed"
SUBMIT_EXHAUSTED = "submit_exhausted"
BATCH_PRODUCER = "batch-publisher"

LOG = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
    ]
)

RAW_TRADE = T.StructType(
    [
        T.StructField("coin", T.StringType()),
        T.StructField("side", T.StringType()),
        T.StructField("px", T.StringType()),
        T.StructField("sz", T.StringType()),
        T.StructField("hash", T.StringType()),
        T.StructField("time", T.LongType()),
        T.StructField("tid", T.LongType()),
        T.StructField("users", T.ArrayType(T.StringType())),
    ]
)

TRADE = T.StructType(
    [
        T.StructField("trade_id", T.StringType()),
        T.StructField("coin", T.StringType()),
        T.StructField("side", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("notional", T.StringType()),
        T.StructField("event_time_ms", T.LongType()),
        T.StructField("hash", T.StringType()),
        T.StructField("ingest_time_ms", T.LongType()),
        T.StructField("source", T.StringType()),
    ]
)

BATCH = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("created_at_ms", T.LongType()),
        T.StructField("flush_reason", T.StringType()),
        T.StructField("trade_count", T.LongType()),
        T.StructField("total_notional", T.StringType()),
        T.StructField("trades", T.ArrayType(TRADE)),
        T.StructField("producer", T.StringType()),
    ]
)

DEAD_LETTER = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("original_batch", BATCH),
        T.StructField("failure_reason", T.StringType()),
        T.StructField("attempts", T.LongType()),
        T.StructField("last_error", T.StringType()),
        T.StructField("failed_at_ms", T.LongType()),
    ]
)
