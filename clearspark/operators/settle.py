"""Settling batches once, or keeping them as dead letters."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspark import schemas
from clearspark.functions import clock, codec
from clearspark.operators import validate

POSITION = ("topic", "partition", "offset")
SETTLED = "settled"


def judge_batches(log: DataFrame, strict_notional: bool = False) -> DataFrame:
    """V2-V5 on a log of batches: adds `batch`, `batch_id` and `reject_reason`.

    An undecodable record gets an id naming its own position, so that two of them
    are never taken for one, and keeps its bytes in `value`.
    """
    decoded = codec.with_batch(log)
    position = F.format_string("unparseable-%s-p%s_%s", "topic", "partition", "offset")
    reason = validate.batch_reject_reason(F.col("batch"), strict_notional)
    identified = decoded.withColumn(
        "batch_id",
        F.when(F.col("batch").isNull(), position).otherwise(F.col("batch.batch_id")),
    )
    return codec.bind(
        identified,
        "reject_reason",
        F.when(F.col("batch").isNull(), schemas.UNPARSEABLE_BATCH).otherwise(reason),
    )


def submission_results(attempts: DataFrame, max_attempts: int) -> DataFrame:
    """Per batch the first success or, after the last allowed try, its error.

    `ok` is NULL while tries are left. `attempts` has (batch_id, attempt, ok, error). One partial aggregation: a batch
    with many tries is folded before the shuffle.
    """
    allowed = attempts.filter(F.col("attempt") <= max_attempts)
    success = F.min(F.when(F.col("ok"), F.col("attempt")))
    last = F.max(F.when(~F.col("ok"), F.struct("attempt", "error")))
    return (
        allowed.groupBy("batch_id")
        .agg(success.alias("_won"), last.alias("_last"))
        .select(
            "batch_id",
            F.when(F.col("_won").isNotNull(), True)
            .when(F.col("_last.attempt") >= max_attempts, False)
            .alias("ok"),
            F.coalesce("_won", F.lit(max(max_attempts, 0))).cast("bigint").alias("attempts"),
            F.when(F.col("_won").isNull(), F.col("_last.error"))
            .otherwise("")
            .alias("last_error"),
        )
    )


def decide(judged: DataFrame, results: DataFrame, max_attempts: int) -> DataFrame:
    """Adds outcome, failure_reason, attempts and last_error to judged batches.

    A valid batch with tries left is pending; with none allowed at all it is exhausted.
    """
    submitted = results.select(
        F.col("batch_id").alias("_key"),
        F.col("ok").alias("_ok"),
        F.col("attempts").alias("_attempts"),
        F.col("last_error").alias("_error"),
    )
    invalid = F.col("reject_reason").isNotNull()
    # Invalid batches may share one id, or none; their position spreads them evenly.
    key = F.when(invalid, F.concat_ws("-", *POSITION)).otherwise(F.col("batch_id"))
    joined = judged.withColumn("_key", key).join(submitted, "_key", "left")
    tried = F.col("_ok").isNotNull()
    exhausted = ~F.coalesce(F.col("_ok"), F.lit(max_attempts > 0))
    failure = (
        F.when(F.col("batch").isNull(), schemas.UNPARSEABLE_BATCH)
        .when(invalid, schemas.VALIDATION_FAILED)
        .when(exhausted, schemas.SUBMIT_EXHAUSTED)
    )
    outcome = (
        F.when(failure.isNotNull(), "dead_letter").when(tried, SETTLED).otherwise("pending")
    )
    return joined.select(
        *judged.columns,
        outcome.alias("outcome"),
        failure.alias("failure_reason"),
        F.when(invalid | ~tried, F.lit(0)).otherwise(F.col("_attempts")).cast("bigint").alias(
            "attempts"
        ),
        F.when(invalid, F.col("reject_reason"))
        .otherwise(F.coalesce("_error", F.lit("")))
        .alias("last_error"),
    )


def settlement_reference(batch_id: Column) -> Column:
    """66 characters, the same for the same batch."""
    return F.concat(F.lit("0x"), F.sha2(batch_id.cast("binary"), 256))


def settle_once(decided: DataFrame, ledger: DataFrame) -> DataFrame:
    """Ledger rows to append for batches that settle now and never did before.

    Redelivered copies within the input give one row, the first in log order.
    """
    won = decided.filter(F.col("outcome") == SETTLED)
    first = won.groupBy("batch_id").agg(
        F.min(F.struct("partition", "offset", "attempts", "batch.trade_count", "batch.total_notional"))
        .alias("_f")
    )
    return first.join(ledger.select("batch_id"), "batch_id", "left_anti").select(
        "batch_id",
        settlement_reference(F.col("batch_id")).alias("tx_hash"),
        F.col("_f.attempts").alias("attempts"),
        F.col("_f.trade_count").alias("trade_count"),
        F.col("_f.total_notional").alias("total_notional"),
    )


def dead_letters(decided: DataFrame, failed_at_ms: Column | None = None) -> DataFrame:
    """The envelope of every batch that will not settle, plus the undecoded bytes.

    The original batch is whole; for an undecodable record it is empty but for the
    id, and `raw_value` holds what was received.
    """
    stamp = clock.now_millis() if failed_at_ms is None else failed_at_ms
    empty = F.from_json(F.lit("{}"), schemas.BATCH)
    stub = codec.zero_filled(empty, schemas.BATCH).withField("batch_id", F.col("batch_id"))
    return decided.filter(F.col("outcome") == "dead_letter").select(
        *[c for c in POSITION if c in decided.columns],
        "batch_id",
        F.coalesce(F.col("batch"), stub).alias("original_batch"),
        "failure_reason",
        "attempts",
        "last_error",
        stamp.alias("failed_at_ms"),
        F.when(F.col("batch").isNull(), F.col("value")).alias("raw_value"),
    )


def dead_letter_messages(letters: DataFrame) -> DataFrame:
    """Keyed messages for the dead-letter log.

    Where the batch could not be decoded, the message has its bytes in base64 as one
    field more, `raw_value`.
    """
    record = F.struct(*[F.col(f.name) for f in schemas.DEAD_LETTER.fields])
    text = codec.encode_dead_letter(record)
    kept = F.concat(F.expr("left(_text, length(_text) - 1)"), F.lit(',"raw_value":"'), F.base64("raw_value"), F.lit('"}'))
    rows = letters.select("batch_id", "raw_value", text.alias("_text"))
    return rows.select(
        F.col("batch_id").cast("binary").alias("key"),
        F.when(F.col("raw_value").isNull(), F.col("_text")).otherwise(kept).cast("binary").alias("value"),
    )
