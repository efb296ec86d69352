"""Stage counters (M1-M5)."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clearspark.functions import decimals
from pyspark.sql import types as T

from clearspark.functions import decimals

# Event lines that a run summary counts.
EVENT_LINES = (
    "batch flushed",
    "batch settled",
    "batch dead-lettered",
    "submit attempt failed",
)

EVENT_LINE = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("component", "msg", "level")]
)


def ingest_counters(judged: DataFrame) -> DataFrame:
    """M1: one row, consumed = forwarded + dropped + deduped.

    Copies are folded per id before the shuffle; no row is numbered to count repeats.
    """
    valid = F.col("reject_reason").isNull()
    per_id = judged.groupBy(F.when(valid, F.col("trade.trade_id")).alias("id")).agg(
        F.count("*").alias("n")
    )
    taken = F.col("id").isNotNull()
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("consumed"),
        F.count_if(taken).alias("forwarded"),
        F.coalesce(F.sum(F.when(~taken, F.col("n"))), F.lit(0)).alias("dropped"),
        F.coalesce(F.sum(F.when(taken, F.col("n") - 1)), F.lit(0)).alias("deduped"),
    )


def feed_counters(normalized: DataFrame) -> DataFrame:
    """M4: one row, trades produced and raw trades or messages skipped."""
    return normalized.agg(
        F.count_if(F.col("trade").isNotNull()).alias("produced"),
        F.count_if(F.col("trade").isNull()).alias("skipped"),
    )


def publisher_counters(batches: DataFrame) -> DataFrame:
    """M2: batches, trades and exact total per flush reason."""
    return decimals.exact_totals(
        batches, ["flush_reason"], F.col("total_notional"), "total_notional", "batches_out", {"trades_out": F.col("trade_count")}
    )


def submitter_counters(decided: DataFrame) -> DataFrame:
    """M3: batches per outcome and failure reason."""
    return decided.groupBy(
        "outcome", F.coalesce("failure_reason", F.lit("")).alias("failure_reason")
    ).agg(F.count("*").alias("batches"))


def watch_ingest(judged: DataFrame, observation: Observation | str) -> DataFrame:
    """M1, M4 without a second pass: counts taken while the rows go by, also on a stream."""
    valid = F.col("reject_reason").isNull()
    return judged.observe(
        observation,
        F.count(F.lit(1)).alias("consumed"),
        F.count_if(valid).alias("accepted"),
        F.count_if(~valid).alias("dropped"),
    )


def watch_feed(normalized: DataFrame, observation: Observation | str) -> DataFrame:
    """M4: trades made and raw trades skipped while a feed is normalized."""
    return normalized.observe(
        observation,
        F.count_if(F.col("trade").isNotNull()).alias("produced"),
        F.count_if(F.col("trade").isNull()).alias("skipped"),
    )


def run_summary(lines: DataFrame, text: str = "value") -> DataFrame:
    """M5: counts of the known event lines per component, from a log of JSON lines."""
    parsed = lines.select(F.from_json(F.col(text).cast("string"), EVENT_LINE).alias("e"))
    return (
        parsed.filter(F.col("e.msg").isin(*EVENT_LINES))
        .groupBy(F.col("e.component").alias("component"), F.col("e.msg").alias("msg"))
        .agg(F.count("*").alias("lines"))
    )
