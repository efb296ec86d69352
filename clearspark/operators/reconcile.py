"""Proof that no trade was lost or settled twice."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DataLoss(Exception):
    """Fewer distinct trades are accounted for than were expected."""


def _one_per_trade(rows: DataFrame, trades: str, dead: bool, declared: Column) -> DataFrame:
    """A row per trade id; what counts once per record stands on its first row."""
    # Only the ids leave the nested array; the rest of each trade is pruned.
    ids = rows.select(
        declared.alias("_declared"), F.posexplode_outer(F.col(f"{trades}.trade_id"))
    )
    head = F.coalesce(F.col("pos") == 0, F.lit(True))
    return ids.select(
        F.col("col").alias("trade_id"),
        F.lit(dead).alias("dead"),
        F.when(head, 1).otherwise(0).cast("bigint").alias("records"),
        F.when(head, F.col("_declared")).otherwise(0).cast("bigint").alias("declared"),
    )


def summary(batches: DataFrame, letters: DataFrame) -> DataFrame:
    """One row of totals.

    `batches` has a decoded `batch`, `letters` a decoded `dead_letter`; NULL is an
    undecodable record. Those count as dead-letter records, but not as batches.
    """
    both = _one_per_trade(
        batches.filter(F.col("batch").isNotNull()),
        "batch.trades",
        False,
        F.col("batch.trade_count"),
    ).unionByName(
        _one_per_trade(letters, "dead_letter.original_batch.trades", True, F.lit(0))
    )
    # One pass and one shuffle of ids, folded per task first; all totals ride along.
    ids = both.groupBy("trade_id").agg(
        F.max("dead").alias("dead"),
        F.sum(F.when(~F.col("dead"), F.col("records"))).alias("batches"),
        F.sum(F.when(F.col("dead"), F.col("records"))).alias("letters"),
        F.sum("declared").alias("declared"),
    )
    known = F.col("trade_id").isNotNull()
    return ids.agg(
        F.coalesce(F.sum("batches"), F.lit(0)).alias("batches"),
        F.coalesce(F.sum("declared"), F.lit(0)).alias("sum_trade_count"),
        F.count_if(known).alias("distinct_trade_ids"),
        F.coalesce(F.sum("letters"), F.lit(0)).alias("dead_letter_records"),
        F.count_if(known & F.col("dead")).alias("dead_letter_distinct_trade_ids"),
    )


def verdict(totals: DataFrame, expected_minimum: int) -> DataFrame:
    """Adds `verdict`, FAIL when fewer distinct trades than expected are there."""
    lost = F.col("distinct_trade_ids") < expected_minimum
    return totals.withColumn("verdict", F.when(lost, "FAIL").otherwise("OK"))


def assert_no_loss(totals: DataFrame, expected_minimum: int) -> None:
    """R4 as a job step: raises when trades are missing."""
    found = totals.first()["distinct_trade_ids"]
    if found < expected_minimum:
        raise DataLoss(f"expected at least {expected_minimum} distinct trades, got {found}")


def unaccounted(source_ids: DataFrame, batched_ids: DataFrame) -> DataFrame:
    """Trades not in exactly one batch, with what is wrong and how often each occurs.

    Both sides are folded to one row per id before they meet, so an id with many
    copies joins once.
    """
    expected = source_ids.groupBy("trade_id").agg(F.count("*").alias("in_source"))
    found = batched_ids.groupBy("trade_id").agg(F.count("*").alias("in_batches"))
    both = expected.join(found, "trade_id", "full")
    problem = (
        F.when(F.col("in_batches").isNull(), "lost")
        .when(F.col("in_source").isNull(), "unknown")
        .when(F.col("in_batches") > 1, "repeated")
    )
    return (
        both.withColumn("problem", problem)
        .filter(F.col("problem").isNotNull())
        .select(
            "trade_id",
            "problem",
            F.coalesce("in_source", F.lit(0)).alias("in_source"),
            F.coalesce("in_batches", F.lit(0)).alias("in_batches"),
        )
    )
