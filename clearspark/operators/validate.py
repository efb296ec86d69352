"""Validation with explicit reasons; the first broken rule names the reason (V1-V7)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspark import schemas
from clearspark.functions import codec, decimals

# The reasons in the order of the rules, the topic of valid trades.
EMPTY_TRADE_ID = "empty trade_id"
EMPTY_COIN = "empty coin"
INVALID_SIDE = 'invalid side "%s"'
NON_POSITIVE = 'non-positive %s "%s"'
EMPTY_BATCH_ID = "empty batch_id"
NON_POSITIVE_COUNT = "non-positive trade_count %s"
COUNT_MISMATCH = "trade_count %s != len(trades) %s"
INVALID_TRADE = "trade[%s] invalid: %s"
DUPLICATE_TRADE = 'duplicate trade_id "%s" in batch'
TOTAL_MISMATCH = 'total_notional "%s" != recomputed "%s"'

NORMALIZED_TOPIC = "trades.normalized"

# Reasons of our own.
UNPARSEABLE = "unparseable"
INVALID_NOTIONAL = 'invalid notional "%s"'
NO_TOTAL = "sum notionals: unparseable notional"


def trade_reject_reason(trade: Column, strict_notional: bool = True) -> Column:
    """V1: why a trade is invalid, NULL when it is valid.

    `strict_notional` also rejects a notional that is no exact decimal; such a
    trade would otherwise spoil the total of the whole batch it lands in.
    """
    price, size = trade.getField("price"), trade.getField("size")
    side = trade.getField("side")
    reason = (
        F.when(trade.getField("trade_id") == "", EMPTY_TRADE_ID)
        .when(trade.getField("coin") == "", EMPTY_COIN)
        .when(~side.isin(*schemas.SIDES), F.format_string(INVALID_SIDE, side))
    )
    for name, text in (("price", price), ("size", size)):
        fault = F.format_string(NON_POSITIVE, F.lit(name), text)
        reason = reason.when(~decimals.is_positive(text), fault)
    if strict_notional:
        worth = trade.getField("notional")
        reason = reason.when(~decimals.is_number(worth), F.format_string(INVALID_NOTIONAL, worth))
    return reason


def judge_trades(log: DataFrame, strict_notional: bool = True) -> DataFrame:
    """V1, V6, V7: decodes `value` into `trade` and adds `reject_reason`; `value` is untouched."""
    return codec.with_trade(log).withColumn(
        "reject_reason",
        F.when(F.col("trade").isNull(), UNPARSEABLE).otherwise(
            trade_reject_reason(F.col("trade"), strict_notional)
        ),
    )


def accepted(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reject_reason").isNull())


def rejected(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reject_reason").isNotNull())


def forwardable(trades: DataFrame, strict_notional: bool = True) -> DataFrame:
    """V6, V7: the valid records of a log, keyed by coin, with their bytes and `trade_id`."""
    return accepted(judge_trades(trades, strict_notional)).select(
        F.lit(NORMALIZED_TOPIC).alias("topic"),
        "partition",
        "offset",
        "timestamp",
        F.col("trade.coin").cast("binary").alias("key"),
        "value",
        F.col("trade.trade_id").alias("trade_id"),
    )


def _first_bad_trade(trades: Column, strict_notional: bool) -> Column:
    """V3: (index, message) of the first trade breaking V1, NULL when there is none."""
    findings = F.transform(
        trades,
        lambda t, i: F.struct(
            i.alias("at"), trade_reject_reason(t, strict_notional).alias("why")
        ),
    )
    broken = F.filter(findings, lambda f: f["why"].isNotNull())
    # The first of none is NULL.
    return F.get(F.transform(broken, lambda f: F.struct(f["at"].alias("at"), F.format_string(INVALID_TRADE, f["at"], f["why"]).alias("why"))), 0)


def _first_repeated_trade(trades: Column) -> Column:
    """V4: (index, message) of the first trade whose id came before, NULL when ids are distinct."""
    ids = F.transform(trades, lambda t: t["trade_id"])
    repeats = F.filter(
        F.transform(ids, lambda x, i: F.struct(i.alias("at"), x.alias("id"))),
        lambda e: F.array_position(ids, e["id"]) <= e["at"],
    )
    first = F.get(repeats, 0)
    message = F.format_string(DUPLICATE_TRADE, first["id"])
    # The pairwise search runs only for batches the linear distinct test finds repeats in.
    return F.when(
        F.size(F.array_distinct(ids)) < F.size(ids),
        F.struct(first["at"].alias("at"), message.alias("why")),
    )


def batch_reject_reason(batch: Column, strict_notional: bool = False) -> Column:
    """V2-V5: why a batch is invalid, NULL when it is valid."""
    trades, count = batch.getField("trades"), batch.getField("trade_count")
    length = F.size(trades)
    declared = batch.getField("total_notional")

    def of_total(total: Column) -> Column:
        return F.when(total.isNull(), NO_TOTAL).when(
            ~decimals.decimals_equal(total, declared), F.format_string(TOTAL_MISMATCH, declared, total)
        )

    def of_trades(found: Column) -> Column:
        bad, repeat = found["bad"], found["repeat"]
        # Trades are checked in order, rule set before repeat, so the lower index speaks
        # first and the rule set wins on a tie.
        repeat_first = F.coalesce(repeat["at"] < bad["at"], bad.isNull())
        worths = F.transform(trades, lambda t: t["notional"])
        return (
            F.when(repeat.isNotNull() & repeat_first, repeat["why"])
            .when(bad.isNotNull(), bad["why"])
            .otherwise(decimals.let(decimals.exact_array_sum(worths), of_total))
        )

    findings = F.struct(
        _first_bad_trade(trades, strict_notional).alias("bad"), _first_repeated_trade(trades).alias("repeat")
    )
    return (
        F.when(batch.getField("batch_id") == "", EMPTY_BATCH_ID)
        .when(count <= 0, F.format_string(NON_POSITIVE_COUNT, count))
        .when(count != length, F.format_string(COUNT_MISMATCH, count, length))
        .otherwise(decimals.let(findings, of_trades))
    )
