"""Raw feed messages to trades.

Every operator keeps the log position, so each rejected message or trade can be
traced to the record it came from.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspark.functions import clock, codec, decimals

# Channels of the feed, the two taker sides, reasons, shape of a trade id.
TRADES_CHANNEL = "trades"
CONTROL_CHANNELS = ("subscriptionResponse", "pong")
SIDE_OF = {"B": "buy", "A": "sell"}
MISSING_FIELD = "missing required field"
UNKNOWN_SIDE = 'unknown side "%s"'
ID_SEPARATOR = "-"  # of time, coin and tid

# Reasons of our own.
UNDECODABLE = "undecodable trades"
UNPARSEABLE = "unparseable %s"

POSITION = ("topic", "partition", "offset", "timestamp")


def route_messages(log: DataFrame) -> DataFrame:
    """Adds `channel` and `route`: trades, control, ignored or bad_envelope.

    `data` stays an undecoded variant until the channel is known.
    """
    text = F.col("value").cast("string")
    envelope = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    bare = F.trim(text, F.lit(" \t\r\n"))
    # What parses and opens with a brace is an object; null stands for an empty one.
    one_object = (bare.startswith("{") & bare.endswith("}")) | (bare == "null")
    staged = log.withColumn("_json", F.when(one_object, envelope)).select(
        *log.columns,
        (
            F.col("_json").isNotNull()
            & F.try_variant_get("_json", "$[1]", "variant").isNull()
        ).alias("_whole"),
        F.try_variant_get("_json", "$[0].channel", "variant").alias("_channel"),
        F.try_variant_get("_json", "$[0].data", "variant").alias("data"),
    )
    kind = F.coalesce(F.schema_of_variant("_channel"), F.lit("VOID"))
    name = F.coalesce(F.try_variant_get("_channel", "$", "string"), F.lit(""))
    good = F.col("_whole") & kind.isin("STRING", "VOID")
    return (
        codec.bind(staged, "channel", F.when(good, name))
        .drop("_whole", "_channel")
        .withColumn(
            "route",
            F.when(F.col("channel").isNull(), "bad_envelope")
            .when(F.col("channel") == TRADES_CHANNEL, "trades")
            .when(F.col("channel").isin(*CONTROL_CHANNELS), "control")
            .otherwise("ignored"),
        )
    )


def explode_trades(routed: DataFrame) -> DataFrame:
    """One row per raw trade of each trades message.

    A message whose array is undecodable gives one row with a NULL `raw`.
    """
    decoded = codec.with_raw_trades(routed.filter(F.col("route") == "trades"))
    kept = [c for c in POSITION if c in routed.columns]
    # The outer form keeps the undecodable message (NULL array); an empty array has no trades.
    return decoded.filter(F.col("raws").isNull() | (F.size("raws") > 0)).select(
        *kept, F.posexplode_outer("raws").alias("item", "raw")
    )


def decode_side(side: Column) -> Column:
    """Buy or sell, NULL for any other letter."""
    mapped = F.lit(None).cast("string")
    for letter, name in SIDE_OF.items():
        mapped = F.when(side == letter, name).otherwise(mapped)
    return mapped


def trade_identifier(time_ms: Column, coin: Column, tid: Column) -> Column:
    """`{time}-{coin}-{tid}`."""
    return F.concat_ws(ID_SEPARATOR, time_ms.cast("string"), coin, tid.cast("string"))


def raw_reject_reason(raw: Column) -> Column:
    """Why a raw trade cannot become a trade; NULL when it can. First rule wins."""
    px, sz, side = (raw.getField(name) for name in ("px", "sz", "side"))
    return (
        F.when(raw.isNull(), UNDECODABLE)
        .when(
            (raw.getField("coin") == "") | (px == "") | (sz == ""),
            MISSING_FIELD,
        )
        .when(decode_side(side).isNull(), F.format_string(UNKNOWN_SIDE, side))
        .when(~decimals.is_number(px), UNPARSEABLE % "px")
        .when(~decimals.is_number(sz), UNPARSEABLE % "sz")
    )


def to_trade(raw: Column, source: str, ingest_ms: Column) -> Column:
    """The trade struct of an accepted raw trade; `users` is not carried on."""
    coin, time_ms = raw.getField("coin"), raw.getField("time")
    return F.struct(
        trade_identifier(time_ms, coin, raw.getField("tid")).alias("trade_id"),
        coin.alias("coin"),
        decode_side(raw.getField("side")).alias("side"),
        raw.getField("px").alias("price"),
        raw.getField("sz").alias("size"),
        decimals.notional(raw.getField("px"), raw.getField("sz")).alias("notional"),
        time_ms.alias("event_time_ms"),
        raw.getField("hash").alias("hash"),
        ingest_ms.alias("ingest_time_ms"),
        F.lit(source).alias("source"),
    )


def normalize(
    log: DataFrame, source: str = "feed", ingest_ms: Column | None = None
) -> DataFrame:
    """N1-N7 over a feed log: one row per raw trade with `trade` or `reject_reason`."""
    stamp = clock.now_millis() if ingest_ms is None else ingest_ms
    raws = explode_trades(route_messages(log))
    judged = codec.bind(raws, "reject_reason", raw_reject_reason(F.col("raw")))
    made = F.when(F.col("reject_reason").isNull(), to_trade(F.col("raw"), source, stamp))
    return codec.bind(judged, "trade", made)
