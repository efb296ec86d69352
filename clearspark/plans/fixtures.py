"""The driver's tables as logs (FIXTURES.md part B)."""

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearspark.functions import clock, codec
from clearspark.operators import batching
from clearspark.plans import flows

PARTITIONS = 4
SOURCE = "feed"
MAX_SIZE = 5
MAX_ATTEMPTS = 4
# Fixed stamps, so that a rerun and the SQL side see the same records.
INGEST_MS = 1_800_000_000_000
CREATED_MS = 1_800_000_001_000
FAILED_MS = 1_800_000_002_000
FAR = 1 << 16
# Rows of a table that one task makes records of.
TASK_ROWS = 1 << 17


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def spread(rows: DataFrame, at_most: int = TASK_ROWS) -> DataFrame:
    """A scan with fewer splits than there are cores, or of more than `at_most` rows each, dealt out anew.

    Parsing is the costly step here, and rows are small in their files: a table of few
    files has few splits, however many rows it has. So the number of tasks grows with
    the rows and no task with the table. A table of many files is left as it is.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    wanted = max(cores, -(-rows.count() // at_most))
    return rows.repartition(wanted) if rows.rdd.getNumPartitions() < wanted else rows


def max_wait_us(events: DataFrame) -> int:
    """MaxWait of FIXTURES.md B1, 36 s over the scale factor; `events` has a million rows per unit."""
    return 36_000_000 * 1_000_000 // max(events.count(), 1)


def event_positions(events: DataFrame) -> DataFrame:
    """`events` with log position and raw trade fields; replays are not in it."""
    micros = clock.wall_micros(F.col("ts"))
    k = F.get_json_object("props", "$.k")
    return events.select(
        "event_id",
        (F.col("event_id") % PARTITIONS).cast("int").alias("partition"),
        (F.col("event_id") * 2).alias("offset"),
        micros.alias("arrival_us"),
        F.col("event_type").alias("coin"),
        F.when(F.col("event_id") % 97 == 0, "X")
        .when(F.col("user_id") % 2 == 0, "B")
        .otherwise("A")
        .alias("side"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("px"),
        k.alias("sz"),
    )


def _raw(**changed: Column) -> Column:
    fields = {
        "coin": F.col("coin"),
        "side": F.col("side"),
        "px": F.col("px"),
        "sz": F.col("sz"),
        "hash": F.concat(F.lit("0x"), F.hex("event_id")),
        "time": clock.millis_of_micros(F.col("arrival_us")),
        "tid": F.col("event_id"),
        "users": F.array(F.lit("maker"), F.lit("taker")),
        **changed,
    }
    return F.struct(*[value.alias(name) for name, value in fields.items()])


def feed_log(events: DataFrame) -> DataFrame:
    """Raw feed messages with control channels, broken messages and pairs of trades.

    By event_id: 0 mod 211 a truncated envelope; 0 mod 223 an undecodable array;
    7, 8, 9 mod 50 pong, subscriptionResponse and an unknown channel; 0 mod 13 a
    second trade with tid + 10^9 and no px. First match wins, down to the second trade.
    """
    e = F.col("event_id")
    rows = event_positions(events)
    channel = (
        F.when(e % 50 == 7, "pong")
        .when(e % 50 == 8, "subscriptionResponse")
        .when(e % 50 == 9, "orderUpdates")
        .otherwise("trades")
    )
    second = _raw(px=F.lit(""), tid=e + 1_000_000_000)
    data = F.when(e % 13 == 0, F.to_json(F.array(_raw(), second))).otherwise(
        F.to_json(F.array(_raw()))
    )
    broken = F.lit('[{"coin":5}]')
    message = F.concat(
        F.lit('{"channel":"'),
        channel,
        F.lit('","data":'),
        F.when(e % 223 == 0, broken).otherwise(data),
        F.lit("}"),
    )
    whole = F.when(e % 211 == 0, F.substring(message, 1, 20)).otherwise(message)
    return _as_log(rows.withColumn("text", whole), "feed", F.col("coin"))


def _as_log(rows: DataFrame, topic: str, key: Column) -> DataFrame:
    return rows.select(
        F.lit(topic).alias("topic"),
        "partition",
        "offset",
        F.timestamp_micros("arrival_us").alias("timestamp"),
        key.cast("binary").alias("key"),
        F.col("text").cast("binary").alias("value"),
    )


def _trade_rows(events: DataFrame) -> DataFrame:
    """Trades as a feed adapter would write them, side X and size 0 included."""
    rows = event_positions(events)
    millis = clock.millis_of_micros(F.col("arrival_us"))
    price, size = F.col("px").cast("decimal(18,8)"), F.col("sz").cast("decimal(18,8)")
    trade = F.struct(
        F.concat_ws("-", millis.cast("string"), "coin", F.col("event_id").cast("string")).alias(
            "trade_id"
        ),
        F.col("coin"),
        F.when(F.col("side") == "B", "buy")
        .when(F.col("side") == "A", "sell")
        .otherwise(F.col("side"))
        .alias("side"),
        F.col("px").alias("price"),
        F.col("sz").alias("size"),
        # Plain product text with its trailing zeros: consumers must compare by value.
        (price * size).cast("decimal(38,2)").cast("string").alias("notional"),
        millis.alias("event_time_ms"),
        F.concat(F.lit("0x"), F.hex("event_id")).alias("hash"),
        F.lit(INGEST_MS).alias("ingest_time_ms"),
        F.lit(SOURCE).alias("source"),
    )
    return rows.withColumn("text", codec.encode_trade(trade))


def trades_log(events: DataFrame, replays: bool = True) -> DataFrame:
    """The `trades` log; event_id 3 mod 10 is delivered a second time at offset + 15."""
    rows = _trade_rows(events)
    log = _as_log(rows, "trades", F.col("coin"))
    if not replays:
        return log
    again = _as_log(
        rows.filter(F.col("event_id") % 10 == 3).withColumn("offset", F.col("offset") + 15),
        "trades",
        F.col("coin"),
    )
    return log.unionByName(again)


def normalized_log(events: DataFrame, truncated: bool = False) -> DataFrame:
    """All events as clean-enough trades, one each; `truncated` breaks event_id 0 mod 211."""
    rows = _trade_rows(events)
    if truncated:
        cut = F.when(F.col("event_id") % 211 == 0, F.substring("text", 1, 30))
        rows = rows.withColumn("text", cut.otherwise(F.col("text")))
    return _as_log(rows, "trades.normalized", F.col("coin"))


def clean_events(events: DataFrame) -> DataFrame:
    return events.filter(
        (F.col("event_id") % 97 != 0)
        & (F.get_json_object("props", "$.k") != "0")
        & (F.col("value") > 0)
    )


def clean_log(events: DataFrame) -> DataFrame:
    """Valid trades, one delivery each, as ingest would leave them."""
    return normalized_log(clean_events(events))


def keyed_by_user(events: DataFrame) -> DataFrame:
    """A log whose keys come back often: the users of `events`."""
    micros = clock.wall_micros(F.col("ts"))
    rows = events.select(
        (F.col("event_id") % PARTITIONS).cast("int").alias("partition"),
        (F.col("event_id") * 2).alias("offset"),
        micros.alias("arrival_us"),
        F.col("user_id").cast("string").alias("user"),
        F.col("event_type").alias("text"),
    )
    return _as_log(rows, "users", F.col("user"))


def corrupted_batches(batches: DataFrame) -> DataFrame:
    """FIXTURES.md B4 as a log: by first offset mod 7, and undecodable where it is 0 mod 17."""
    kind = F.col("first_offset") % 7
    larger = F.transform("trades", lambda t: t.withField("notional", F.concat(t["notional"], F.lit("e30"))))
    trades = (
        F.when(kind == 2, F.concat("trades", F.slice("trades", 1, 1)))
        .when(kind == 4, F.slice("trades", 1, 0))
        .when(kind == 5, larger)
        .otherwise(F.col("trades"))
    )
    count = (
        F.when(kind.isin(0, 2), F.col("trade_count") + 1)
        .when(kind == 4, 0)
        .otherwise(F.col("trade_count"))
    )
    point = F.when(F.col("total_notional").contains("."), "").otherwise(".")
    more = F.col("total_notional").cast("decimal(38,16)") + F.lit(1).cast("decimal(1,0)")
    changed = (
        batches.withColumn("trades", trades)
        .withColumn("trade_count", count.cast("bigint"))
        .withColumn(
            "total_notional",
            F.when(kind == 1, more.cast("decimal(38,2)").cast("string"))
            .when(kind == 5, F.concat("total_notional", F.lit("e30")))
            .when(kind == 6, F.concat("total_notional", point, F.lit("0" * 30 + "1")))
            .otherwise(F.col("total_notional")),
        )
        .withColumn("batch_id", F.when(kind == 3, "").otherwise(F.col("batch_id")))
    )
    log = flows.batch_log(changed)
    cut = F.col("value").cast("string").substr(1, 40).cast("binary")
    return log.withColumn(
        "value", F.when(F.col("offset") % 17 == 0, cut).otherwise(F.col("value"))
    )


def far_apart(batches: DataFrame) -> DataFrame:
    """FIXTURES.md B5: ids that name offsets FAR times as large, so that few share a ledger cell."""
    low = F.col("first_offset") * FAR
    spans = F.array(F.struct(F.col("first_partition").alias("partition"), low.alias("lo"), (low + 1).alias("hi")))
    return batches.withColumn("batch_id", batching.span_identifier(spans))


def reconciled_log(batches: DataFrame, letters: DataFrame) -> DataFrame:
    """FIXTURES.md B6: batches, a part of them twice, and dead letters as one log in steps."""
    first = flows.batch_log(batches).withColumn("step", (F.col("offset") % 3).cast("int"))
    twice = first.filter(F.col("offset") % 5 == 0).withColumns(
        {"offset": F.col("offset") + 1, "step": F.col("step") + 1}
    )
    low = F.regexp_extract(F.col("key").cast("string"), "_([0-9]+)_", 1).cast("bigint")
    step = F.when(low % 7 == 0, 0).otherwise(low % 3 + 1).cast("int")
    dead = letters.select(
        F.lit("dead_letters").alias("topic"),
        F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        "key",
        "value",
        step.alias("step"),
    )
    return first.unionByName(twice).unionByName(dead)


def attempts(batches: DataFrame, tries: int = 6) -> DataFrame:
    """FIXTURES.md B3: outcomes of tries 1..6; batches at first offset 0 mod 11 always fail."""
    low = F.col("first_offset")
    numbered = batches.select(
        "batch_id",
        "first_offset",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(tries).cast("bigint"))).alias("attempt"),
    )
    ok = ((F.floor(low / 2) + F.col("attempt") * 7) % 5 != 0) & (low % 11 != 0)
    return numbered.select(
        "batch_id",
        "attempt",
        ok.alias("ok"),
        F.when(~ok, F.concat(F.lit("transient error, try "), F.col("attempt").cast("string")))
        .otherwise("")
        .alias("error"),
    )
