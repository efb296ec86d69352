"""The registered queries: each runs one or more operators over the driver's whole tables.

Every query is a function of (spark, folder). The ids in the docstrings are those of
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearspark import schemas
from clearspark.functions import clock, codec, decimals
from clearspark.operators import (
    batching,
    dedup,
    metrics,
    normalize,
    reconcile,
    settle,
    validate,
)
from clearspark.plans import fixtures, flows, streams
from clearspark.session import fresh_folder, landed
from clearspark.sources import logs
from clearspark.streaming import settle as stream_settling
from clearspark.streaming import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# One memory over the whole log, in chunks small enough for these tables to have many.
FIFO_CAPACITY, FIFO_SHARDS, FIFO_CHUNK_BITS = 4, 1, 13


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return fixtures.spread(fixtures.table(spark, folder, "events"))


def _by_size() -> batching.Flush:
    return batching.Flush(fixtures.MAX_SIZE, None)


def _by_size_or_time(events: DataFrame) -> batching.Flush:
    return batching.Flush(fixtures.MAX_SIZE, fixtures.max_wait_us(events))


def _stamp(millis: int):
    return F.lit(millis).cast("bigint")


def _money(column: str):
    return F.col(column).cast("decimal(38,16)")


def _three_topics(events: DataFrame) -> DataFrame:
    return logs.union_topics(
        {
            "feed": fixtures.feed_log(events),
            "trades": fixtures.trades_log(events),
            "trades.normalized": fixtures.normalized_log(events),
        }
    )


@query
def topic_high_water(spark, folder):
    """Messages and next offset per topic and partition."""
    # Nothing is parsed here, so the scan's own splits do.
    return logs.high_water(_three_topics(fixtures.table(spark, folder, "events")))


@query
def topic_routing(spark, folder):
    """One bounded read of several topics, taken apart again by name."""
    merged = _three_topics(_events(spark, folder))
    trades = logs.topic(merged, "trades").groupBy("key").agg(F.count("*").alias("trades"))
    feed = logs.topic(merged, "feed").groupBy("key").agg(F.count("*").alias("feed"))
    return trades.join(feed, "key").select(F.col("key").cast("string").alias("coin"), "trades", "feed")


@query
def keyed_order(spark, folder):
    """The log by key, in offset order within key and partition."""
    log = fixtures.trades_log(_events(spark, folder))
    ordered = logs.keyed_order(log, spark.sparkContext.defaultParallelism)
    return ordered.select(F.col("key").cast("string").alias("coin"), "partition", "offset")


@query
def keyed_order_ranks(spark, folder):
    """The place of each row in the log as written, and how often its order breaks."""
    path = fresh_folder(spark, "ordered")
    logs.write_log(fixtures.trades_log(_events(spark, folder)), path, spark.sparkContext.defaultParallelism)
    breaks = logs.order_breaks(spark, path).scalar()
    return logs.ranked(spark, path).select(
        F.col("key").cast("string").alias("coin"), "partition", "offset", "rank", breaks.alias("breaks")
    )


@query
def strict_decode(spark, folder):
    """Damaged records are unparseable, absent fields are zero, unknown ones ignored."""
    log = fixtures.normalized_log(_events(spark, folder))
    text, e = F.col("value").cast("string"), F.floor(F.col("offset") / 2)
    damaged = (
        F.when(e % 11 == 0, F.substring(text, 1, 30))
        .when(e % 11 == 1, F.regexp_replace(text, '"price":"[^"]*"', '"price":1.5'))
        .when(e % 11 == 2, F.concat(text, F.lit(" x")))
        .when(e % 11 == 3, F.regexp_replace(text, '"event_time_ms":', '"event_time_ms":0.'))
        .when(e % 11 == 4, F.regexp_replace(text, '"coin":"[^"]*"', '"coin":null'))
        .when(e % 11 == 5, F.regexp_replace(text, '"coin":', '"more":{"price":2},"coin":'))
        .when(e % 11 == 6, F.concat(text, text))
        .otherwise(text)
    )
    decoded = codec.with_trade(log.withColumn("value", damaged.cast("binary")))
    return decoded.select(
        e.cast("bigint").alias("event_id"),
        F.col("trade").isNotNull().alias("parsed"),
        F.coalesce("trade.coin", F.lit("-")).alias("coin"),
        F.coalesce("trade.price", F.lit("-")).alias("price"),
        F.coalesce("trade.event_time_ms", F.lit(-1)).alias("event_time_ms"),
    )


@query
def encode_round_trip(spark, folder):
    """What is encoded decodes to the same fields."""
    first = codec.with_trade(fixtures.normalized_log(_events(spark, folder)))
    again = first.filter(F.col("trade").isNotNull()).select(
        codec.encode_trade(F.col("trade")).alias("value")
    )
    return codec.with_trade(again).select("trade.*")


@query
def message_routes(spark, folder):
    """Feed messages by channel and what becomes of them."""
    routed = normalize.route_messages(fixtures.feed_log(_events(spark, folder)))
    return routed.groupBy(F.coalesce("channel", F.lit("-")).alias("channel"), "route").agg(
        F.count("*").alias("messages")
    )


def _normalized(spark, folder):
    return normalize.normalize(
        fixtures.feed_log(_events(spark, folder)), fixtures.SOURCE, _stamp(fixtures.INGEST_MS)
    )


@query
def normalize_trades(spark, folder):
    """The trades made from a feed."""
    made = _normalized(spark, folder).filter(F.col("trade").isNotNull())
    return made.select("trade.*")


@query
def normalize_rejects(spark, folder):
    """Raw trades and messages that make no trade, by reason."""
    skipped = _normalized(spark, folder).filter(F.col("trade").isNull())
    return skipped.groupBy("reject_reason").agg(F.count("*").alias("skipped"))


@query
def feed_counters(spark, folder):
    """M4: trades made of a feed and raw trades that make none."""
    return metrics.feed_counters(_normalized(spark, folder))


@query
def exact_notional_by_coin(spark, folder):
    """Exact sums of products, per coin and side; prices range over forty places."""
    made = _normalized(spark, folder).filter(F.col("trade").isNotNull())
    kind = F.floor(F.col("offset") / 2) % 3
    moved = F.when(kind == 0, "e-20").when(kind == 1, "e20").otherwise("")
    worth = decimals.notional(F.concat(F.col("trade.price"), moved), F.col("trade.size"))
    rows = made.select(F.col("trade.coin").alias("coin"), F.col("trade.side").alias("side"), worth.alias("worth"))
    return decimals.exact_totals(rows, ["coin", "side"], F.col("worth"), "notional", "trades")


def _line_texts(spark, folder):
    lines = fixtures.table(spark, folder, "lineitem")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("price"),
        F.col("l_quantity").cast("decimal(18,2)").cast("string").alias("quantity"),
    )


@query
def canonical_decimal(spark, folder):
    """Exact products of decimal texts in shortest form."""
    worth = decimals.notional(F.col("price"), F.col("quantity"))
    return _line_texts(spark, folder).select("l_orderkey", "l_linenumber", worth.alias("worth"))


@query
def decimal_checks(spark, folder):
    """What is a number, what is positive, what is equal by value."""
    rows = _line_texts(spark, folder)
    odd = F.col("l_linenumber") % 7
    text = (
        F.when(odd == 0, F.col("price"))
        .when(odd == 1, F.concat(F.lit("-"), F.col("price")))
        .when(odd == 2, F.concat(F.col("price"), F.lit("000000001")))
        .when(odd == 3, F.concat(F.col("price"), F.lit("x")))
        .when(odd == 4, F.concat(F.col("price"), F.lit("e-9")))
        .when(odd == 5, F.concat(F.lit("1234567890" * 4), F.col("price")))
        .otherwise(F.lit("0.0000012345"))
    )
    shorter = F.regexp_replace("price", r"[.]?0+\z", "")
    return rows.withColumn("text", text).groupBy("l_linenumber").agg(
        F.count("*").alias("n_rows"),
        F.count_if(decimals.is_number(F.col("text"))).alias("numbers"),
        F.count_if(decimals.is_positive(F.col("text"))).alias("positive"),
        F.count_if(decimals.decimals_equal(F.col("text"), F.col("price"))).alias("equal"),
        F.count_if(
            decimals.decimals_equal(F.concat(F.col("price"), F.lit("0")), F.col("price"))
        ).alias("equal_with_zero"),
        F.count_if(decimals.decimals_equal(shorter, F.lit("abc"))).alias("equal_to_text"),
    )


def _judged(spark, folder):
    return validate.judge_trades(fixtures.trades_log(_events(spark, folder)))


@query
def trade_validation_reasons(spark, folder):
    """V1: trades by the first rule they break."""
    return (
        _judged(spark, folder)
        .groupBy(F.coalesce("reject_reason", F.lit("valid")).alias("reason"))
        .agg(F.count("*").alias("trades"))
    )


@query
def ingest_accepted(spark, folder):
    """What ingest forwards, byte for byte."""
    forwarded = flows.ingest(fixtures.trades_log(_events(spark, folder)))
    return forwarded.select(
        "partition",
        "offset",
        F.col("key").cast("string").alias("coin"),
        F.md5("value").alias("value_md5"),
    )


@query
def ingest_counters(spark, folder):
    """M1: consumed = forwarded + dropped + deduped."""
    return metrics.ingest_counters(_judged(spark, folder))


@query
def dedup_keep_first(spark, folder):
    """The first delivery of each trade."""
    decoded = codec.with_trade(fixtures.trades_log(_events(spark, folder))).select(
        "partition", "offset", "trade.trade_id"
    )
    return dedup.keep_first(decoded)


@query
def dedup_lineitem_keys(spark, folder):
    """One line per order and line number, over natural repeats."""
    lines = fixtures.table(spark, folder, "lineitem")
    order = [c for c in lines.columns if c not in ("l_orderkey", "l_linenumber")]
    firsts = dedup.keep_first(lines, ("l_orderkey", "l_linenumber"), order)
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return firsts.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        (price * F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(38,4)").alias("worth"),
    )


@query
def dedup_fifo_bounded(spark, folder):
    """Repeats by a memory of the last admitted keys, here users of events."""
    rows = _events(spark, folder).select(
        (F.col("event_id") % fixtures.PARTITIONS).cast("int").alias("partition"),
        (F.col("event_id") * 2).alias("offset"),
        F.col("user_id").cast("string").alias("user"),
    )
    return dedup.bounded_memory_verdicts(rows, "user", FIFO_CAPACITY, FIFO_SHARDS, FIFO_CHUNK_BITS)


@query
def batch_by_size(spark, folder):
    """Batches without a wait limit."""
    built = flows.publish(fixtures.clean_log(_events(spark, folder)), _by_size())
    return built.select(
        "batch_id", "flush_reason", "trade_count", _money("total_notional").alias("total_notional")
    )


@query
def batch_size_or_time(spark, folder):
    """Batches closed by size or, from their first trade on, by time."""
    events = _events(spark, folder)
    built = flows.publish(fixtures.clean_log(events), _by_size_or_time(events))
    return built.select(
        "batch_id", "flush_reason", "trade_count", _money("total_notional").alias("total_notional")
    )


@query
def batch_with_undecodable(spark, folder):
    """Undecodable records widen the offset span and are no trades."""
    events = _events(spark, folder)
    log = fixtures.normalized_log(events, truncated=True)
    built = flows.publish(log, _by_size_or_time(events))
    return built.select("batch_id", "flush_reason", "trade_count")


@query
def flush_reason_counts(spark, folder):
    """B2, M2: batches, trades and totals by flush reason."""
    events = _events(spark, folder)
    log = fixtures.normalized_log(events)
    return metrics.publisher_counters(flows.publish(log, _by_size_or_time(events)))


@query
def batch_payload(spark, folder):
    """The message of each batch, read back."""
    built = flows.publish(
        fixtures.clean_log(_events(spark, folder)), _by_size(), _stamp(fixtures.CREATED_MS)
    )
    read = codec.with_batch(flows.batch_log(built))
    return read.select(
        F.col("key").cast("string").alias("message_key"),
        "batch.batch_id",
        "batch.created_at_ms",
        "batch.producer",
        "batch.trade_count",
        F.array_join("batch.trades.trade_id", ",").alias("trade_ids"),
        F.array_join("batch.trades.price", ",").alias("prices"),
    )


@query
def batch_validation(spark, folder):
    """V2-V5: damaged batches by reason; batches of unchecked trades are among them."""
    events = _events(spark, folder)
    built = flows.publish(
        fixtures.normalized_log(events), _by_size(), _stamp(fixtures.CREATED_MS)
    )
    judged = settle.judge_batches(fixtures.corrupted_batches(built))
    return judged.select(
        "partition", "offset", F.coalesce("reject_reason", F.lit("valid")).alias("reason")
    )


def _clean_batches(spark, folder):
    """Batches of the clean log, as a table: several steps of a query read them."""
    built = flows.publish(
        fixtures.clean_log(_events(spark, folder)), _by_size(), _stamp(fixtures.CREATED_MS)
    )
    return landed(built, "batches")


def _decided(spark, folder):
    built = _clean_batches(spark, folder)
    log = fixtures.corrupted_batches(built)
    return flows.decide(log, fixtures.attempts(built), fixtures.MAX_ATTEMPTS)


@query
def settlement_outcomes(spark, folder):
    """Every batch settles or becomes a dead letter, with tries and last error."""
    return _decided(spark, folder).select(
        "partition",
        "offset",
        "batch_id",
        "outcome",
        F.coalesce("failure_reason", F.lit("")).alias("failure_reason"),
        "attempts",
        "last_error",
    )


@query
def dead_letters(spark, folder):
    """Dead letters as messages, read back; undecodable bytes are kept."""
    letters = settle.dead_letters(_decided(spark, folder), _stamp(fixtures.FAILED_MS))
    messages = settle.dead_letter_messages(letters)
    read = codec.with_dead_letter(messages)
    return read.select(
        F.col("key").cast("string").alias("message_key"),
        "dead_letter.batch_id",
        "dead_letter.failure_reason",
        "dead_letter.attempts",
        "dead_letter.failed_at_ms",
        F.col("dead_letter.original_batch.trade_count").alias("declared_trades"),
        F.size("dead_letter.original_batch.trades").cast("bigint").alias("kept_trades"),
    )


@query
def submitter_counters(spark, folder):
    """M3: batches by outcome and failure reason."""
    return metrics.submitter_counters(_decided(spark, folder))


@query
def settle_idempotent(spark, folder):
    """Batches delivered twice, a third of them settled before; each settles once."""
    decided = landed(_decided(spark, folder), "decided")
    ledger = decided.filter(
        (F.col("outcome") == settle.SETTLED) & (F.col("offset") % 3 == 0)
    ).select("batch_id")
    again = decided.withColumn("offset", F.col("offset") + 1)
    fresh = settle.settle_once(decided.unionByName(again), ledger)
    return fresh.select("batch_id", "tx_hash", "attempts", "trade_count")


@query
def backoff_schedule(spark, folder):
    """T4: delay per attempt number."""
    attempt = (F.col("event_id") % 13).cast("bigint")
    return (
        _events(spark, folder)
        .select(attempt.alias("attempt"), clock.backoff_ms(attempt, 200, 5000).alias("delay_ms"))
        .groupBy("attempt", "delay_ms")
        .agg(F.count("*").alias("n_rows"))
    )


@query
def jitter_bounds(spark, folder):
    """T5: draws lie in [0, delay], and a second draw for the same try is the same."""
    attempt = (F.col("event_id") % 13).cast("bigint")
    delay = clock.backoff_ms(attempt, 200, 5000)
    rows = _events(spark, folder).select("event_id", attempt.alias("attempt"), delay.alias("delay_ms"))
    draw = clock.jitter_ms(F.col("delay_ms"), F.col("event_id"), F.col("attempt"))
    return rows.withColumn("draw", draw).groupBy("attempt").agg(
        F.count("*").alias("draws"),
        F.count_if(F.col("draw").between(0, F.col("delay_ms"))).alias("within"),
        (F.countDistinct("draw") > 1).alias("spread"),
    )


def _letter_messages(built):
    decided = flows.decide(
        flows.batch_log(built), fixtures.attempts(built), fixtures.MAX_ATTEMPTS
    )
    return settle.dead_letter_messages(settle.dead_letters(decided, _stamp(fixtures.FAILED_MS)))


def _both_logs(spark, folder):
    """All batches as published, and those of them that became dead letters."""
    built = _clean_batches(spark, folder)
    letters = codec.with_dead_letter(_letter_messages(built))
    return codec.with_batch(flows.batch_log(built)), letters


@query
def reconcile_summary(spark, folder):
    """Totals over batches and dead letters, and the verdict on loss."""
    batches, letters = _both_logs(spark, folder)
    events = _events(spark, folder)
    expected = fixtures.clean_events(events).count()
    return reconcile.verdict(reconcile.summary(batches, letters), expected)


@query
def reconcile_lost_repeated(spark, folder):
    """Orders not in exactly one line; ids play the part of trades."""
    orders = fixtures.table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("trade_id")
    )
    lines = fixtures.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("trade_id")
    )
    return reconcile.unaccounted(orders, lines)


@query
def reconcile_trades(spark, folder):
    """Trades with a replay in the batches, and trades dropped at ingest."""
    events = _events(spark, folder)
    source = codec.with_trade(fixtures.trades_log(events, replays=False)).select("trade.trade_id")
    # Published without dedup, so replays land in batches twice.
    kept = validate.accepted(_judged(spark, folder)).drop("trade", "reject_reason")
    built = flows.publish(kept, _by_size())
    return reconcile.unaccounted(
        source, built.select(F.explode("trades.trade_id").alias("trade_id"))
    )


@query
def run_event_summary(spark, folder):
    """M5: event lines of a run, counted by component and message."""
    decided = landed(
        _decided(spark, folder).select("outcome", "attempts"), "decided"
    )
    flushed = decided.select(
        F.lit("batch-publisher").alias("component"),
        F.lit("batch flushed").alias("msg"),
        F.lit(1).alias("n"),
    )
    settled = F.col("outcome") == settle.SETTLED
    ended = decided.select(
        F.lit("chain-submitter").alias("component"),
        F.when(settled, "batch settled").otherwise("batch dead-lettered").alias("msg"),
        F.lit(1).alias("n"),
    )
    # A settled batch failed all its tries but the last.
    failed = decided.select(
        F.lit("chain-submitter").alias("component"),
        F.lit("submit attempt failed").alias("msg"),
        F.when(settled, F.col("attempts") - 1).otherwise(F.col("attempts")).alias("n"),
    )
    noise = decided.select(
        F.lit("ingestor").alias("component"), F.lit("committed batch").alias("msg"), F.lit(1).alias("n")
    )
    lines = flushed.unionByName(ended).unionByName(failed).unionByName(noise).filter("n > 0")
    written = lines.select(
        F.explode(F.array_repeat(F.struct("component", "msg", F.lit("INFO").alias("level")), F.col("n").cast("int"))).alias("line")
    ).select(F.to_json("line").alias("value"))
    return metrics.run_summary(written)


def _in_steps(spark, folder, log):
    """A log cut into arrival steps, with the length of a step."""
    # Two numbers are taken from the scan where it is; only parsing is worth dealing rows out for.
    events = fixtures.table(spark, folder, "events")
    low, high = streams.arrival_bounds(events, clock.wall_micros(F.col("ts")))
    step = streams.arrival_step(F.unix_micros("timestamp"), low, high)
    return log.withColumn("step", step), (high - low) // streams.STEPS + 1


def _replayed_late(spark, folder):
    """The trades log in steps, replays one step behind, a seventh of all in the last; with the length of a step."""
    log, length_us = _in_steps(spark, folder, fixtures.trades_log(_events(spark, folder)))
    replayed, last = F.col("offset") % 2 == 1, F.lit(streams.STEPS - 1)
    late = F.when(F.floor(F.col("offset") / 2) % 7 == 0, last).otherwise(F.least(F.col("step") + replayed.cast("int"), last))
    return log.withColumn("step", late), length_us


@query
def stream_dedup(spark, folder):
    """Streaming ingest by state store; replays come a step later, a seventh of all at the end."""
    log, _ = _replayed_late(spark, folder)
    forwarded = streams.stream_ingest(spark, log, "1 hour")
    return forwarded.select(F.col("key").cast("string").alias("coin"), F.md5("value").alias("value_md5"))


@query
def stream_dedup_by_table(spark, folder):
    """Streaming ingest by looking up ids; most late rows are behind the horizon."""
    log, length_us = _replayed_late(spark, folder)
    forwarded = streams.stream_forward(spark, log, length_us // 4)
    return forwarded.select(
        "partition",
        "offset",
        F.col("key").cast("string").alias("coin"),
        F.md5("value").alias("value_md5"),
    )


@query
def stream_batches(spark, folder):
    """Streaming batches are those of the batch form, wherever micro-batches end."""
    log, _ = _in_steps(spark, folder, fixtures.clean_log(_events(spark, folder)))
    built = streams.stream_publish(spark, log, _by_size_or_time(fixtures.table(spark, folder, "events")))
    return built.select(
        "batch_id", "flush_reason", "trade_count", _money("total_notional").alias("total_notional")
    )


@query
def stream_time_flush(spark, folder):
    """B1, B2: a running publisher whose last batches only timers close, as no record follows."""
    events = _events(spark, folder)
    built = streams.stream_time_flush(spark, fixtures.clean_log(events), _by_size_or_time(events))
    return built.select(
        "batch_id", "flush_reason", "trade_count", _money("total_notional").alias("total_notional")
    )


@query
def stream_restart_no_loss(spark, folder):
    """A run cut off after its writes and repeated loses and repeats nothing."""
    log, _ = _in_steps(spark, folder, fixtures.clean_log(_events(spark, folder)))
    built = streams.stream_publish(spark, log, _by_size_or_time(fixtures.table(spark, folder, "events")), fail_at=1)
    ids = built.select(
        "batch_id", "trade_count", F.posexplode("trades.trade_id").alias("pos", "trade_id")
    )
    per_id = ids.groupBy("trade_id").agg(
        F.count("*").alias("copies"),
        F.count_if(F.col("pos") == 0).alias("batches"),
    )
    return per_id.agg(
        F.sum("batches").alias("batches"),
        F.count("*").alias("distinct_trade_ids"),
        F.sum("copies").alias("trades"),
    )


@query
def stream_settle(spark, folder):
    """Every batch is delivered twice, in two steps; the ledger has it once."""
    built = _clean_batches(spark, folder)
    step = (F.col("offset") % (streams.STEPS - 1)).cast("int")
    # Each record is made once and delivered twice.
    log = fixtures.corrupted_batches(built).withColumn("step", F.explode(F.array(step, step + 1)))
    out = streams.stream_settle(spark, log, fixtures.attempts(built), fixtures.MAX_ATTEMPTS)
    ledger = stream_settling.read_ledger(spark, f"{out}/{stream_settling.LEDGER}")
    return ledger.select("batch_id", "tx_hash", "attempts", "trade_count")


@query
def stream_settle_cells(spark, folder):
    """Batches far apart in the log, a third of them delivered again long after.

    The ledger has each in its cell, from the micro-batch that settled it first.
    """
    built = fixtures.far_apart(_clean_batches(spark, folder))
    last = streams.STEPS - 1
    step, late = (F.col("offset") % last).cast("int"), F.lit(last)
    steps = F.when(F.col("offset") % 3 == 0, F.array(step, late)).otherwise(F.array(step))
    log = fixtures.corrupted_batches(built).withColumn("step", F.explode(steps))
    out = streams.stream_settle(spark, log, fixtures.attempts(built), fixtures.MAX_ATTEMPTS)
    ledger = stream_settling.read_ledger(spark, f"{out}/{stream_settling.LEDGER}")
    return ledger.select("batch_id", "tx_hash", "log_partition", "span", tables.STEP)


@query
def stream_reconcile(spark, folder):
    """Totals after each step of a log whose batches and dead letters come in any order."""
    built = _clean_batches(spark, folder)
    log = fixtures.reconciled_log(built, _letter_messages(built))
    return streams.stream_reconcile(spark, log, "settlement_batches", "dead_letters")


@query
def stream_fifo(spark, folder):
    """The bounded memory carried from micro-batch to micro-batch."""
    events = _events(spark, folder)
    users = fixtures.keyed_by_user(events)
    log, _ = _in_steps(spark, folder, users)
    admitted = streams.stream_remember(spark, log, FIFO_CAPACITY, FIFO_SHARDS)
    return admitted.select("partition", "offset")


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Ingest, batch and settle one log: totals per coin and outcome."""
    events = _events(spark, folder)
    flush = _by_size_or_time(events)
    normalized = landed(flows.ingest(fixtures.trades_log(events)), "normalized")
    built = landed(
        flows.publish(normalized, flush, _stamp(fixtures.CREATED_MS)), "batches"
    )
    decided = flows.decide(
        flows.batch_log(built), fixtures.attempts(built), fixtures.MAX_ATTEMPTS
    )
    coins = F.transform("batch.trades", lambda trade: trade["coin"])
    # A batch counts once for each of its coins, with the first trade in it.
    listed = F.transform("batch.trades", lambda trade, i: F.struct(
        trade["coin"].alias("coin"), trade["notional"].alias("worth"), (F.array_position("coins", trade["coin"]) == i + 1).alias("first")
    ))
    trades = decided.withColumn("coins", coins).select("outcome", F.inline(listed))
    return decimals.exact_totals(
        trades, ["coin", "outcome"], F.col("worth"), "notional", "trades", {"batches": F.col("first").cast("bigint")}
    )


@query
def settled_by_coin(spark, folder):
    """The whole way from raw trades to outcomes."""
    return flagship(spark, folder)
