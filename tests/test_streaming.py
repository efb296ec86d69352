"""Streams against the batch form, across micro-batches, restarts and replays."""

import time
from decimal import Decimal, localcontext

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clearspark import session
from clearspark.functions import codec, decimals
from clearspark.operators import batching, metrics, validate
from clearspark.operators import reconcile as static
from clearspark.operators.batching import Flush
from clearspark.plans import fixtures, streams
from clearspark.sources import logs
from clearspark.streaming import ingest, memory, publish, reconcile, settle, tables, timeflush
from test_batching import random_log, replay, spans
from test_settle import batch, fails, log, TRIES
from test_validate import GOOD

SMALL = {"chunk_bits": 5, "group_bits": 2}


def normalized(spark, rows):
    """A log of normalized trades; rows are (partition, offset, clock, decodable)."""
    trade = {name: F.lit(value) for name, value in GOOD.items()}
    trade["trade_id"] = F.concat_ws("-", "partition", "offset")
    record = F.struct(*[v.alias(k) for k, v in trade.items()])
    return spark.createDataFrame(rows, "partition int, offset bigint, at bigint, ok boolean").select(
        "partition",
        "offset",
        F.timestamp_micros("at").alias("timestamp"),
        F.when(F.col("ok"), codec.encode_trade(record)).otherwise("{").alias("value"),
    )


def monotone(rows):
    clocks, out = {}, []
    for p, offset, at, ok in rows:
        clocks[p] = max(clocks.get(p, 0), at)
        out.append((p, offset, clocks[p], ok))
    return out


def test_publisher_equals_the_batch_form_and_replays_the_same(spark, tmp_path):
    rows, flush, folder = monotone(random_log(3, n=240)), Flush(5, 40), str(tmp_path)
    handle = publish.publisher(folder, flush, F.lit(1).cast("bigint"), **SMALL)
    cuts = [0, 50, 51, 170, 240]
    for step, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        handle(normalized(spark, rows[lo:hi]), step)
        if step == 2:
            # As after a failure between the writes and the checkpoint.
            handle(normalized(spark, rows[lo:hi]), step)
    for _ in range(2):
        publish.drain(spark, folder, 3, flush, F.lit(1).cast("bigint"))
    assert spans(publish.published(spark, folder).collect()) == replay(rows, 5, 40)


def test_wall_clock_closes_a_waiting_batch_once(spark, tmp_path):
    folder, flush, clock = str(tmp_path), Flush(5, 100), iter([50, 99, 1000, 10**9])
    handle = publish.publisher(folder, flush, now_us=lambda: next(clock), **SMALL)
    some = normalized(spark, [(0, 0, 0, True), (0, 1, 10, True)])
    none = some.limit(0)
    handle(some, 0)
    handle(none, 1)
    assert publish.published(spark, folder).count() == 0
    handle(none, 2)
    # The replayed micro-batch reads the clock of its first run.
    handle(none, 2)
    assert spans(publish.published(spark, folder).collect()) == [(0, 0, 1, 2)]
    assert next(clock) == 10**9


@pytest.fixture
def rocksdb(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, streams.ROCKSDB)
    yield
    spark.conf.unset(name)


def test_one_trade_on_an_idle_log_goes_out_by_time(spark, tmp_path, rocksdb):
    now = time.time_ns() // 1000
    arrived, out, progress = (str(tmp_path / name) for name in ("log", "out", "progress"))
    log = normalized(spark, [(0, 0, now, True), (0, 1, now, False), (1, 0, now, False)])
    log = log.select(F.lit("t").alias("topic"), "partition", "offset", "timestamp", F.lit(b"k").alias("key"), F.col("value").cast("binary"))
    log.write.parquet(arrived)
    flush = Flush(100, 20_000_000)
    query = timeflush.start(logs.stream_log(spark, arrived), out, progress, flush, interval="500 milliseconds")
    try:
        count = lambda: publish.published(spark, out).count()
        while query.lastProgress is None or not query.lastProgress["numInputRows"]:
            assert time.time_ns() // 1000 < now + 60_000_000
            time.sleep(0.2)
            if query.recentProgress and any(p["numInputRows"] for p in query.recentProgress):
                break
        early = count() if time.time_ns() // 1000 < now + flush.max_wait_us else 0
        assert early == 0
        assert timeflush.wait_until(query, lambda: count() > 0, 60)
    finally:
        timeflush.stop(query)
    (one,) = publish.published(spark, out).collect()
    assert (one.batch_id, one.flush_reason, one.trade_count) == ("batch-p0_0_1", "time", 1)
    assert one.created_at_ms * 1000 >= now + flush.max_wait_us


def test_timer_batches_equal_the_batch_form(spark, rocksdb):
    rows = monotone(random_log(5, n=200))
    log = normalized(spark, rows).withColumn("topic", F.lit("t")).withColumn("key", F.lit(b"k")).withColumn("value", F.col("value").cast("binary"))
    trades = sum(r[3] for r in rows)
    folder = streams.fresh_folder(spark, "timer-test")
    log.select("topic", "partition", "offset", "timestamp", "key", "value").write.parquet(folder + "/log")
    query = timeflush.start(logs.stream_log(spark, folder + "/log"), folder + "/out", folder + "/progress", Flush(5, 40))
    try:
        done = lambda: publish.published(spark, folder + "/out").agg(F.sum("trade_count")).first()[0] == trades
        assert timeflush.wait_until(query, done, 60)
    finally:
        timeflush.stop(query)
    assert spans(publish.published(spark, folder + "/out").collect()) == replay(rows, 5, 40)


def test_settler_has_each_batch_once(spark, tmp_path):
    folder = str(tmp_path)
    tries = fails("batch-p0_1_2", 1) + fails("batch-p0_9_9", 0) + fails("batch-p1_0_0", 6, False)
    attempts = spark.createDataFrame(tries, TRIES)
    handle = settle.settler(folder, attempts, 3, F.lit(1).cast("bigint"))
    first = log(spark, batch("batch-p0_1_2", "a"), batch("batch-p1_0_0", "b"), batch("waits", "w"))
    second = log(spark, batch("batch-p0_1_2", "a"), batch("batch-p0_9_9", "c"), "{")
    handle(first, 0)
    before = tables.read_table(spark, f"{folder}/ledger", settle.LEDGER_SCHEMA).collect()
    for _ in range(2):
        handle(second, 1)
    ledger = tables.read_table(spark, f"{folder}/ledger", settle.LEDGER_SCHEMA)
    assert sorted(r.batch_id for r in ledger.collect()) == ["batch-p0_1_2", "batch-p0_9_9"]
    assert [r for r in ledger.collect() if r.batch_id == "batch-p0_1_2"] == before
    letters = spark.read.parquet(f"{folder}/dead_letters").collect()
    assert sorted(r.failure_reason for r in letters) == ["submit_exhausted", "unparseable_batch"]
    waiting = tables.read_step(spark, f"{folder}/pending", 1).collect()
    assert len(waiting) == 1
    later = settle.settler(folder, spark.createDataFrame(fails("waits", 0), TRIES), 3)
    later(first.limit(0), 2)
    found = tables.read_table(spark, f"{folder}/ledger", settle.LEDGER_SCHEMA).collect()
    assert sorted(r.batch_id for r in found) == ["batch-p0_1_2", "batch-p0_9_9", "waits"]


def test_ledger_reads_the_touched_cells_only(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    far = 5 << settle.SPAN_BITS
    names = ["batch-p0_1_2", f"batch-p0_{far}_{far}", "batch-p7_3_4", f"batch-p7_{far}_{far}", "x", "y"]
    tries = [row for name in names for row in fails(name, 0)]
    handle = settle.settler(folder, spark.createDataFrame(tries, TRIES), 3)
    for step in range(2):
        handle(log(spark, *[batch(name, "a") for name in names[3 * step : 3 * step + 3]]), step)
    known = settle.known_in_cells(
        spark, f"{folder}/ledger", spark.createDataFrame([(n,) for n in names[1:3]], "batch_id string")
    )
    assert sorted(r.batch_id for r in known.collect()) == sorted(names[1:3])
    read = {tuple(f.split("/")[-4:-2]) for f in known.inputFiles()}
    assert read == {("log_partition=0", "span=5"), ("log_partition=7", "span=0")}
    # An old delivery long after, beside one that no cell has yet; the step is handled twice.
    again = log(spark, batch(names[0], "a"), batch(names[3], "a"), batch("x", "a"), batch("batch-p9_0_0", "a"))
    late = settle.settler(folder, spark.createDataFrame(tries + fails("batch-p9_0_0", 0), TRIES), 3)
    late(again, 2)
    monkeypatch.setattr(settle, "NAMED_CELLS", 1)
    late(again, 2)
    ledger = tables.read_table(spark, f"{folder}/ledger", settle.LEDGER_SCHEMA)
    found = {r.batch_id: (r.log_partition, r.micro_batch) for r in ledger.collect()}
    assert ledger.count() == 7
    assert found.pop("batch-p9_0_0") == (9, 2)
    assert found == {n: (p, i // 3) for i, (n, p) in enumerate(zip(names, [0, 0, 7, 7, -1, -1]))}


def test_ledger_cells_of_odd_ids(spark):
    rows = spark.createDataFrame([(None,), ("",), ("batch-p99999999999_1_2",), ("batch-p1_2_3-p2_0_0",)], "batch_id string")
    found = settle.with_cell(rows).collect()
    assert [r.log_partition for r in found] == [-1, -1, -1, 1]
    assert found[0].span == found[1].span and all(0 <= r.span < settle.OTHER_SPANS for r in found)


def test_settler_sees_tries_that_come_later(spark, tmp_path):
    folder, tries = str(tmp_path / "out"), str(tmp_path / "tries")
    spark.createDataFrame(fails("other", 1), TRIES).write.parquet(tries)
    handle = settle.settler(folder, lambda: spark.read.schema(TRIES).parquet(tries), 3)
    waits = log(spark, batch("waits", "w"))
    handle(waits, 0)
    handle(waits.limit(0), 1)
    spark.createDataFrame(fails("waits", 0), TRIES).write.mode("append").parquet(tries)
    handle(waits.limit(0), 2)
    found = tables.read_table(spark, f"{folder}/ledger", settle.LEDGER_SCHEMA).collect()
    assert [r.batch_id for r in found] == ["waits"]


def test_reconciliation_equals_the_batch_form_after_each_step(spark):
    letter = lambda name, *ids: f'{{"batch_id":"{name}","original_batch":{batch(name, *ids)}}}'
    given = [
        ("b", 0, batch("one", "x", "y", "x")), ("b", 0, "{"), ("d", 0, letter("early", "z")),
        ("b", 1, batch("two", "y", "v")), ("b", 1, batch("none")), ("d", 1, "broken"), ("other", 1, batch("no", "q")),
        ("d", 2, letter("one", "x", "y")), ("d", 2, letter("one", "x", "y")), ("b", 2, batch("three", "z", trade_count=7)),
        ("b", 3, batch("odd", "x", None)),
    ]
    rows = [(topic, 0, i, None, None, value.encode(), step) for i, (topic, step, value) in enumerate(given)]
    every = spark.createDataFrame(rows, "topic string, partition int, offset bigint, timestamp timestamp, key binary, value binary, step int")
    found = {r.micro_batch: r for r in streams.stream_reconcile(spark, every, "b", "d").collect()}
    assert sorted(found) == [0, 1, 2, 3]
    for step, row in found.items():
        so_far = every.filter(F.col("step") <= step)
        batches = codec.with_batch(so_far.filter("topic = 'b'"))
        expected = static.summary(batches, codec.with_dead_letter(so_far.filter("topic = 'd'"))).first()
        assert row.asDict() == {**expected.asDict(), "micro_batch": step}


def test_totals_of_a_repeated_step(spark, tmp_path):
    folder = str(tmp_path)
    handle = reconcile.totals_after(folder)
    some = spark.createDataFrame([("batch", "p", 3), ("trade", "x", 0), ("dead", "x", 0)], "kind string, id string, declared bigint")
    handle(some.filter("false"), 0)
    for step in (1, 1, 2):
        handle(some, step)
    found = [tuple(r)[:5] for r in reconcile.verdicts(spark, folder, 2).orderBy("micro_batch").collect()]
    assert found == [(0, 0, 0, 0, 0), (1, 3, 1, 0, 1), (2, 6, 2, 0, 2)]
    assert [r.verdict for r in reconcile.verdicts(spark, folder, 2).orderBy("micro_batch").collect()] == ["FAIL", "FAIL", "OK"]


def test_a_missing_hand_over_stops_the_stream(spark, tmp_path):
    some = normalized(spark, [(0, 0, 0, True)])
    with pytest.raises(tables.MissingStep):
        publish.publisher(str(tmp_path), Flush(5, 100), **SMALL)(some, 3)


def test_a_folder_has_one_owner(spark, tmp_path):
    context, folder = spark.sparkContext, str(tmp_path)
    try:
        for query in ("one", "one", None):
            context.setLocalProperty("sql.streaming.queryId", query)
            tables.claim(spark, folder)
        context.setLocalProperty("sql.streaming.queryId", "two")
        with pytest.raises(tables.ForeignFolder):
            tables.claim(spark, folder)
    finally:
        context.setLocalProperty("sql.streaming.queryId", None)


def test_memory_is_carried_over(spark, tmp_path):
    keys, folder = "abacabdbaeffaabbccdd", str(tmp_path)
    rows = [(0, i, k) for i, k in enumerate(keys)]
    handle = memory.remember(folder, "key", capacity=2, shards=1)
    for step, lo in enumerate(range(0, len(rows), 6)):
        part = spark.createDataFrame(rows[lo : lo + 6], "partition int, offset bigint, key string")
        handle(part, step)
        handle(part, step)
    kept, seen = [], []
    for i, key in enumerate(keys):
        if key not in seen:
            seen = [*seen, key][-2:]
            kept.append(i)
    found = spark.read.parquet(f"{folder}/admitted").collect()
    assert sorted(r.offset for r in found) == kept


def run_ingest(spark, source, folder, horizon):
    query = (
        ingest.ingest_stream(
            spark.readStream.schema(source.schema).parquet(f"{folder}/in"), horizon
        )
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start(f"{folder}/out")
    )
    query.awaitTermination()
    return query


def test_streaming_ingest_drops_repeats_and_no_late_row(spark, tmp_path):
    folder = str(tmp_path)
    source = normalized(spark, [(0, i, i * 1_000_000, True) for i in range(1000, 1010)]).coalesce(1)
    late = normalized(spark, [(0, 1, 1_000_000, True)]).coalesce(1)
    far = normalized(spark, [(0, 5000, 5_000_000_000, True)]).coalesce(1)
    for rows in (source, source.limit(5), far, late, source.unionByName(late)):
        rows.write.mode("append").parquet(f"{folder}/in")
        query = run_ingest(spark, source, folder, "1 hour")
        assert not any(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert sorted(r.offset for r in spark.read.parquet(f"{folder}/out").collect()) == [1, *range(1000, 1010), 5000]


def test_batch_form_of_the_whole_log(spark):
    rows = monotone(random_log(3, n=240))
    decoded = codec.with_trade(normalized(spark, rows)).select("partition", "offset", "timestamp", "trade")
    built = batching.build(batching.label(decoded, Flush(5, 40), **SMALL), Flush(5, 40))
    assert spans(built.collect()) == replay(rows, 5, 40)


def test_forwarder_folds_copies_and_loses_nothing_late(spark, tmp_path):
    folder, second = str(tmp_path / "out"), 1_000_000
    handle = ingest.forwarder(folder, 30 * second)
    rows = [(0, i, (1000 + i) * second, True) for i in range(10)]
    some = normalized(spark, rows)
    copies = some.unionByName(some.filter("offset = 3").withColumn("offset", F.lit(77).cast("bigint")))
    handle(copies, 0)
    handle(some.filter("offset < 5"), 1)
    # A replayed micro-batch does not take its own first run for earlier deliveries.
    handle(copies, 0)
    far = normalized(spark, [(0, 500, 5000 * second, True)])
    handle(far, 2)
    late = normalized(spark, [(0, 11, 1 * second, True)])
    handle(late.unionByName(some.filter("offset = 1")), 3)
    found = sorted(r.offset for r in ingest.forwarded(spark, folder).collect())
    assert found == [*range(10), 11, 500]
    # Only the folders of the hash buckets that late rows fall into are read for them.
    handle(late.limit(0), 4)
    handle(late.withColumn("offset", F.lit(12).cast("bigint")), 5)
    assert sorted(r.offset for r in ingest.forwarded(spark, folder).collect()) == [*range(10), 11, 500]


def test_ingest_is_counted_on_the_way(spark, tmp_path):
    folder = str(tmp_path)
    source = normalized(spark, [(0, i, i, i % 4 > 0) for i in range(8)])
    source.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(source.schema).parquet(f"{folder}/in")
    judged = metrics.watch_ingest(validate.judge_trades(stream), "ingest")
    query = (
        judged.writeStream.format("noop")
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    seen = [p["observedMetrics"]["ingest"] for p in query.recentProgress if p["numInputRows"]]
    totals = {k: sum(s.asDict()[k] for s in seen) for k in ("consumed", "accepted", "dropped")}
    assert totals == {"consumed": 8, "accepted": 6, "dropped": 2}


class Kept:
    """A state variable of one key, in memory."""

    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value if isinstance(self.value, tuple) else iter(self.value)

    def update(self, value):
        self.value = value

    def appendList(self, rows):
        self.value = (self.value or []) + rows

    def clear(self):
        self.value = None


class Handle:
    def __init__(self):
        self.timers = []

    def getListState(self, name, schema):
        return Kept()

    getValueState = getListState

    def listTimers(self):
        return iter(self.timers)

    def deleteTimer(self, timer):
        self.timers.remove(timer)

    def registerTimer(self, timer):
        self.timers.append(timer)


@pytest.mark.parametrize("size,wait", [(5, 40), (1, 40), (1 << 62, 40), (3, 1 << 62), (3, 0)])
def test_many_batches_of_a_partition_go_out_in_one_piece(size, wait):
    rows = [r for r in random_log(7, n=900) if r[0] == 0]
    open_batches = timeflush.OpenBatches(size, wait)
    open_batches.init(Handle())
    found, frames = [], 0
    for low, high in ((0, 1), (1, 2), (2, 40), (40, 41), (41, len(rows))):
        frame = pd.DataFrame([(o, at, ok, b"v") for _, o, at, ok in rows[low:high]], columns=timeflush._COLUMNS)
        parts = list(open_batches.handleInputRows((0,), iter([frame.iloc[::-1], frame.iloc[:0]]), None))
        frames += len(parts)
        found += [(int(r.batch_key), int(r.offset)) for part in parts for r in part.itertuples()]
    # Row by row, as the log says it.
    expected, own, trades, first, clock = [], [], 0, 0, -(1 << 62)
    for _, offset, at, ok in rows:
        clock = max(clock, at)
        if trades >= size or (trades and clock - first >= wait):
            expected, own, trades = [*expected, own], [], 0
        if ok and not trades:
            first = clock
        trades += ok
        own.append(offset)
    if trades >= size:
        expected, own, trades = [*expected, own], [], 0
    assert found == [(batch[0], offset) for batch in expected for offset in batch]
    assert frames <= 10
    left = open_batches.held
    assert [r[0] for r in (left.get() if left.exists() else [])] == own
    assert open_batches.head.get()[0] == trades
    assert len(open_batches.handle.timers) == (trades > 0)


def in_parts(rows, cuts, size, wait):
    """What comes out of one micro-batch read in parts, its state, and the most rows that were read and not yet out."""
    open_batches, waiting = timeflush.OpenBatches(size, wait), [0, 0]
    open_batches.init(Handle())

    def parts():
        for low, high in zip(cuts, cuts[1:]):
            waiting[0] += high - low
            waiting[1] = max(waiting)
            yield pd.DataFrame([(o, at, ok, b"v") for _, o, at, ok in rows[low:high]], columns=timeflush._COLUMNS)

    found = []
    for part in open_batches.handleInputRows((0,), parts(), None):
        waiting[0] -= len(part)
        found += [(int(r.batch_key), int(r.offset), int(r.clock_us)) for r in part.itertuples()]
    trades, first_us, clock_us = open_batches.head.get()
    head = (trades, first_us if trades else None, clock_us)
    return found, open_batches.held.value or [], head, open_batches.handle.timers, waiting[1]


@pytest.mark.parametrize("size,wait", [(5, 40), (1, 40), (1 << 62, 40), (3, 1 << 62), (3, 0), (1 << 62, 1 << 62)])
def test_a_micro_batch_goes_out_while_it_is_read(size, wait):
    rows = [r for r in random_log(7, n=900) if r[0] == 0]
    *whole, _ = in_parts(rows, [0, len(rows)], size, wait)
    *parts, most = in_parts(rows, [0, 1, 2, 2, *range(3, len(rows), 16), len(rows)], size, wait)
    assert parts == whole
    if (size, wait) != (1 << 62, 1 << 62):
        assert most < len(rows) / 4


def test_rows_that_come_out_of_order_raise():
    rows = [(0, offset, offset, True) for offset in (0, 1, 5, 3)]
    with pytest.raises(ValueError, match="offset 3 of partition 0 comes after 5"):
        in_parts(rows, [0, 3, 4], 2, 40)


def test_a_micro_batch_of_many_arrow_batches_is_in_offset_order(spark, rocksdb):
    rows = monotone(random_log(5, n=200))
    folder = streams.fresh_folder(spark, "order-test")
    shuffled = normalized(spark, rows).orderBy(F.xxhash64("partition", "offset")).repartition(3)
    log = shuffled.select(F.lit("t").alias("topic"), "partition", "offset", "timestamp", F.lit(b"k").alias("key"), F.col("value").cast("binary"))
    log.write.parquet(folder + "/log")
    check = "spark.sql.streaming.unsupportedOperationCheck"
    before = spark.conf.get(check, None)
    with session.settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "7"}):
        query = timeflush.start(logs.stream_log(spark, folder + "/log"), folder + "/out", folder + "/progress", Flush(5, 40))
        try:
            done = lambda: publish.published(spark, folder + "/out").agg(F.sum("trade_count")).first()[0] == sum(r[3] for r in rows)
            assert timeflush.wait_until(query, done, 60)
        finally:
            timeflush.stop(query)
    assert spans(publish.published(spark, folder + "/out").collect()) == replay(rows, 5, 40)
    assert spark.conf.get(check, None) == before


def test_a_micro_batch_of_many_cells_is_one_folder(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    names = [f"batch-p0_{i << settle.SPAN_BITS}_{i << settle.SPAN_BITS}" for i in range(9)]
    tries = [row for name in names for row in fails(name, 0)]
    handle = settle.settler(folder, spark.createDataFrame(tries, TRIES), 3)
    monkeypatch.setattr(settle, "NAMED_CELLS", 4)
    handle(log(spark, *[batch(name, "a") for name in names[:2]]), 0)
    for _ in range(2):
        handle(log(spark, *[batch(name, "a") for name in names[1:8]]), 1)
    # Known from a wide micro-batch and from a narrow one.
    handle(log(spark, *[batch(name, "a") for name in (names[0], names[5], names[8])]), 2)
    found = {r.batch_id: (r.span, r.micro_batch) for r in settle.read_ledger(spark, f"{folder}/ledger").collect()}
    assert settle.read_ledger(spark, f"{folder}/ledger").count() == 9
    assert found == {name: (i, 0 if i < 2 else 1 if i < 8 else 2) for i, name in enumerate(names)}
    assert len(list((tmp_path / "ledger").glob("*/span=*"))) == 3
    assert [p.name for p in (tmp_path / "ledger_wide").glob("*=*")] == ["micro_batch=1"]


def test_keyed_state_is_on_disk_and_settings_come_back(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    with streams.keyed_state(spark):
        assert spark.conf.get(name) == streams.ROCKSDB
    assert spark.conf.get(name, None) == before


def test_tasks_grow_with_the_rows(spark):
    rows = spark.range(0, 1000, 1, 4)
    assert fixtures.spread(rows, 100).rdd.getNumPartitions() == 10
    assert fixtures.spread(rows).rdd.getNumPartitions() == 4
    assert fixtures.spread(spark.range(0, 1000, 1, 20), 100).rdd.getNumPartitions() == 20
    assert fixtures.spread(rows, 100).distinct().count() == 1000


def test_products_of_few_digits_with_powers(spark):
    pairs = [("1.5e20", "2"), ("-2e-20", "50"), ("0e5", "-3"), ("999999999999999999e3", "-999999999999999999e-40"), ("1" + "9" * 30, "2e7"), ("5e-9", "2e9")]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", decimals.notional(F.col("a"), F.col("b")).alias("product"))
    for row in rows.collect():
        with localcontext(prec=200):
            assert Decimal(row["product"]) == Decimal(row["a"]) * Decimal(row["b"])
        assert not row["product"].startswith("-0.0e") and row["product"] != "-0"


def test_the_passes_that_place_batches_read_a_flag_and_no_trade(spark):
    rows = [(0, o, o // 2, o * 10, True) for o in range(5)] + [(1, 0, 0, 0, False)]
    labelled = spark.createDataFrame(rows, "partition int, offset long, batch_key long, clock_us long, is_trade boolean")
    still_open = publish._open_batches(labelled, batching.Flush(2, None), None)
    assert sorted(map(tuple, still_open.collect())) == [(0, 2), (1, 0)]


def test_rows_are_kept_in_as_many_pieces_as_they_fill(spark):
    with session.keeping(spark) as keep:
        rows = keep(spark.range(100).groupBy(F.col("id") % 50).count())
        rows.count()
        pieces = rows.rdd.getNumPartitions()
    assert not rows.is_cached
    assert pieces < int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_a_settler_judges_each_batch_once(spark, tmp_path, monkeypatch):
    judged, judge = spark.sparkContext.accumulator(0), settle.settle.judge_batches

    def counted(rows, strict_notional):
        count = F.udf(lambda value: judged.add(1) or value, "binary").asNondeterministic()
        return judge(rows.withColumn("value", count(F.col("value").cast("binary"))), strict_notional)

    monkeypatch.setattr(settle.settle, "judge_batches", counted)
    tries = spark.createDataFrame([("b1", 1, True, ""), ("b2", 1, True, "")], "batch_id string, attempt bigint, ok boolean, error string")
    settle.settler(str(tmp_path), tries, 4)(log(spark, batch("b1", "x"), batch("b2", "y")), 0)
    assert judged.value == 2
    assert settle.read_ledger(spark, str(tmp_path / settle.LEDGER)).count() == 2
