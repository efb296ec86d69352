"""Batching against the literal cases and against a row-by-row replay."""

import datetime as dt
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clearspark.operators import batching, cutting
from clearspark.operators.batching import Flush

ROWS = "partition int, offset bigint, at bigint, ok boolean"


def log_rows(spark, rows):
    """(partition, offset, clock in microseconds, decodable) rows as labelled input."""
    trade = F.struct(
        F.concat_ws("-", "partition", "offset").alias("trade_id"),
        F.lit("BTC").alias("coin"),
        F.lit("buy").alias("side"),
        F.lit("10").alias("price"),
        F.lit("2").alias("size"),
        F.lit("20.0").alias("notional"),
        F.lit(1).cast("bigint").alias("event_time_ms"),
        F.lit("h").alias("hash"),
        F.lit(1).cast("bigint").alias("ingest_time_ms"),
        F.lit("s").alias("source"),
    )
    return spark.createDataFrame(rows, ROWS).select(
        "partition",
        "offset",
        F.timestamp_micros("at").alias("timestamp"),
        F.when(F.col("ok"), trade).alias("trade"),
    )


def replay(rows, max_size, max_wait):
    """The batches as (partition, lo, hi, trades), one row at a time."""
    out = []
    for partition in sorted({r[0] for r in rows}):
        segment, trades, first, clock = [], 0, None, 0
        for _, offset, at, ok in sorted(r for r in rows if r[0] == partition):
            clock = max(clock, at)
            if trades and (trades >= max_size or clock - first >= max_wait):
                out.append((partition, segment[0], segment[-1], trades))
                segment, trades = [], 0
            segment.append(offset)
            if ok:
                if not trades:
                    first = clock
                trades += 1
        if trades:
            out.append((partition, segment[0], segment[-1], trades))
    return sorted(out)


def batches(spark, rows, flush, **options):
    labelled = batching.label(log_rows(spark, rows), flush, **options)
    built = batching.build(labelled, flush, F.lit(7).cast("bigint"))
    return built.collect()


def spans(built):
    out = []
    for b in built:
        part, lo, hi = b.batch_id.removeprefix("batch-p").split("_")
        out.append((int(part), int(lo), int(hi), b.trade_count))
    return sorted(out)


def random_log(seed, n=400, partitions=3, step=10, broken=0.2):
    rng = random.Random(seed)
    rows, offsets, clocks = [], [0] * partitions, [1_000_000] * partitions
    for _ in range(n):
        # Partition 0 holds most rows, and its clock sometimes steps back or stands still.
        p = 0 if rng.random() < 0.7 else rng.randrange(partitions)
        offsets[p] += rng.choice([1, 1, 1, 2, 40])
        clocks[p] += rng.choice([0, 1, step, step * 5, -3])
        rows.append((p, offsets[p], clocks[p], rng.random() >= broken))
    return rows


@pytest.mark.parametrize("size,wait", [(5, 40), (1, 40), (1000, 60), (4, 1 << 50), (7, 1), (3, 0)])
def test_size_or_time_matches_replay(spark, size, wait):
    rows = [(10 * seed + p, *rest) for seed in range(4) for p, *rest in random_log(seed)]
    flush = Flush(size, wait)
    # Chunks of 16 offsets and groups of 4 chunks put many edges inside batches.
    got = spans(batches(spark, rows, flush, chunk_bits=4, group_bits=2))
    assert got == replay(rows, size, wait)


@pytest.mark.parametrize("size", [1, 4, 50])
def test_size_only_matches_replay(spark, size):
    rows = random_log(9)
    got = spans(batches(spark, rows, Flush(size, None), chunk_bits=4))
    assert got == replay(rows, size, 1 << 60)


def test_time_only_matches_replay(spark):
    rows = random_log(10)
    got = spans(batches(spark, rows, Flush(None, 70), chunk_bits=5, group_bits=1))
    assert got == replay(rows, 1 << 60, 70)


@pytest.mark.parametrize("seed", range(30))
def test_combined_table_equals_table_of_the_whole(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 60))
    clocks = np.cumsum(rng.integers(0, 6, n))
    offsets = np.cumsum(rng.integers(1, 3, n))
    limits = cutting.Limits(int(rng.integers(1, 9)), int(rng.integers(0, 20)))
    cuts = np.sort(rng.integers(0, n + 1, 5))
    parts = [
        cutting.tabulate(o, c, limits)
        for o, c in zip(np.split(offsets, cuts), np.split(clocks, cuts))
    ]
    whole, merged = cutting.tabulate(offsets, clocks, limits), cutting.combine(parts, limits)
    assert whole.n == merged.n
    for name in ("clocks", "counts", "firsts", "starts", "preds"):
        assert getattr(whole, name).tolist() == getattr(merged, name).tolist(), name


def test_size_flush(spark):
    rows = [(0, i, i, True) for i in range(3)]
    assert [b.flush_reason for b in batches(spark, rows, Flush(3, 3_600_000_000))] == ["size"]
    assert [b.flush_reason for b in batches(spark, rows[:2], Flush(3, 3_600_000_000))] == ["time"]


def test_time_flush_is_due_at_exactly_max_wait(spark):
    wait = 5_000_000
    early = [(0, 0, 0, True), (0, 1, wait - 1, True)]
    due = [(0, 0, 0, True), (0, 1, wait, True)]
    assert spans(batches(spark, early, Flush(100, wait))) == [(0, 0, 1, 2)]
    assert spans(batches(spark, due, Flush(100, wait))) == [(0, 0, 0, 1), (0, 1, 1, 1)]


def test_no_trade_makes_no_batch(spark):
    assert batches(spark, [(0, 0, 0, False), (0, 1, 99, False)], Flush(2, 10)) == []


def test_size_below_one_counts_as_one(spark):
    assert len(batches(spark, [(0, i, i, True) for i in range(3)], Flush(0, 100))) == 3


def test_build_counts_and_totals(spark):
    (b,) = batches(spark, [(0, 3, 0, True), (0, 4, 0, True)], Flush(50, 1000))
    assert (b.batch_id, b.trade_count, b.total_notional) == ("batch-p0_3_4", 2, "40")
    assert [t.trade_id for t in b.trades] == ["0-3", "0-4"]
    assert b.created_at_ms == 7 and b.producer == "batch-publisher"


def test_identifier_over_partitions_is_in_numeric_order(spark):
    rows = [(10, 1, 0, True), (2, 4, 0, True), (0, 9, 0, True), (0, 3, 0, False), (2, 1, 0, True)]
    rows.append((10, 4, 0, True))
    labelled = log_rows(spark, rows).withColumn("batch_key", F.lit(0))
    (b,) = batching.build(labelled, Flush(50, 1), keys=("batch_key",)).collect()
    assert b.batch_id == "batch-p0_3_9-p2_1_4-p10_1_4"
    assert b.trade_count == 5 and b.total_notional == "100"


def test_bad_notional_leaves_no_total(spark):
    rows = log_rows(spark, [(0, 0, 0, True)])
    spoiled = rows.withColumn("trade", F.col("trade").withField("notional", F.lit("abc")))
    labelled = spoiled.withColumn("batch_key", F.lit(0))
    (b,) = batching.build(labelled, Flush(1, 1)).collect()
    assert b.total_notional == ""


def test_combining_long_waits_takes_no_loop_over_trades():
    # One batch spans many chunks, so no table can be short.
    limits = cutting.Limits(batching.UNBOUNDED, 10_000_000)
    clocks = np.arange(0, 2_000_000, 4)
    chunks = [cutting.tabulate(c, c, limits) for c in np.split(clocks, 20)]
    merged, whole = cutting.combine(chunks, limits), cutting.tabulate(clocks, clocks, limits)
    assert merged.n == whole.n and merged.clocks.tolist() == whole.clocks.tolist()
    for name in ("counts", "firsts", "starts", "preds"):
        assert np.array_equal(getattr(merged, name), getattr(whole, name)), name


def test_the_clock_of_a_chunk_stands_still_where_it_steps_back_or_is_absent():
    chunk = pa.table({
        "offset": [4, 1, 2, 3, 5], "arrival": [50, 30, None, 70, 90], "is_trade": [True, True, True, False, True],
        "prior_clock": [40] * 5,
    })
    offsets, clocks = cutting._arrays(chunk)
    assert (offsets.tolist(), clocks.tolist()) == ([1, 2, 4, 5], [40, 40, 70, 90])


def test_a_caller_may_keep_the_tables_of_the_chunks(spark):
    rows = spark.range(40).select(
        F.lit(0).alias("partition"), F.col("id").alias("offset"), F.timestamp_micros(F.col("id") * 7).alias("timestamp"), F.lit("t").alias("trade")
    )
    kept = []
    plain = batching.label_by_size_or_time(rows, Flush(3, 30), 3, 1)
    found = batching.label_by_size_or_time(rows, Flush(3, 30), 3, 1, lambda table: kept.append(table) or table)
    assert [table.columns[:3] for table in kept] == [["partition", "_group", "_chunk"]]
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
