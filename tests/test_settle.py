import base64
import json

import pytest
from pyspark.sql import functions as F

from clearspark.functions import codec
from clearspark.operators import reconcile, settle
from test_validate import BATCH, GOOD

LOG = "topic string, partition int, offset bigint, value string"
TRIES = "batch_id string, attempt bigint, ok boolean, error string"


def batch(name, *ids, **changes):
    trades = [{**GOOD, "trade_id": i} for i in ids]
    total = str(200 * len(ids))
    fields = {**BATCH, "batch_id": name, "trades": trades, "trade_count": len(ids), "total_notional": total}
    return json.dumps({**fields, **changes})


def log(spark, *values):
    return spark.createDataFrame([("b", 0, i, v) for i, v in enumerate(values)], LOG)


def decided(spark, values, tries, max_attempts=3):
    judged = settle.judge_batches(log(spark, *values))
    results = settle.submission_results(spark.createDataFrame(tries, TRIES), max_attempts)
    return settle.decide(judged, results, max_attempts)


def fails(name, times, then_ok=True):
    rows = [(name, n, False, f"error {n}") for n in range(1, times + 1)]
    return rows + ([(name, times + 1, True, "")] if then_ok else [])


def test_three_outcomes(spark):
    tries = fails("first", 0) + fails("third", 2) + fails("never", 6, False) + fails("late", 3)
    values = [batch(n, n) for n in ("first", "third", "never", "late")]
    values += ["{", batch("short", "x", trade_count=2)]
    rows = decided(spark, values, tries).orderBy("offset").collect()
    assert [(r.batch_id, r.outcome, r.failure_reason, r.attempts, r.last_error) for r in rows] == [
        ("first", "settled", None, 1, ""),
        ("third", "settled", None, 3, ""),
        ("never", "dead_letter", "submit_exhausted", 3, "error 3"),
        ("late", "dead_letter", "submit_exhausted", 3, "error 3"),
        ("unparseable-b-p0_4", "dead_letter", "unparseable_batch", 0, "unparseable_batch"),
        ("short", "dead_letter", "validation_failed", 0, "trade_count 2 != len(trades) 1"),
    ]


def test_tries_left_is_pending(spark):
    values = [batch("one", "a"), batch("none", "b")]
    rows = decided(spark, values, fails("one", 1, False)).collect()
    assert {r.outcome for r in rows} == {"pending"}


def test_no_try_allowed_is_exhausted(spark):
    (row,) = decided(spark, [batch("a", "a")], fails("a", 0), 0).collect()
    assert (row.outcome, row.failure_reason, row.attempts) == ("dead_letter", "submit_exhausted", 0)


def test_settles_once(spark):
    values = [batch("one", "a"), batch("two", "b"), batch("one", "a")]
    rows = decided(spark, values, fails("one", 0) + fails("two", 0))
    ledger = spark.createDataFrame([("two",)], "batch_id string")
    fresh = settle.settle_once(rows, ledger).collect()
    assert [r.batch_id for r in fresh] == ["one"]
    assert len(fresh[0].tx_hash) == 66 and fresh[0].tx_hash.startswith("0x")
    again = settle.settle_once(rows, ledger).collect()
    assert fresh == again


def test_dead_letters_keep_everything(spark):
    values = ['{"batch_id": 5', batch("never", "a", "b")]
    rows = decided(spark, values, fails("never", 5, False))
    letters = settle.dead_letters(rows, F.lit(7).cast("bigint"))
    raw, whole = letters.orderBy("offset").collect()
    assert raw.raw_value == values[0] and raw.original_batch.trades == []
    assert raw.original_batch.batch_id == "unparseable-b-p0_0"
    assert whole.raw_value is None and whole.failed_at_ms == 7
    messages = settle.dead_letter_messages(letters)
    read = [r.dead_letter for r in codec.with_dead_letter(messages).collect()]
    kept = next(r for r in read if r.batch_id == "never")
    assert [t.trade_id for t in kept.original_batch.trades] == ["a", "b"]
    assert (kept.failure_reason, kept.attempts, kept.last_error) == ("submit_exhausted", 3, "error 3")


def totals(spark, batch_values, letter_values):
    batches = codec.with_batch(log(spark, *batch_values))
    letters = codec.with_dead_letter(log(spark, *letter_values))
    return reconcile.summary(batches, letters)


def test_reconcile_totals(spark):
    letter = json.dumps({"batch_id": "x", "original_batch": json.loads(batch("x", "c", "d"))})
    found = totals(
        spark,
        [batch("1", "a", "b"), batch("2", "b", "c"), batch("3", trade_count=4), "{"],
        [letter, "{", "{}"],
    )
    assert found.first().asDict() == {
        "batches": 3,
        "sum_trade_count": 8,
        "distinct_trade_ids": 4,
        "dead_letter_records": 3,
        "dead_letter_distinct_trade_ids": 2,
    }
    assert reconcile.verdict(found, 4).first()["verdict"] == "OK"
    assert reconcile.verdict(found, 5).first()["verdict"] == "FAIL"
    reconcile.assert_no_loss(found, 4)
    with pytest.raises(reconcile.DataLoss):
        reconcile.assert_no_loss(found, 5)


def test_reconcile_of_nothing(spark):
    found = totals(spark, ["{"], ["{}"]).first()
    assert (found.batches, found.distinct_trade_ids, found.dead_letter_records) == (0, 0, 1)


def test_total_failure_loses_nothing(spark):
    values = [batch(f"b{i}", *[f"{i}-{n}" for n in range(5)]) for i in range(8)]
    tries = [t for i in range(8) for t in fails(f"b{i}", 6, False)]
    rows = decided(spark, values, tries)
    letters = codec.with_dead_letter(settle.dead_letter_messages(settle.dead_letters(rows)))
    found = reconcile.summary(codec.with_batch(log(spark, *values)), letters).first()
    assert found.dead_letter_records == 8
    assert found.dead_letter_distinct_trade_ids == found.distinct_trade_ids == 40


def test_unaccounted(spark):
    source = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "trade_id string")
    found = spark.createDataFrame([("a",), ("c",), ("c",), ("z",)], "trade_id string")
    rows = reconcile.unaccounted(source, found).orderBy("trade_id").collect()
    assert [tuple(r) for r in rows] == [
        ("b", "lost", 1, 0),
        ("c", "repeated", 2, 2),
        ("z", "unknown", 0, 1),
    ]


def test_bytes_of_an_undecodable_batch_reach_the_message(spark):
    letters = settle.dead_letters(decided(spark, ["{broken", batch("ok", "a")], fails("ok", 6, False)))
    found = [json.loads(bytes(r.value)) for r in settle.dead_letter_messages(letters).collect()]
    kept = {r["failure_reason"]: r.get("raw_value") for r in found}
    assert base64.b64decode(kept["unparseable_batch"]) == b"{broken"
    assert kept["submit_exhausted"] is None
