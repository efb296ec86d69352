import json

import pytest
from pyspark.sql import functions as F

from clearspark.functions import codec
from clearspark.operators import metrics, settle, validate

GOOD = {
    "trade_id": "t1",
    "coin": "BTC",
    "side": "buy",
    "price": "100",
    "size": "2",
    "notional": "200",
    "event_time_ms": 1,
    "hash": "",
    "ingest_time_ms": 1,
    "source": "s",
}


def reasons(spark, *changes, strict=True):
    rows = [(i, json.dumps({**GOOD, **c})) for i, c in enumerate(changes)]
    log = spark.createDataFrame(rows, "i int, value string")
    judged = validate.judge_trades(log, strict).orderBy("i").collect()
    return [r.reject_reason for r in judged]


def test_trade_rules_in_order(spark):
    found = reasons(
        spark,
        {},
        {"trade_id": "", "coin": ""},
        {"coin": "", "side": "weird"},
        {"side": "weird", "price": "0"},
        {"price": "0", "size": "-1"},
        {"size": "-1", "notional": "x"},
        {"price": "abc"},
        {"price": "0.123456789"},
        {"notional": "x"},
        {"notional": "1"},
    )
    assert found == [
        None,
        "empty trade_id",
        "empty coin",
        'invalid side "weird"',
        'non-positive price "0"',
        'non-positive size "-1"',
        'non-positive price "abc"',
        None,
        'invalid notional "x"',
        None,
    ]


def test_notional_is_not_checked_when_lenient(spark):
    assert reasons(spark, {"notional": "x"}, strict=False) == [None]


def test_split_keeps_bytes(spark):
    texts = ['{"trade_id":"t1"', json.dumps({**GOOD, "unknown": [1, 2]})]
    log = spark.createDataFrame([(t,) for t in texts], "value string")
    judged = validate.judge_trades(log)
    assert [r.value for r in validate.accepted(judged).collect()] == texts[1:]
    assert [r.reject_reason for r in validate.rejected(judged).collect()] == ["unparseable"]


def test_counters_add_up(spark):
    texts = [json.dumps({**GOOD, "trade_id": i}) for i in ("a", "b", "a", "a")] + ["x", "y"]
    log = spark.createDataFrame([(t,) for t in texts], "value string")
    c = metrics.ingest_counters(validate.judge_trades(log)).first()
    assert (c.consumed, c.forwarded, c.dropped, c.deduped) == (6, 2, 2, 2)


T2 = {**GOOD, "trade_id": "t2"}
BATCH = {
    "batch_id": "b1",
    "created_at_ms": 1,
    "flush_reason": "size",
    "trade_count": 2,
    "total_notional": "400",
    "trades": [GOOD, T2],
    "producer": "p",
}
WEIRD = {**GOOD, "trade_id": "t3", "side": "weird"}


@pytest.mark.parametrize(
    "changes,reason",
    [
        ({}, None),
        ({"total_notional": "400.00"}, None),
        ({"batch_id": "", "trade_count": 0}, "empty batch_id"),
        ({"trade_count": 0}, "non-positive trade_count 0"),
        ({"trade_count": -1}, "non-positive trade_count -1"),
        ({"trade_count": 2, "trades": [GOOD]}, "trade_count 2 != len(trades) 1"),
        ({"trade_count": 0, "trades": []}, "non-positive trade_count 0"),
        ({"trades": [GOOD, GOOD]}, 'duplicate trade_id "t1" in batch'),
        ({"total_notional": "999"}, 'total_notional "999" != recomputed "400"'),
        ({"total_notional": "abc"}, 'total_notional "abc" != recomputed "400"'),
        ({"trades": [GOOD, WEIRD]}, 'trade[1] invalid: invalid side "weird"'),
        (
            {"trade_count": 3, "trades": [GOOD, GOOD, WEIRD]},
            'duplicate trade_id "t1" in batch',
        ),
        (
            {"trade_count": 3, "trades": [GOOD, WEIRD, GOOD]},
            'trade[1] invalid: invalid side "weird"',
        ),
        (
            {"trade_count": 2, "trades": [WEIRD, WEIRD]},
            'trade[0] invalid: invalid side "weird"',
        ),
        (
            {"trade_count": 3, "trades": [GOOD, T2, {**GOOD, "side": "weird"}]},
            'trade[2] invalid: invalid side "weird"',
        ),
        (
            {"trades": [GOOD, {**T2, "notional": "x"}]},
            "sum notionals: unparseable notional",
        ),
    ],
)
def test_batch_rules(spark, changes, reason):
    rows = spark.createDataFrame([(json.dumps({**BATCH, **changes}),)], "value string")
    judged = codec.with_batch(rows).select(validate.batch_reject_reason(F.col("batch")).alias("r"))
    assert judged.first()["r"] == reason


def test_undecodable_batches_keep_apart(spark):
    log = spark.createDataFrame(
        [("b", 0, 1, "{"), ("b", 0, 2, "{")],
        "topic string, partition int, offset bigint, value string",
    )
    rows = settle.judge_batches(log).orderBy("offset").collect()
    assert [r.batch_id for r in rows] == ["unparseable-b-p0_1", "unparseable-b-p0_2"]
    assert {r.reject_reason for r in rows} == {"unparseable_batch"}
