import json

import pytest
from pyspark.sql import functions as F

from clearspark import schemas
from clearspark.functions import codec

TRADE = {
    "trade_id": "1-BTC-2",
    "coin": "BTC",
    "side": "buy",
    "price": "1.50",
    "size": "2",
    "notional": "3.0",
    "event_time_ms": 5,
    "hash": "h",
    "ingest_time_ms": 6,
    "source": "feed",
}
ZERO = ("", "", "", "", "", "", 0, "", 0, "")
BATCH = {
    "batch_id": "b1",
    "created_at_ms": 1,
    "flush_reason": "size",
    "trade_count": 1,
    "total_notional": "3",
    "trades": [TRADE],
    "producer": "p",
}


def decode(spark, texts, with_record, name):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    return [r[name] for r in with_record(rows).orderBy("i").collect()]


def trades(spark, *texts):
    return decode(spark, texts, codec.with_trade, "trade")


def changed(**fields):
    return json.dumps({**TRADE, **fields})


GOOD = {
    json.dumps(TRADE): tuple(TRADE.values()),
    " \n" + json.dumps(TRADE) + "\n ": tuple(TRADE.values()),
    changed(more={"price": 2, "deep": [{"coin": 1}]}): tuple(TRADE.values()),
    changed(more=1.5): tuple(TRADE.values()),
    changed(coin='a"b\\c'): ("1-BTC-2", 'a"b\\c', *list(TRADE.values())[2:]),
    changed(coin="{x}: 5"): ("1-BTC-2", "{x}: 5", *list(TRADE.values())[2:]),
    changed(coin="日本"): ("1-BTC-2", "日本", *list(TRADE.values())[2:]),
    "{}": ZERO,
    "null": ZERO,
    '{"coin":null,"event_time_ms":null}': ZERO,
    '{"event_time_ms":-7}': (*ZERO[:6], -7, *ZERO[7:]),
    '{"event_time_ms" : 7 ,"coin" : "a"}': ("", "a", *ZERO[2:6], 7, *ZERO[7:]),
    '{"c\\u006fin":"a"}': ("", "a", *ZERO[2:]),
}
BAD = [
    "",
    " ",
    "nope",
    "[]",
    "[1]",
    "5",
    '"text"',
    "{",
    '{"coin":"a"',
    '{"coin":"a",}',
    "{'coin':'a'}",
    '{coin:"a"}',
    json.dumps(TRADE) + " x",
    json.dumps(TRADE) * 2,
    json.dumps(TRADE) + "," + json.dumps(TRADE),
    '{"coin":"a"}}',
    '{"coin":"a"}]',
    changed(price=1.5),
    changed(price=True),
    changed(price={"a": 1}),
    changed(price=[]),
    changed(event_time_ms="5"),
    changed(event_time_ms=1.0),
    changed(event_time_ms=True),
    '{"event_time_ms":1e3}',
    '{"event_time_ms":9223372036854775808}',
    '{"event_time_ms":01}',
    '{"c\\u006fin":5}',
    '{"coin" : 5}',
    '{"other":NaN}',
]


def test_good_records(spark):
    found = trades(spark, *GOOD)
    for (text, expected), trade in zip(GOOD.items(), found):
        assert trade is not None and tuple(trade) == expected, text


def test_bad_records(spark):
    for text, trade in zip(BAD, trades(spark, *BAD)):
        assert trade is None, text


def test_null_value(spark):
    assert trades(spark, None) == [None]


@pytest.mark.parametrize(
    "fields,ok",
    [
        ({}, True),
        ({"trades": None}, True),
        ({"trades": []}, True),
        ({"trades": [None]}, True),
        ({"trades": [TRADE, {**TRADE, "more": 1}]}, True),
        ({"trades": 5}, False),
        ({"trades": "x"}, False),
        ({"trades": [5]}, False),
        ({"trades": [[]]}, False),
        ({"trades": [TRADE, {**TRADE, "price": 5}]}, False),
        ({"trades": {"a": 1}}, False),
        ({"trade_count": 1.0}, False),
        ({"other": {"trades": 7, "batch_id": 5}}, True),
    ],
)
def test_batches(spark, fields, ok):
    (batch,) = decode(spark, [json.dumps({**BATCH, **fields})], codec.with_batch, "batch")
    assert (batch is not None) == ok
    if ok:
        assert len(batch.trades) == len({**BATCH, **fields}["trades"] or [])
        assert all(t is not None and t.coin is not None for t in batch.trades)


def test_round_trips(spark):
    letter = {
        "batch_id": "b1",
        "original_batch": BATCH,
        "failure_reason": "validation_failed",
        "attempts": 0,
        "last_error": "x",
        "failed_at_ms": 9,
    }
    for record, schema in (
        (TRADE, schemas.TRADE),
        (BATCH, schemas.BATCH),
        (letter, schemas.DEAD_LETTER),
    ):
        rows = spark.createDataFrame([(json.dumps(record),)], "value string")
        decoded = codec.with_decoded(rows, schema, "r")
        text = decoded.select(codec.encode(F.col("r"), schema).alias("t")).first()["t"]
        assert json.loads(text) == record
        # Declared order, so equal records are equal text.
        assert list(json.loads(text)) == schema.fieldNames()
