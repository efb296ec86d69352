import json

from pyspark.sql import functions as F

from clearspark.operators import metrics, normalize

RAW = {
    "coin": "BTC",
    "side": "B",
    "px": "65000.5",
    "sz": "0.01",
    "hash": "0xabc",
    "time": 1710000000000,
    "tid": 42,
    "users": ["a", "b"],
}


def feed(spark, *values):
    rows = [("feed", 0, i, v) for i, v in enumerate(values)]
    log = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string")
    return log.select("topic", "partition", "offset", F.lit(None).cast("timestamp").alias("timestamp"), "value")


def message(*raws, channel="trades"):
    return json.dumps({"channel": channel, "data": list(raws)})


def normalized(spark, *values):
    made = normalize.normalize(feed(spark, *values), "src", F.lit(99).cast("bigint"))
    return made.orderBy("offset", "item").collect()


def test_transform(spark):
    (row,) = normalized(spark, message(RAW))
    t = row.trade
    assert row.reject_reason is None
    assert (t.trade_id, t.side, t.notional) == ("1710000000000-BTC-42", "buy", "650.005")
    assert (t.price, t.size, t.hash, t.event_time_ms) == ("65000.5", "0.01", "0xabc", 1710000000000)
    assert (t.ingest_time_ms, t.source) == (99, "src")


def test_transform_sell(spark):
    (row,) = normalized(spark, message({**RAW, "coin": "ETH", "side": "A", "px": "3000", "sz": "2", "time": 1, "tid": 7}))
    assert (row.trade.side, row.trade.trade_id, row.trade.notional) == ("sell", "1-ETH-7", "6000")


def test_rejects_one_trade_not_the_message(spark):
    bad = [
        ({"coin": ""}, "missing required field"),
        ({"px": ""}, "missing required field"),
        ({"side": "X"}, 'unknown side "X"'),
        ({"px": "abc"}, "unparseable px"),
        ({"sz": "abc"}, "unparseable sz"),
        ({"px": "1e"}, "unparseable px"),
    ]
    rows = normalized(spark, message(*[{**RAW, **b} for b, _ in bad], RAW))
    assert [r.reject_reason for r in rows] == [reason for _, reason in bad] + [None]


def test_missing_raw_field_counts_as_empty(spark):
    (row,) = normalized(spark, message({k: v for k, v in RAW.items() if k != "px"}))
    assert row.reject_reason == "missing required field"


def test_undecodable_array_drops_the_message(spark):
    rows = normalized(spark, message(RAW, {**RAW, "px": 5}), message(), '{"channel":"trades"}', message(RAW))
    assert [(r.offset, r.reject_reason) for r in rows] == [
        (0, "undecodable trades"),
        (2, "undecodable trades"),
        (3, None),
    ]


def test_routes(spark):
    values = {
        message(RAW): "trades",
        message(channel="pong"): "control",
        '{"channel":"subscriptionResponse","data":{}}': "control",
        '{"channel":"book"}': "ignored",
        "{}": "ignored",
        "null": "ignored",
        '{"channel":5}': "bad_envelope",
        "[]": "bad_envelope",
        '{"channel":"trades"': "bad_envelope",
        '{"channel":"trades","data":[]} x': "bad_envelope",
        '{"channel":"trades"}{"channel":"trades"}': "bad_envelope",
        "": "bad_envelope",
    }
    rows = normalize.route_messages(feed(spark, *values)).orderBy("offset").collect()
    assert [r.route for r in rows] == list(values.values())


def test_feed_is_counted_on_the_way(spark):
    from pyspark.sql import Observation

    seen = Observation("feed")
    rows = normalize.normalize(feed(spark, message(RAW, {**RAW, "side": "X"})), "s")
    metrics.watch_feed(rows, seen).collect()
    assert seen.get == {"produced": 1, "skipped": 1}


def test_prices_of_any_size(spark):
    cases = {("0.123456789", "2"): "0.246913578", ("1e-30", "12345678901"): "0.000000000000000000012345678901", ("98765432109876543210.5", "4"): "395061728439506172842"}
    rows = normalized(spark, message(*[{**RAW, "px": px, "sz": sz} for px, sz in cases]))
    assert [(r.reject_reason, r.trade.notional) for r in rows] == [(None, worth) for worth in cases.values()]
