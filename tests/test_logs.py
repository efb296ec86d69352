import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from clearspark.sources import logs


def sample(spark, n=2000):
    # Two thirds of the rows have one key.
    key = F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7))
    return spark.range(n).select(
        F.lit("trades").alias("topic"),
        (F.col("id") % 2).cast("int").alias("partition"),
        F.col("id").alias("offset"),
        F.timestamp_micros(F.col("id")).alias("timestamp"),
        key.cast("binary").alias("key"),
        F.col("id").cast("string").cast("binary").alias("value"),
    )


def test_keyed_order_splits_a_hot_key_and_keeps_its_order(spark):
    ordered = logs.keyed_order(sample(spark), 8).withColumn("task", F.spark_partition_id())
    rows = ordered.select("task", "key", "partition", "offset").collect()
    hot = [r for r in rows if r.key == b"hot"]
    assert len({r.task for r in hot}) > 2
    by_task = sorted(hot, key=lambda r: r.task)
    assert [(r.partition, r.offset) for r in by_task] == sorted((r.partition, r.offset) for r in hot)


def test_order_of_a_written_log(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = sample(spark).withColumn("key", F.when(F.col("offset") % 5 > 0, F.col("key")))
    logs.write_log(rows, path, 8)
    assert logs.order_breaks(spark, path).first().breaks == 0
    found = logs.ranked(spark, path).orderBy("rank").collect()
    place = lambda r: (r.key is not None, r.key or b"", r.partition, r.offset)
    assert [r.rank for r in found] == list(range(2000))
    assert [place(r) for r in found] == sorted(place(r) for r in found)


def test_breaks_of_order_are_counted(spark, tmp_path):
    inside, across, none = (str(tmp_path / name) for name in ("inside", "across", "none"))
    rows = sample(spark, 40000).withColumn("key", F.lit(b"k")).withColumn("partition", F.lit(0))
    # The two rows of each pair change places.
    rows.coalesce(1).withColumn("offset", F.col("offset").bitwiseXOR(1)).write.parquet(inside)
    assert logs.order_breaks(spark, inside).first().breaks == 20000
    # Each of four files is in order and begins below the end of the one before.
    rows.repartitionByRange(4, F.col("offset") % 4, "offset").sortWithinPartitions("offset").write.parquet(across)
    files = logs.order_breaks(spark, across).first().breaks
    assert files == 3
    rows.filter("false").write.parquet(none)
    assert logs.order_breaks(spark, none).first().breaks == 0
    assert logs.ranked(spark, none).count() == 0


def test_log_round_trip(spark, tmp_path):
    path = str(tmp_path / "log")
    logs.write_log(sample(spark, 50), path, 4)
    assert logs.read_log(spark, path).exceptAll(sample(spark, 50)).isEmpty()


def test_topics_and_high_water(spark):
    merged = logs.union_topics({"a": sample(spark, 10), "b": sample(spark, 5)})
    assert logs.topic(merged, "b").count() == 5
    rows = {(r.topic, r.partition): (r.messages, r.high_water) for r in logs.high_water(merged).collect()}
    assert rows == {("a", 0): (5, 9), ("a", 1): (5, 10), ("b", 0): (3, 5), ("b", 1): (2, 4)}


def test_kafka_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        logs.read_kafka(spark, "localhost:1", ["trades"])
