"""Reading and writing keyed logs.

A log is a table in the Kafka row shape: topic, partition, offset, timestamp, key,
value. On files it is a folder of parquet; on Kafka the same columns come from the
connector, which the cluster must provide.
"""

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from clearspark import schemas


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """S3: everything a file log holds now."""
    return spark.read.schema(schemas.LOG).parquet(path)


def stream_log(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """A file log from its earliest record; progress lives in the query's checkpoint."""
    reader = spark.readStream.schema(schemas.LOG)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def _kafka_options(servers: str, topics: Sequence[str]) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        # A gap in the log is data loss, which must stop the query and not be skipped.
        "failOnDataLoss": "true",
    }


def read_kafka(spark: SparkSession, servers: str, topics: Sequence[str]) -> DataFrame:
    """S3, S4 on Kafka: a bounded read of several topics from the start."""
    reader = spark.read.format("kafka").options(**_kafka_options(servers, topics))
    return reader.load().select(*schemas.LOG.fieldNames())


def stream_kafka(
    spark: SparkSession,
    servers: str,
    topics: Sequence[str],
    offsets_per_trigger: int | None = None,
) -> DataFrame:
    """S1, S4 on Kafka."""
    options = _kafka_options(servers, topics)
    if offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(offsets_per_trigger)
    reader = spark.readStream.format("kafka").options(**options)
    return reader.load().select(*schemas.LOG.fieldNames())


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """S2 on Kafka, bounded: the keyed messages of a table."""
    (
        messages.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .save()
    )


def stream_to_kafka(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """S2 on Kafka: a write counts once every replica has it."""
    return (
        messages.select("key", "value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )


def keyed_order(log: DataFrame, tasks: int) -> DataFrame:
    """Rows of one key together and in log order, spread over `tasks` tasks.

    Ranges over (key, partition, offset) rather than a hash of the key: a hot key is
    split into consecutive ranges, and order per key holds across them.
    """
    order = ["key", "partition", "offset"]
    return log.repartitionByRange(tasks, *order).sortWithinPartitions(*order)


def write_log(rows: DataFrame, path: str, tasks: int) -> None:
    """S2 on files: a keyed log; the commit protocol makes the folder whole or absent."""
    keyed_order(rows.select(*schemas.LOG.fieldNames()), tasks).write.mode("overwrite").parquet(path)


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """A file log with the file and the row of it that each record stands in."""
    log = spark.read.schema(schemas.LOG).parquet(path)
    return log.select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )


def ranked(spark: SparkSession, path: str) -> DataFrame:
    """The records of a log that `write_log` wrote, with their place in it from 0.

    Files are in the order of their names, which number the tasks that wrote them; one row
    for each file is all that is counted up in one task.
    """
    rows = _placed(spark, path)
    files = rows.groupBy("_file").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    placed = rows.join(starts, "_file").withColumn("rank", F.col("_start") + F.col("_row"))
    return placed.drop("_file", "_row", "_start", "_rows")


_ORDER = ("keyed", "key", "partition", "offset")
_EDGES = (
    "file string, row bigint, breaks bigint, "
    + ", ".join(f"{side}_{c} {kind}" for side in ("first", "last") for c, kind in zip(_ORDER, ("boolean", "binary", "int", "bigint")))
)


def _breaks_between(before: Sequence[pa.Array], after: Sequence[pa.Array]) -> pa.Array:
    """Where a row does not stand behind the one before it; equal places are no break."""
    descends, same = pa.scalar(False), pa.scalar(True)
    for b, a in zip(before, after):
        descends = pc.or_(descends, pc.and_(same, pc.less(a, b)))
        same = pc.and_(same, pc.equal(a, b))
    return descends


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each stretch of a file that the task reads: its ends and the breaks inside."""
    stretch: dict | None = None

    def closed(row):
        return pa.RecordBatch.from_pydict({name: [value] for name, value in row.items()}, schema=shape)

    shape = pa.schema(
        [("file", pa.string()), ("row", pa.int64()), ("breaks", pa.int64())]
        + [(f"{side}_{c}", kind) for side in ("first", "last") for c, kind in zip(_ORDER, (pa.bool_(), pa.binary(), pa.int32(), pa.int64()))]
    )
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c) for c in _ORDER]
        files, numbers = batch.column("_file"), batch.column("_row")
        follows = pc.and_(pc.equal(files[1:], files[:-1]), pc.equal(numbers[1:], pc.add(numbers[:-1], 1)))
        cuts = [0, *(i + 1 for i in pc.indices_nonzero(pc.invert(follows)).to_pylist()), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            part = [c[low:high] for c in columns]
            ends = {f"{side}_{c}": p[i].as_py() for side, i in (("first", 0), ("last", -1)) for c, p in zip(_ORDER, part)}
            inside = 0
            if high - low > 1:
                inside = pc.sum(_breaks_between([p[:-1] for p in part], [p[1:] for p in part])).as_py() or 0
            file, row = files[low].as_py(), numbers[low].as_py()
            if stretch and (stretch["file"], stretch["next"]) == (file, row):
                last = tuple(stretch["row"][f"last_{c}"] for c in _ORDER)
                inside += tuple(ends[f"first_{c}"] for c in _ORDER) < last
                kept = {name: value for name, value in ends.items() if name.startswith("last_")}
                stretch["row"] |= kept | {"breaks": stretch["row"]["breaks"] + inside}
            else:
                if stretch:
                    yield closed(stretch["row"])
                stretch = {"file": file, "row": {"file": file, "row": row, "breaks": inside, **ends}}
            stretch["next"] = row + high - low
    if stretch:
        yield closed(stretch["row"])


def order_breaks(spark: SparkSession, path: str) -> DataFrame:
    """How many rows of a written log stand before the one that they follow, as `breaks`.

    Rows are compared where they are read; only the ends of each stretch of a file, a few
    rows for each task, are shuffled and compared with the next ones. An absent key is
    before all others; an empty log has no break.
    """
    rows = _placed(spark, path).select(
        "_file", "_row", F.col("key").isNotNull().alias("keyed"), F.coalesce("key", F.lit(b"")).alias("key"),
        F.coalesce("partition", F.lit(-1)).alias("partition"), F.coalesce("offset", F.lit(-1)).alias("offset"),
    )
    order = Window.orderBy("file", "row")
    first = F.struct(*[f"first_{c}" for c in _ORDER])
    behind = F.lag(F.struct(*[f"last_{c}" for c in _ORDER])).over(order)
    ends = rows.mapInArrow(_edges, _EDGES).select(
        (F.col("breaks") + F.coalesce((first < behind).cast("int"), F.lit(0))).alias("breaks")
    )
    return ends.agg(F.coalesce(F.sum("breaks"), F.lit(0)).alias("breaks"))


def union_topics(topics: Mapping[str, DataFrame]) -> DataFrame:
    """Several logs as one, each row naming its topic."""
    merged = None
    for name, log in topics.items():
        named = log.withColumn("topic", F.lit(name))
        merged = named if merged is None else merged.unionByName(named)
    return merged


def topic(log: DataFrame, name: str) -> DataFrame:
    """The branch of one topic."""
    return log.filter(F.col("topic") == name)


def high_water(log: DataFrame) -> DataFrame:
    """Messages and next offset per topic and partition."""
    return log.groupBy("topic", "partition").agg(
        F.count("*").alias("messages"), (F.max("offset") + 1).alias("high_water")
    )
