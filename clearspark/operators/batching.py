"""Grouping trades into settlement batches.

Input rows are log rows with `partition`, `offset`, `timestamp` and a decoded
`trade`, NULL where the record is undecodable. Labelling adds `batch_key`; rows of
one partition with one key form a batch. Undecodable rows take part, as they
belong to the offset span of a batch, but are no trades of it.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearspark import schemas
from clearspark.functions import clock, codec, decimals
from clearspark.operators import cutting, sequence

UNBOUNDED = 1 << 62

# Rows of `build`: where the batch begins, then the batch record.
BUILT = T.StructType(
    [
        T.StructField("first_partition", T.IntegerType()),
        T.StructField("first_offset", T.LongType()),
        *schemas.BATCH.fields,
    ]
)


@dataclass(frozen=True)
class Flush:
    """Close a batch at `max_size` trades or `max_wait_us` after its first, size first.

    None lifts a limit. A size below one counts as one.
    """

    max_size: int | None = 50
    max_wait_us: int | None = 10_000_000

    @property
    def size(self) -> int:
        return UNBOUNDED if self.max_size is None else max(self.max_size, 1)

    @property
    def wait(self) -> int:
        return UNBOUNDED if self.max_wait_us is None else self.max_wait_us


def is_trade(rows: DataFrame) -> Column:
    """Whether a row decodes to a trade; from a flag column where there is one.

    On a stored table the flag spares the scans that place batches all of `trade`.
    """
    return F.col("is_trade") if "is_trade" in rows.columns else F.col("trade").isNotNull()


def label_by_size(
    rows: DataFrame, max_size: int, chunk_bits: int = sequence.CHUNK_BITS
) -> DataFrame:
    """B1 without a wait limit: the batch is the number of earlier trades over the size."""
    size = max(max_size, 1)
    placed = sequence.count_before(rows, is_trade(rows), "_place", chunk_bits)
    return placed.withColumn("batch_key", F.expr(f"_place div {size}")).drop("_place")


def batch_marks(
    rows: DataFrame,
    flush: Flush,
    chunk_bits: int = sequence.CHUNK_BITS,
    group_bits: int = 8,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """B1: one row per batch and chunk it touches, saying where the batch starts.

    Only positions and clocks take part, never the trades themselves. The tables of the
    chunks are read twice; a caller that can drop them again has them kept by `keep`.
    """
    limits = cutting.Limits(flush.size, flush.wait)
    slim = sequence.with_chunk(
        rows.select(
            "partition",
            "offset",
            F.unix_micros("timestamp").alias("_arrival"),
            is_trade(rows).alias("is_trade"),
        ),
        chunk_bits,
    )
    # A clock that steps back is read as standing still.
    peaks = slim.groupBy("partition", "_chunk").agg(F.max("_arrival").alias("_peak"))
    priors = peaks.select(
        "partition",
        "_chunk",
        F.coalesce(sequence.before_chunk(F.max("_peak")), F.lit(0)).alias("prior_clock"),
    )
    # Within a chunk the clock runs where the chunk is tabulated, which sorts it anyway.
    timed = slim.join(priors, ["partition", "_chunk"]).select(
        "partition", "_chunk", "offset", "is_trade", "prior_clock", F.col("_arrival").alias("arrival")
    )
    chunks = timed.groupBy("partition", "_chunk")
    tables = chunks.applyInArrow(
        cutting.chunk_tabulator(limits, group_bits), cutting.TABLE_SCHEMA
    )
    tables = keep(tables) if keep else tables
    grouped = tables.groupBy("partition", "_group")
    groups = grouped.applyInArrow(cutting.group_combiner(limits), cutting.TABLE_SCHEMA)
    group_edges = (
        groups.groupBy("partition")
        .applyInArrow(cutting.partition_scanner(limits), cutting.OPEN_SCHEMA)
        .withColumnRenamed("_chunk", "_group")
    )
    chunk_edges = grouped.cogroup(group_edges.groupBy("partition", "_group")).applyInArrow(
        cutting.group_scanner(limits), cutting.OPEN_SCHEMA
    )
    return chunks.cogroup(chunk_edges.groupBy("partition", "_chunk")).applyInArrow(
        cutting.chunk_walker(limits), cutting.MARK_SCHEMA
    )


def label_by_size_or_time(
    rows: DataFrame,
    flush: Flush,
    chunk_bits: int = sequence.CHUNK_BITS,
    group_bits: int = 8,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """B1: `batch_key` is the first offset of the batch before, -1 for the first batch.

    Also adds `clock_us`, the arrival clock with steps back taken out.
    Named so, an undecodable row after the close of a batch already has the key of
    the batch still to open.
    """
    marks = batch_marks(rows, flush, chunk_bits, group_bits, keep)
    mark = F.struct("batch_start", "batch_pred", "batch_first", "batch_base", "prior_clock")
    marked = (
        sequence.with_chunk(rows, chunk_bits)
        .withColumn("_is_row", F.lit(True))
        .unionByName(
            marks.select(
                "partition",
                "_chunk",
                "offset",
                mark.alias("_mark"),
                F.lit(False).alias("_is_row"),
            ),
            allowMissingColumns=True,
        )
    )
    # A mark sorts before the row at its offset; the edge mark before all rows.
    so_far = (
        Window.partitionBy("partition", "_chunk")
        .orderBy("offset", "_is_row")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    trade = is_trade(rows)
    # One sort and one pass over the chunk serve all three.
    placed = marked.select(
        *rows.columns,
        "_is_row",
        F.last("_mark", ignorenulls=True).over(so_far).alias("_now"),
        F.count_if(trade).over(so_far).alias("_count"),
        F.max(F.unix_micros("timestamp")).over(so_far).alias("_clock"),
    ).filter("_is_row")
    now = F.col("_now")
    at = F.greatest("_clock", now["prior_clock"])
    full = F.col("_count") - now["batch_base"] >= flush.size
    late = at - now["batch_first"] >= flush.wait
    closed = ~trade & (now["batch_start"] >= 0) & (full | late)
    return placed.select(
        *rows.columns,
        F.when(closed, now["batch_start"]).otherwise(now["batch_pred"]).alias("batch_key"),
        at.alias("clock_us"),
    )


def label(
    rows: DataFrame,
    flush: Flush,
    chunk_bits: int = sequence.CHUNK_BITS,
    group_bits: int = 8,
) -> DataFrame:
    if flush.max_wait_us is None and flush.max_size is not None:
        return label_by_size(rows, flush.max_size, chunk_bits)
    return label_by_size_or_time(rows, flush, chunk_bits, group_bits)


def span_identifier(spans: Column) -> Column:
    """`batch-p{partition}_{lo}_{hi}...`, partitions in numeric order."""
    parts = F.transform(
        F.array_sort(spans),
        lambda s: F.concat(
            F.lit("p"), F.concat_ws("_", *[s[n].cast("string") for n in ("partition", "lo", "hi")])
        ),
    )
    return F.concat(F.lit("batch-"), F.array_join(parts, "-"))


def build(
    labelled: DataFrame,
    flush: Flush,
    created_at_ms: Column | None = None,
    keys: tuple[str, ...] = ("partition", "batch_key"),
) -> DataFrame:
    """One row per batch, with `first_partition`, `first_offset` as its position.

    The open batch at the end of the log goes out with reason `time`; rows after the
    last close with no trade among them make no batch. With `keys` that leave out
    the partition a batch may span partitions.
    """
    stamp = clock.now_millis() if created_at_ms is None else created_at_ms
    trade = F.col("trade").isNotNull()
    worth = decimals.plain_decimal(F.col("trade.notional"), decimals.MONEY)
    shares = (
        labelled.withColumn("_worth", worth)
        .groupBy(*dict.fromkeys([*keys, "partition"]))
        .agg(
            F.collect_list(
                F.when(trade, F.struct("partition", "offset", "trade"))
            ).alias("_ordered"),
            F.count_if(trade & F.col("_worth").isNull()).alias("_odd"),
            F.sum("_worth").cast(decimals.TOTAL).alias("_total"),
            F.min("offset").alias("_lo"),
            F.max("offset").alias("_hi"),
        )
        .withColumn(
            "_spans",
            F.array(
                F.struct("partition", F.col("_lo").alias("lo"), F.col("_hi").alias("hi"))
            ),
        )
    )
    if "partition" not in keys:
        shares = shares.groupBy(*keys).agg(
            F.flatten(F.collect_list("_ordered")).alias("_ordered"),
            F.sum("_odd").alias("_odd"),
            F.sum("_total").cast(decimals.TOTAL).alias("_total"),
            F.array_sort(F.flatten(F.collect_list("_spans"))).alias("_spans"),
        )
    count = F.size("_ordered").cast("bigint")
    # Only a batch with an amount that is not plain is summed again, from its trades.
    odd = decimals.exact_array_sum(F.transform("_ordered", lambda e: e["trade"]["notional"]))
    total = F.when(F.col("_odd") == 0, decimals.canonical_text(F.col("_total"))).otherwise(odd)
    return shares.filter(F.size("_ordered") > 0).select(
        F.col("_spans")[0]["partition"].alias("first_partition"),
        F.col("_spans")[0]["lo"].alias("first_offset"),
        span_identifier(F.col("_spans")).alias("batch_id"),
        stamp.alias("created_at_ms"),
        F.when(count >= flush.size, schemas.FLUSH_SIZE)
        .otherwise(schemas.FLUSH_TIME)
        .alias("flush_reason"),
        count.alias("trade_count"),
        # An unparseable notional leaves no total; the batch then fails validation.
        F.coalesce(total, F.lit("")).alias("total_notional"),
        F.transform(F.array_sort("_ordered"), lambda e: e["trade"]).alias("trades"),
        F.lit(schemas.BATCH_PRODUCER).alias("producer"),
    )


def batch_record() -> Column:
    """The BATCH struct of a row of `build`."""
    return F.struct(*[F.col(f.name) for f in schemas.BATCH.fields])


def to_messages(batches: DataFrame) -> DataFrame:
    """One keyed message per batch, the whole batch in it."""
    return batches.select(
        "first_partition",
        "first_offset",
        F.col("batch_id").cast("binary").alias("key"),
        codec.encode_batch(batch_record()).cast("binary").alias("value"),
    )
