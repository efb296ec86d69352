"""Positions in a log partition without putting a partition in one task.

A partition may hold a third of all rows, so nothing is ordered per partition.
Rows are grouped by (partition, chunk), a chunk being a fixed span of offsets.
Offsets are unique in a partition, which bounds every group by the span. Only one
small row per chunk is ever ordered over the whole partition.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_BITS = 18


def with_chunk(rows: DataFrame, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    return rows.withColumn("_chunk", F.shiftright("offset", chunk_bits))


def before_chunk(measure: Column) -> Column:
    """A measure over all earlier chunks of the partition, for a table of one row per chunk."""
    earlier = (
        Window.partitionBy("partition")
        .orderBy("_chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return measure.over(earlier)


def count_before(
    rows: DataFrame, counted: Column, name: str, chunk_bits: int = CHUNK_BITS
) -> DataFrame:
    """Adds how many `counted` rows precede this one in its partition."""
    chunked = with_chunk(rows, chunk_bits).withColumn("_counted", counted.cast("bigint"))
    # Partial sums leave each map task as one row per chunk.
    per_chunk = chunked.groupBy("partition", "_chunk").agg(F.sum("_counted").alias("_n"))
    bases = per_chunk.select(
        "partition", "_chunk", F.coalesce(before_chunk(F.sum("_n")), F.lit(0)).alias("_base")
    )
    inside = (
        Window.partitionBy("partition", "_chunk")
        .orderBy("offset")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        chunked.join(bases, ["partition", "_chunk"])
        .withColumn(
            name, F.col("_base") + F.coalesce(F.sum("_counted").over(inside), F.lit(0))
        )
        .drop("_chunk", "_counted", "_base")
    )
