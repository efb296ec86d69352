"""Streaming settlement with a durable ledger."""

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearspark.operators import settle
from clearspark.session import keeping
from clearspark.streaming import tables

LEDGER, DEAD_LETTERS, PENDING = "ledger", "dead_letters", "pending"

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("tx_hash", T.StringType()),
        T.StructField("attempts", T.LongType()),
        T.StructField("trade_count", T.LongType()),
        T.StructField("total_notional", T.StringType()),
        T.StructField("log_partition", T.IntegerType()),
        T.StructField("span", T.LongType()),
    ]
)

# The ledger is cut by the log partition and the first offset of a batch, 2^20 offsets per
# folder. Ids that name no position are dealt over OTHER_SPANS folders by their hash.
SPAN_BITS = 20
OTHER_PARTITION, OTHER_SPANS = -1, 256
CELL = ("log_partition", "span")
# Up to so many touched cells are named to the reader one by one; with more, the whole
# ledger is read, which finds the same rows.
NAMED_CELLS = 1024


def with_cell(rows: DataFrame) -> DataFrame:
    """Adds the ledger cell of `batch_id`; a null id is in the cell of the empty one."""
    place = r"^batch-p([0-9]+)_([0-9]+)_"
    batch_id = F.coalesce("batch_id", F.lit(""))
    partition = F.regexp_extract(batch_id, place, 1).try_cast("int")
    low = F.regexp_extract(batch_id, place, 2).try_cast("bigint")
    placed = partition.isNotNull() & low.isNotNull()
    other = F.pmod(F.xxhash64(batch_id), F.lit(OTHER_SPANS))
    return rows.withColumns(
        {
            "log_partition": F.when(placed, partition).otherwise(F.lit(OTHER_PARTITION)),
            "span": F.when(placed, F.shiftright(low, SPAN_BITS)).otherwise(other),
        }
    )


def _wide(ledger: str) -> str:
    """The part of a ledger that holds micro-batches of more than NAMED_CELLS cells."""
    return f"{ledger}_wide"


def _cells(rows: DataFrame) -> list:
    """The cells of some rows, no more than one over NAMED_CELLS of them."""
    return with_cell(rows).select(*CELL).distinct().limit(NAMED_CELLS + 1).collect()


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The whole ledger, with the micro-batch that settled each batch."""
    narrow, wide = (tables.read_table(spark, path, LEDGER_SCHEMA) for path in (ledger, _wide(ledger)))
    return narrow.unionByName(wide)


def known_in_cells(spark: SparkSession, ledger: str, settled: DataFrame) -> DataFrame:
    """The ledger's rows in the cells of `settled`; folders of other cells are not listed.

    Only the cells go to the driver, and no more than NAMED_CELLS of them. In the files of wide
    micro-batches the cells stand in order, so their statistics tell which to read.
    """
    cells = _cells(settled)
    if len(cells) > NAMED_CELLS:
        return read_ledger(spark, ledger)
    named = [tuple(zip(CELL, cell)) for cell in cells]
    wide = tables.read_table(spark, _wide(ledger), LEDGER_SCHEMA)
    for name in CELL:
        wide = wide.filter(F.col(name).isin(sorted({cell[name] for cell in cells})))
    return tables.read_cells(spark, ledger, LEDGER_SCHEMA, named).unionByName(wide)


def write_ledger(fresh: DataFrame, ledger: str, step: int) -> None:
    """Appends one micro-batch to the cells it touches; the same again when replayed.

    Rows go out by range, so a task writes to neighbouring cells only and a cell that
    gets most rows is written by several tasks. A micro-batch of more than NAMED_CELLS cells
    is one folder with its cells in order, as a folder for each would be as many files as rows.
    """
    rows = with_cell(fresh).repartitionByRange(*CELL, "batch_id")
    if len(_cells(fresh)) > NAMED_CELLS:
        tables.write_step(rows.sortWithinPartitions(*CELL), _wide(ledger), step)
    else:
        tables.write_cells(rows, ledger, step, CELL)


def settler(
    folder: str,
    attempts: DataFrame | Callable[[], DataFrame],
    max_attempts: int,
    failed_at_ms: Column | None = None,
    strict_notional: bool = False,
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` handler for a log of batches.

    Batches whose tries are not used up wait for the next micro-batch. `attempts` as a
    function is called for each micro-batch, so that tries written meanwhile are seen; a
    table is what it was when the handler was made.
    """
    ledger_folder = os.path.join(folder, LEDGER)

    def handle(micro: DataFrame, step: int) -> None:
        spark = micro.sparkSession
        columns = ["topic", "partition", "offset", "value"]
        rows = micro.select(*columns)
        tables.claim(spark, folder)
        waiting = tables.handed_over(spark, os.path.join(folder, PENDING), step)
        if waiting is not None:
            rows = rows.unionByName(waiting.select(*columns))
        with keeping(spark) as keep:
            # Read for the ids that ask for tries and for the outcomes, and parsed once.
            judged = keep(settle.judge_batches(rows, strict_notional))
            tries = attempts() if callable(attempts) else attempts
            tries = tries.join(judged.select("batch_id").distinct(), "batch_id", "left_semi")
            results = settle.submission_results(tries, max_attempts)
            decided = keep(settle.decide(judged, results, max_attempts))
            settled = decided.filter(F.col("outcome") == settle.SETTLED)
            known = known_in_cells(spark, ledger_folder, settled)
            fresh = keep(settle.settle_once(decided, tables.before_step(known, step)))
            write_ledger(fresh, ledger_folder, step)
            letters = settle.dead_letters(decided, failed_at_ms)
            tables.write_step(letters, os.path.join(folder, DEAD_LETTERS), step)
            waiting_now = decided.filter(F.col("outcome") == "pending").select(*columns)
            tables.write_step(waiting_now, os.path.join(folder, PENDING), step)

    return handle
