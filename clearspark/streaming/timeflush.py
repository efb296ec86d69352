"""Batches that close by time although no record follows (B1, B2).

Each log partition keeps its open batch in keyed state, with a processing-time timer at the
first trade's clock plus the wait. Spark runs a micro-batch for due timers without any
input, so a batch goes out on an idle log. A micro-batch's rows of one partition pass
through one task, sorted by Spark, which spills; Python has one Arrow batch of them at a
time and the rows of the batch left open, whatever the size of the micro-batch.
`streaming.publish` spreads a partition over many tasks, but needs a next record.
"""

import os
import sys
import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from clearspark.functions import codec
from clearspark.operators import batching
from clearspark.session import settings
from clearspark.streaming import publish, tables

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HELD = "offset long, clock_us long, is_trade boolean, value binary"
HEAD = "trades long, first_us long, clock_us long"
CLOSED = f"partition int, batch_key long, {HELD}"
_COLUMNS = ("offset", "clock_us", "is_trade", "value")
PIECE = 20_000  # rows that are emitted at once
# Spark refuses to sort a stream, as it can sort within a micro-batch only, which is all that is asked here.
_SORTED = {"spark.sql.streaming.unsupportedOperationCheck": "false"}


class OpenBatches(StatefulProcessor):
    """The open batch of each partition; the rows of closed ones are emitted in pieces, with the first offset of their batch."""

    def __init__(self, size: int, wait_us: int):
        self.size, self.wait_us = size, wait_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", HELD)
        self.head = handle.getValueState("head", HEAD)

    def _emitted(self, key, lowest, rows: pd.DataFrame) -> pd.DataFrame:
        frame = rows[list(_COLUMNS)].reset_index(drop=True)
        frame.insert(0, "batch_key", lowest)
        frame.insert(0, "partition", key[0])
        return frame

    def _keep(self, trades: int, first_us: int, clock_us: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.head.update((trades, first_us, clock_us))
        if trades:
            self.handle.registerTimer(-(-(first_us + self.wait_us) // 1000))

    def _ends(self, clocks: np.ndarray, is_trade: np.ndarray, trades: int, first_us: int) -> tuple[list[int], int, int]:
        """The rows before which batches end, and the trades and first clock of the one left open.

        `trades` and `first_us` are those of the batch open before the rows.
        """
        rows, opens = len(clocks), np.flatnonzero(is_trade)
        ends: list[int] = []
        if trades:
            by_size = int(opens[self.size - trades - 1]) + 1 if self.size - trades <= len(opens) else rows + 1
            late = int(np.searchsorted(clocks, first_us + self.wait_us, side="left"))
            end = min(by_size, late if late < rows else rows + 1)
            if end > rows:
                return ends, trades + len(opens), first_us
            ends.append(end)
        # For a batch opened at each trade: where it ends, and the trade that opens the next.
        full = np.arange(len(opens)) + (self.size - 1)
        by_size = np.full(len(opens), rows + 1)
        reached = full < len(opens)
        by_size[reached] = opens[full[reached]] + 1
        late = np.maximum(np.searchsorted(clocks, clocks[opens] + self.wait_us, side="left"), opens + 1)
        closing = np.minimum(by_size, np.where(late < rows, late, rows + 1))
        following, closing = np.searchsorted(opens, closing, side="left").tolist(), closing.tolist()
        at = int(np.searchsorted(opens, ends[-1], side="left")) if ends else 0
        while at < len(opens):
            if closing[at] > rows:
                return ends, len(opens) - at, int(clocks[opens[at]])
            ends.append(closing[at])
            at = following[at]
        return ends, 0, first_us

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        trades, first_us, clock_us = self.head.get() if self.head.exists() else (0, 0, -(1 << 62))
        # Rows of the batch left open: those read here, and whether there may be some in the state.
        left, stored, last = [], True, None
        for part in rows:
            if not len(part):
                continue
            frame = part[list(_COLUMNS)].sort_values("offset", kind="stable", ignore_index=True)
            offsets = frame["offset"].to_numpy(np.int64)
            if last is not None and offsets[0] < last:
                raise ValueError(f"offset {offsets[0]} of partition {key[0]} comes after {last}")
            last = offsets[-1]
            # A clock that steps back is held.
            clocks = np.maximum(np.maximum.accumulate(frame["clock_us"].to_numpy(np.int64)), clock_us)
            frame["clock_us"] = clocks
            clock_us = int(clocks[-1])
            ends, trades, first_us = self._ends(clocks, frame["is_trade"].to_numpy(bool), trades, first_us)
            if ends:
                starts = [0, *ends[:-1]]
                lowest = offsets[np.minimum(starts, len(offsets) - 1)]
                opened = left
                if stored and self.held.exists():
                    opened = [pd.DataFrame([tuple(r) for r in self.held.get()], columns=_COLUMNS), *left]
                    opened = [rows_of for rows_of in opened if len(rows_of)]
                lowest[0] = min([*(int(rows_of["offset"].min()) for rows_of in opened), *offsets[: min(ends[0], 1)]])
                for rows_of in opened:
                    yield self._emitted(key, lowest[0], rows_of)
                keys = np.repeat(lowest, np.diff([0, *ends]))
                # Many batches go out in one piece, and none of them at once with all others.
                for low in range(0, ends[-1], PIECE):
                    high = min(low + PIECE, ends[-1])
                    yield self._emitted(key, keys[low:high], frame.iloc[low:high])
                if stored:
                    self.held.clear()
                    stored = False
                left, frame = [], frame.iloc[ends[-1] :]
            if len(frame):
                # Without the rows that went out, of which a slice would be a view.
                left.append(frame.copy())
        for frame in left:
            self.held.appendList([(int(o), int(c), bool(t), v) for o, c, t, v in frame.itertuples(index=False)])
        self._keep(trades, first_us, clock_us)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        trades, first_us, clock_us = self.head.get() if self.head.exists() else (0, 0, 0)
        due = first_us + self.wait_us <= timerValues.getCurrentProcessingTimeInMs() * 1000
        if trades and due:
            held = pd.DataFrame([tuple(r) for r in self.held.get()], columns=_COLUMNS)
            yield self._emitted(key, held["offset"].min(), held)
            self.held.clear()
            self._keep(0, 0, clock_us)

    def close(self) -> None:
        pass


def closed_rows(log: DataFrame, flush: batching.Flush) -> DataFrame:
    """Rows of batches as they close, by size, by a later record's clock or by the wall clock.

    `log` is a stream of normalized trades. Undecodable rows widen a batch and open none.
    The state store has to be RocksDB, and the query is started inside `_SORTED`.
    """
    rows = codec.with_trade(log).select(
        "partition",
        "offset",
        F.unix_micros("timestamp").alias("clock_us"),
        F.col("trade").isNotNull().alias("is_trade"),
        "value",
    )
    # Dealt out as the state is, so that no exchange comes after the sort.
    in_order = rows.repartition("partition").sortWithinPartitions("partition", F.col("offset").asc_nulls_last())
    return in_order.groupBy("partition").transformWithStateInPandas(
        statefulProcessor=OpenBatches(flush.size, flush.wait), outputStructType=CLOSED, outputMode="Append", timeMode="ProcessingTime"
    )


def start(
    log: DataFrame,
    folder: str,
    checkpoint: str,
    flush: batching.Flush,
    created_at_ms: Column | None = None,
    interval: str = "1 second",
) -> StreamingQuery:
    """A running query that writes each batch once, in the tables that `publish.published` reads.

    A replayed micro-batch has the clock of its first run, so the same timers are due.
    """

    def handle(micro: DataFrame, step: int) -> None:
        tables.claim(micro.sparkSession, folder)
        # Rows come from one task for each log partition; they are dealt out before they are parsed.
        dealt = micro.repartition("partition", "batch_key")
        labelled = codec.with_trade(dealt).select("partition", "batch_key", "offset", "trade")
        built = batching.build(labelled, flush, created_at_ms).persist()
        try:
            # Micro-batches that only look for due timers write nothing.
            if not built.isEmpty():
                tables.write_step(built, os.path.join(folder, publish.BATCHES), step)
        finally:
            built.unpersist()

    with settings(log.sparkSession, _SORTED):
        return (
            closed_rows(log, flush)
            .writeStream.foreachBatch(handle)
            .option("checkpointLocation", checkpoint)
            .trigger(processingTime=interval)
            .start()
        )


def wait_until(query: StreamingQuery, done: Callable[[], bool], seconds: float, step: float = 0.5) -> bool:
    """Waits for something that a running query brings about; raises what the query raised."""
    for _ in range(int(seconds / step)):
        if done():
            return True
        if query.awaitTermination(step):
            return done()
    return done()


def stop(query: StreamingQuery, seconds: float = 3) -> None:
    """Stops a query between two micro-batches rather than inside one, where it can."""
    for _ in range(int(seconds / 0.02)):
        if not query.isActive or not query.status["isTriggerActive"]:
            break
        time.sleep(0.02)
    query.stop()
