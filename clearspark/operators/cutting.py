"""Where size-or-time batches start, found in parallel (B1).

A batch opens at a trade and ends before the first trade that is `max_size` trades
or `max_wait` later, so where one starts depends on all before it. A stretch of
the log needs only one thing from what lies before: the batch still open at its
edge. For a stretch we therefore tabulate, for each trade that could be the first
to open a batch in it, which batch is open at its far edge. Tables of neighbours
combine into the table of both, so chunks are tabulated in parallel, combined in
groups, and walked in parallel once the batch open at each chunk's edge is known.

A table has an entry per trade that can follow an open batch, at most the size of
one batch, whatever the size of the stretch.
"""

from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from clearspark.operators import shipping

shipping.send_by_value(__name__)

NONE = -1  # no batch
INHERIT = -2  # the batch that was open at the near edge

TABLE_SCHEMA = (
    "partition int, _group bigint, _chunk bigint, n bigint, clocks array<bigint>, "
    "counts array<bigint>, firsts array<bigint>, starts array<bigint>, preds array<bigint>"
)
OPEN_SCHEMA = (
    "partition int, _chunk bigint, open_count bigint, open_first bigint, "
    "open_start bigint, open_pred bigint"
)
MARK_SCHEMA = (
    "partition int, _chunk bigint, offset bigint, batch_start bigint, batch_pred bigint, "
    "batch_first bigint, batch_base bigint, prior_clock bigint"
)


class Limits(NamedTuple):
    max_size: int
    max_wait: int  # microseconds


class Open(NamedTuple):
    """A batch open at an edge: its trades so far, first clock, first offset and predecessor."""

    count: int
    first: int
    start: int
    pred: int


NOTHING_OPEN = Open(0, 0, NONE, NONE)


class Table(NamedTuple):
    n: int
    clocks: np.ndarray
    counts: np.ndarray
    firsts: np.ndarray
    starts: np.ndarray
    preds: np.ndarray

    def left_open(self, at: int, before: Open) -> Open:
        """The batch open at the far edge when the first new batch opens at trade `at`."""
        pred = int(self.preds[at])
        return Open(
            int(self.counts[at]),
            int(self.firsts[at]),
            int(self.starts[at]),
            before.start if pred == INHERIT else pred,
        )


def next_starts(clocks: np.ndarray, limits: Limits) -> np.ndarray:
    """For a batch opened at each trade, the trade that opens the next one (n or more: outside)."""
    here = np.arange(len(clocks))
    by_time = np.searchsorted(clocks, clocks + limits.max_wait, side="left")
    # Without a positive wait a batch still holds the trade that opened it.
    return np.maximum(np.minimum(here + limits.max_size, by_time), here + 1)


def _head_length(clocks: np.ndarray, limits: Limits) -> int:
    """Trades that may be the first to open a batch here, given any batch open at the edge."""
    if not len(clocks):
        return 0
    latest = int(np.searchsorted(clocks, clocks[0] + max(limits.max_wait, 0), side="left"))
    return min(len(clocks), limits.max_size, latest + 1)


def _repeat_until_fixed(step: np.ndarray) -> np.ndarray:
    while True:
        twice = step[step]
        if np.array_equal(twice, step):
            return step
        step = twice


def tabulate(offsets: np.ndarray, clocks: np.ndarray, limits: Limits) -> Table:
    n = len(clocks)
    head = _head_length(clocks, limits)
    here = np.arange(n)
    following = next_starts(clocks, limits)
    step = np.where(following < n, following, here)
    last = _repeat_until_fixed(step)[:head]
    before_last = _repeat_until_fixed(np.where(step[step] == step, here, step))[:head]
    return Table(
        n,
        clocks[:head],
        n - last,
        clocks[last],
        offsets[last],
        np.where(before_last == last, INHERIT, offsets[before_last]),
    )


def first_new_start(before: Open, clocks: np.ndarray, limits: Limits) -> int:
    """Index of the first trade of a stretch that is not in the batch open at its edge."""
    if before.count == 0:
        return 0
    by_time = int(np.searchsorted(clocks, before.first + limits.max_wait, side="left"))
    return min(limits.max_size - before.count, by_time)


def advance(before: Open, table: Table, limits: Limits) -> Open:
    at = first_new_start(before, table.clocks, limits)
    if at >= table.n:
        return before._replace(count=before.count + table.n)
    return table.left_open(at, before)


def _advance_all(states: np.ndarray, table: Table, limits: Limits) -> np.ndarray:
    """`advance` for many open batches at once; `states` has a row per field of Open."""
    counts, firsts, starts, preds = states
    by_time = np.searchsorted(table.clocks, firsts + limits.max_wait, side="left")
    at = np.minimum(limits.max_size - counts, by_time)
    inside = at < table.n
    at = at[inside]
    after = np.array([counts + table.n, firsts, starts, preds])
    pred = table.preds[at]
    after[:, inside] = (
        table.counts[at],
        table.firsts[at],
        table.starts[at],
        np.where(pred == INHERIT, starts[inside], pred),
    )
    return after


def combine(tables: list[Table], limits: Limits) -> Table:
    """The table of consecutive stretches taken as one."""
    heads = np.empty(0, dtype=np.int64)
    states = np.empty((4, 0), dtype=np.int64)
    seen, horizon, complete = 0, None, False
    for table in tables:
        if not table.n:
            continue
        states = _advance_all(states, table, limits)
        if not complete:
            if horizon is None:
                horizon = table.clocks[0] + max(limits.max_wait, 0)
            # Up to the first trade no open batch can reach, by time or by size. A table
            # lists all of its own such trades, and ours are among them.
            reach = int(np.searchsorted(table.clocks, horizon, side="left")) + 1
            taken = min(reach, limits.max_size - seen, len(table.clocks))
            heads = np.concatenate((heads, table.clocks[:taken]))
            fresh = (table.counts, table.firsts, table.starts, table.preds)
            states = np.hstack((states, np.array([f[:taken] for f in fresh])))
            complete = taken == reach or seen + table.n >= limits.max_size
        seen += table.n
    return Table(seen, heads, *states)


def _arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and clocks of the trades of a chunk, in offset order.

    The clock is the latest arrival up to a record, be that a trade or not, and never
    before the one the chunk begins with; a record without arrival leaves it standing.
    """
    offsets = table.column("offset").to_numpy()
    order = np.argsort(offsets)
    prior = table.column("prior_clock")[0].as_py()
    arrivals = pc.fill_null(table.column("arrival"), prior).to_numpy()[order]
    clocks = np.maximum.accumulate(np.maximum(arrivals, prior))
    trades = pc.fill_null(table.column("is_trade"), False).to_numpy()[order]
    return offsets[order][trades], clocks[trades]


def _table_rows(keys: Iterable[tuple[int, int, int]], tables: Iterable[Table]) -> pa.Table:
    rows = [
        (*key, t.n, t.clocks, t.counts, t.firsts, t.starts, t.preds)
        for key, t in zip(keys, tables)
    ]
    names = [part.split()[0] for part in TABLE_SCHEMA.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * 5
    return pa.table(
        {
            name: pa.array([row[i] for row in rows], kind)
            for i, (name, kind) in enumerate(zip(names, kinds))
        }
    )


def _read_tables(table: pa.Table) -> list[tuple[int, Table]]:
    """(chunk, table) pairs in chunk order."""
    table = table.sort_by("_chunk")
    lists = []
    for name in ("clocks", "counts", "firsts", "starts", "preds"):
        column = table.column(name).combine_chunks()
        flat = column.flatten().to_numpy(zero_copy_only=False)
        lists.append(np.split(flat, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))[:-1]))
    return [
        (chunk, Table(n, *arrays))
        for chunk, n, *arrays in zip(
            table.column("_chunk").to_pylist(), table.column("n").to_pylist(), *lists
        )
    ]


def _open_rows(partition: int, chunks: list[int], states: list[Open]) -> pa.Table:
    names = ("open_count", "open_first", "open_start", "open_pred")
    columns = {
        "partition": pa.array([partition] * len(chunks), pa.int32()),
        "_chunk": pa.array(chunks, pa.int64()),
    }
    for i, name in enumerate(names):
        columns[name] = pa.array([state[i] for state in states], pa.int64())
    return pa.table(columns)


def chunk_tabulator(limits: Limits, group_bits: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        partition, chunk = key[0].as_py(), key[1].as_py()
        table = tabulate(*_arrays(rows), limits)
        return _table_rows([(partition, chunk >> group_bits, chunk)], [table])

    return run


def group_combiner(limits: Limits):
    """Tables of one group of chunks to the table of the group; `_chunk` becomes the group."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        partition, group = key[0].as_py(), key[1].as_py()
        merged = combine([t for _, t in _read_tables(rows)], limits)
        return _table_rows([(partition, group, group)], [merged])

    return run


def _run_through(before: Open, tables: list[Table], limits: Limits) -> list[Open]:
    states = []
    for table in tables:
        states.append(before)
        before = advance(before, table, limits)
    return states


def partition_scanner(limits: Limits):
    """The batch open at the near edge of every group of a partition."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        chunks, tables = zip(*_read_tables(rows))
        return _open_rows(
            key[0].as_py(), list(chunks), _run_through(NOTHING_OPEN, list(tables), limits)
        )

    return run


def _only_state(rows: pa.Table) -> Open:
    return Open(
        *(
            rows.column(name)[0].as_py()
            for name in ("open_count", "open_first", "open_start", "open_pred")
        )
    )


def group_scanner(limits: Limits):
    """The batch open at the near edge of every chunk, from the one at its group's edge."""

    def run(key: tuple, rows: pa.Table, edge: pa.Table) -> pa.Table:
        chunks, tables = zip(*_read_tables(rows))
        return _open_rows(
            key[0].as_py(), list(chunks), _run_through(_only_state(edge), list(tables), limits)
        )

    return run


def chunk_walker(limits: Limits):
    """One mark per batch touching the chunk; the first mark stands for the chunk's near edge."""

    def run(key: tuple, rows: pa.Table, edge: pa.Table) -> pa.Table:
        offsets, clocks = _arrays(rows)
        before = _only_state(edge)
        starts, at = [], first_new_start(before, clocks, limits)
        following = next_starts(clocks, limits).tolist()
        while at < len(clocks):
            starts.append(at)
            at = following[at]
        index = np.array(starts, dtype=np.int64)
        opened = np.concatenate(([before.start], offsets[index]))
        marks = {
            "offset": np.concatenate(([NONE], offsets[index])),
            "batch_start": opened,
            "batch_pred": np.concatenate(([before.pred], opened[:-1])),
            "batch_first": np.concatenate(([before.first], clocks[index])),
            "batch_base": np.concatenate(([-before.count], index)),
            "prior_clock": np.full(len(opened), rows.column("prior_clock")[0].as_py()),
        }
        size = len(opened)
        columns = {
            "partition": pa.array([key[0].as_py()] * size, pa.int32()),
            "_chunk": pa.array([key[1].as_py()] * size, pa.int64()),
        }
        columns.update({name: pa.array(v, pa.int64()) for name, v in marks.items()})
        return pa.table(columns)

    return run
