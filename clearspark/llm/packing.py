"""Packing of token sequences by Karmarkar-Karp multiway differencing.

A document's ids are cut into full windows and a rest in parts of at most `grain` ids.
Full windows are sequences of their own. The other pieces are dealt into groups of about
`group` pieces, and each group is partitioned into as few windows as its ids need: partial
partitions with the largest imbalances are merged, the fullest windows of one with the
emptiest of the other. When a window comes out beyond the capacity, their number rises by
one. Groups bound the memory of a task whatever the data; a group of g windows pads less
than a window or two in g.

Only the places of pieces are shuffled, never their ids.
"""

import heapq
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearspark.llm.pretokens import encoder
from clearspark.session import landed


def differenced(sizes: list[int], windows: int) -> list[list[int]]:
    """Indexes of `sizes` in so many sets of near-equal sums.

    A partial partition lists its non-empty windows (sum, members), fullest first.
    """
    heap = [(-s, i, [(s, (i,))]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        both = len(a) + len(b) - windows
        if both <= 0:
            merged = a + b
        else:
            meet = len(a) - both
            merged = a[:meet] + b[: len(b) - both]
            for x, y in zip(a[meet:], reversed(b[len(b) - both :]), strict=True):
                merged.append((x[0] + y[0], (x[1], y[1])))
        merged.sort(key=lambda w: -w[0])
        gap = merged[0][0] - (merged[-1][0] if len(merged) == windows else 0)
        heapq.heappush(heap, (-gap, serial, merged))
        serial += 1
    return [_flat(members) for _, members in heap[0][2]] if heap else []


def _flat(members: tuple) -> list[int]:
    out, stack = [], [members]
    while stack:
        top = stack.pop()
        if isinstance(top, int):
            out.append(top)
        else:
            stack.extend(top)
    return sorted(out)


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """As few near-equal windows as differencing finds, none beyond the capacity."""
    count = max(1, -(-sum(sizes) // capacity)) if sizes else 0
    while count:
        found = differenced(sizes, count)
        if max(sum(sizes[i] for i in w) for w in found) <= capacity:
            return found
        count += 1
    return []


def cuts(n: int, capacity: int, grain: int) -> list[int]:
    """Lengths of the pieces of n ids."""
    rest = n % capacity
    parts = [grain] * (rest // grain) + ([rest % grain] if rest % grain else [])
    return [capacity] * (n // capacity) + parts


def pieces(
    docs: DataFrame, vocabulary: str, end_id: int, capacity: int, grain: int, key: str, text: str, with_ids: bool = False
) -> DataFrame:
    """Every document's ids, its end id last, cut into pieces; `serial` numbers the pieces."""

    def cut(batches):
        encode = encoder(vocabulary).encode
        serial = TaskContext.get().partitionId() << 40
        for batch in batches:
            keys = batch.column(0)
            rows, owner, ids_out = [], [], []
            for at, ids in enumerate(encode(batch.column(1).to_pylist())):
                words = np.append(ids, end_id).astype("<u4")
                start = 0
                for n in cuts(len(words), capacity, grain):
                    part = words[start : start + n].tobytes()
                    rows.append((start, n, zlib.crc32(part), len(words), serial))
                    owner.append(at)
                    if with_ids:
                        ids_out.append(part)
                    start += n
                    serial += 1
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 5
            extra = [pa.array(ids_out, pa.binary())] if with_ids else []
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(owner, pa.int64())), *columns, *extra], names=names)

    names = [key, "start", "length", "ids_crc32", "doc_tokens", "serial"] + ["ids"] * with_ids
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, " + ", ".join(f"{n} bigint" for n in names[1:6]) + ", ids binary" * with_ids
    return docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("_text")).mapInArrow(cut, schema)


def pack(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = 1,
    capacity: int = 2048,
    key: str = "doc_id",
    text: str = "text",
    grain: int = 512,
    group: int = 1024,
    with_ids: bool = False,
) -> DataFrame:
    """One row for each piece: its place in its document and in its sequence.

    (key, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]); ids are
    little-endian unsigned 32-bit words. Null and empty texts are one piece with the end id
    alone. Repeated rows are packed as often as they come; null keys are kept; other
    columns are not read; an empty table gives no rows.
    """
    cut = landed(pieces(docs, vocabulary, end_id, capacity, grain, key, text, with_ids), "pieces")
    full = F.col("length") == capacity
    loose = cut.filter(~full)
    groups = max(1, -(-loose.count() // group))
    spread = loose.select("serial", "length", F.pmod(F.xxhash64("serial"), F.lit(groups)).alias("_group"))

    def placed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "serial"], ascending=[False, True], ignore_index=True)
        sizes = rows["length"].tolist()
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for number, members in enumerate(windows_of(sizes, capacity)):
            at = 0
            for i in members:
                sequence[i], offset[i] = number, at
                at += sizes[i]
        first = int(rows["_group"].iloc[0]) << 32
        return pd.DataFrame({"serial": rows["serial"], "_sequence": (first + sequence) * 2, "_offset": offset})

    places = spread.groupBy("_group").applyInPandas(placed, "serial bigint, _sequence bigint, _offset bigint")
    shown = [key, "start", "length", "ids_crc32", "doc_tokens"]
    extra = ["ids"] * with_ids
    alone = cut.filter(full).select(
        *shown, (F.col("serial") * 2 + 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"), *extra
    )
    together = loose.join(places, "serial").select(
        *shown, F.col("_sequence").alias("sequence_id"), F.col("_offset").alias("offset"), *extra
    )
    return alone.unionByName(together)
