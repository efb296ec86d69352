"""Periodic runs of words in texts, and texts without their repetitions.

A word in a run of period q stands in it a second time, q words off. So words that a
stretch holds once cut it in two, again and again; what remains of a text are the stretches
that can hold a run. This only saves work: suffix trees find all runs of each stretch.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from clearspark.llm.bytewords import raw
from clearspark.llm.names import free
from clearspark.llm.pretokens import hashed, mixed, slices
from clearspark.llm.suffix_runs import runs
from clearspark.llm.wordspans import byte_set, word_spans

_SOLID = ~byte_set(b"\x20\x09\x0a\x0b\x0c\x0d")
#: Bytes handled as one array.
SLICE = 1 << 21
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def stretches(words: np.ndarray, texts: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(first, past last) of the stretches that hold each of their words twice, of `least` words at least.

    `words` are hashes, `texts` tells which text each stands in. Every run of so many words
    lies within one stretch, and no word beside a stretch extends it.
    """
    at, own = np.arange(len(words)), texts
    while len(at):
        keys = mixed(words[at] + mixed(own.astype(np.uint64)))
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:]] = same
        twice[order[:-1]] |= same
        whole = twice.all()
        at, own = at[twice], own[twice]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (own[1:] != own[:-1])
        own = np.cumsum(new) - 1
        long = np.bincount(own) >= least if len(own) else np.zeros(0, bool)
        if whole and long.all():
            break
        at, own = at[long[own]], own[long[own]]
    if not len(at):
        return []
    first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    sizes = np.diff(np.append(first, len(at)))
    return list(zip(at[first].tolist(), (at[first] + sizes).tolist(), strict=True))


def _numbered(words: list[bytes]) -> list[int]:
    seen: dict[bytes, int] = {}
    return [seen.setdefault(w, len(seen) + 1) for w in words]


def find(docs: DataFrame, keep: list[str], text: str = "text", least: int = 12) -> DataFrame:
    """The columns `keep` with `runs` and `collapsed` (names with underscores added where kept columns have them).

    `runs` are (start, length, period) of every stretch of consecutive words with smallest
    period q and at least max(least, 2q) words that no neighbouring word extends, by start,
    then period; words are told apart byte by byte. `collapsed` are the words, joined by one
    space, that no run holds after its first period. Null, empty and white texts have no
    runs and collapse to empty text. Rows stay as they are, repeated ones too.
    """
    kept = len(keep)
    names = free(keep, "runs", "collapsed")
    (content,) = free(keep, "_text")

    def found(batches):
        for batch in batches:
            texts = batch.column(kept)
            data, offsets = raw(texts)
            for a, b in slices(np.diff(offsets).tolist(), SLICE):
                part = data[offsets[a] : offsets[b]]
                edges = offsets[a : b + 1] - offsets[a]
                lists, plain = _of_slice(part, edges, least)
                columns = [c.slice(a, b - a) for c in batch.columns[:kept]]
                columns += [pa.array(lists, pa.list_(RUN)), pa.array(plain, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *names])

    schema = docs.select(*keep).schema
    schema = schema.add(names[0], ArrayType(StructType().add("start", "long").add("length", "long").add("period", "long"))).add(names[1], "string")
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias(content))
    return rows.mapInArrow(found, schema)


def _of_slice(data: np.ndarray, edges: np.ndarray, least: int) -> tuple[list[list[dict]], list[bytes]]:
    """The runs and the collapsed bytes of each text of a slice."""
    starts, ends = word_spans(_SOLID[data], edges)
    firsts = np.searchsorted(starts, edges)
    texts = np.repeat(np.arange(len(edges) - 1), np.diff(firsts))
    whole = data.tobytes()
    lists: list[list[tuple[int, int, int]]] = [[] for _ in range(len(edges) - 1)]
    for a, b in stretches(hashed(data, starts, ends), texts, least):
        words = [whole[x:y] for x, y in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)]
        before = a - int(firsts[texts[a]])
        lists[texts[a]] += [(before + start, length, period) for start, length, period in runs(_numbered(words), least)]
    plain = []
    for i, own in enumerate(lists):
        words = whole[edges[i] : edges[i + 1]].split()
        if own:
            cover = np.zeros(len(words) + 1, np.int64)
            for start, length, period in own:
                cover[start + period] += 1
                cover[start + length] -= 1
            stays = np.cumsum(cover[:-1]) == 0
            words = [words[k] for k in np.flatnonzero(stays).tolist()]
        plain.append(b" ".join(words))
    shaped = [[{"start": s, "length": n, "period": q} for s, n, q in sorted(own, key=lambda r: (r[0], r[2]))] for own in lists]
    return shaped, plain
