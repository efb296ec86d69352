"""Token counts with a whole-token shortcut.

Offline, every string of the vocabulary is encoded alone by the tokenizers library; those
that give one token are proved whole, and their hashes are sent to the tasks (at most one
for each entry of the vocabulary). Counting matches a text's pre-tokens against them; what
matches counts as one, and only the rest is merged, once for each distinct pre-token that
a worker's bounded cache does not hold.
"""

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearspark.llm.pretokens import Counter, proved_whole


@functools.cache
def _counter(path: str, whole: bytes) -> Counter:
    return Counter(path, np.frombuffer(whole, np.uint64))


def count_tokens(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", limit: int = 2048
) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row's whole text.

    Null and empty texts have no bytes and no tokens. Rows are kept as they are, repeated
    and null keys included; other columns are not read. No shuffle.
    """
    whole = proved_whole(vocabulary).tobytes()

    def counted(batches):
        counter = _counter(vocabulary, whole)
        for batch in batches:
            n = counter.count(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n)], names=names)

    names = [key, "n_bytes", "n_tokens"]
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(key, content.alias("_text"), F.octet_length(content).cast("bigint").alias("_size"))
    kind = docs.schema[key].dataType.simpleString()
    found = rows.mapInArrow(counted, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
