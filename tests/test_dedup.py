import random

import pytest
from pyspark.sql import functions as F

from clearspark.operators import dedup


def keyed(spark, keys, partition=0):
    rows = [(partition, i, k) for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, "partition int, offset bigint, trade_id string")


def replay(keys, capacity):
    """The bounded memory, one key at a time."""
    memory, out = [], []
    for key in keys:
        fresh = key not in memory
        if fresh:
            memory = [*memory, key][-capacity:]
        out.append(fresh)
    return out


def verdicts(rows, **options):
    found = dedup.bounded_memory_verdicts(rows, **options)
    return [r.admitted for r in found.orderBy("partition", "offset").collect()]


def test_keep_first_in_log_order(spark):
    rows = [(1, 0, "a"), (0, 5, "a"), (0, 9, "a"), (1, 1, "b")]
    df = spark.createDataFrame(rows, "partition int, offset bigint, trade_id string")
    kept = {tuple(r) for r in dedup.keep_first(df).collect()}
    assert kept == {(0, 5, "a"), (1, 1, "b")}


def test_keep_first_limits_a_hot_key_before_the_shuffle(spark):
    name = F.when(F.col("id") % 3 < 1, "hot").otherwise(F.col("id").cast("string"))
    df = spark.range(1000).select(
        F.lit(0).alias("partition"), F.col("id").alias("offset"), name.alias("trade_id")
    )
    plan = dedup.keep_first(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_memory_knows_repeats(spark):
    rows = keyed(spark, "aabc")
    assert verdicts(rows, capacity=3, shards=1) == [True, False, True, True]


def test_evicted_key_is_new_again(spark):
    assert verdicts(keyed(spark, "abca"), capacity=2, shards=1) == [True] * 4


def test_a_repeat_does_not_refresh_its_key(spark):
    # First in, first out: the repeat of a at 2 does not save a from eviction by c.
    assert verdicts(keyed(spark, "abaca"), capacity=2, shards=1) == [True, True, False, True, True]


def test_capacity_below_one_counts_as_one(spark):
    assert verdicts(keyed(spark, "aaba"), capacity=0, shards=1) == [True, False, True, True]


@pytest.mark.parametrize("capacity", [1, 3, 8])
def test_matches_replay_with_a_hot_key(spark, capacity):
    rng = random.Random(capacity)
    keys = [rng.choice(["hot", "hot", *"abcdefghij"]) for _ in range(500)]
    got = verdicts(keyed(spark, keys), capacity=capacity, shards=1, chunk_bits=5)
    assert got == replay(keys, capacity)
    assert got.count(True) > len(set(keys))


def test_chunks_whose_memory_never_washes_out(spark):
    # One key more than the memory holds, over and over, and a key that comes first only:
    # each chunk depends on where the one before has left off.
    keys = ["x"] + list("abcde") * 40 + list("ab") * 10 + list("abcdef") * 30
    for capacity in (4, 5):
        assert verdicts(keyed(spark, keys), capacity=capacity, shards=1, chunk_bits=5) == replay(keys, capacity)


def test_one_memory_over_partitions_and_missing_keys(spark):
    rng = random.Random(9)
    rows = [(p, o, rng.choice([None, "a", "b", "c", "d"])) for p in range(3) for o in sorted(rng.sample(range(400), 120))]
    df = spark.createDataFrame(rows, "partition int, offset bigint, trade_id string").repartition(3)
    assert verdicts(df, capacity=2, shards=1, chunk_bits=4) == replay([k for _, _, k in rows], 2)
    assert dedup.bounded_memory_verdicts(df.limit(0)).count() == 0


def test_shards_are_memories_of_their_own(spark):
    rng = random.Random(5)
    keys = [rng.choice("abcdefghijklmnop") for _ in range(400)]
    rows = keyed(spark, keys)
    shards = [r[0] for r in rows.orderBy("offset").select(dedup.memory_shard(F.col("trade_id"), 4)).collect()]
    expected = [None] * len(keys)
    for shard in range(4):
        places = [i for i, s in enumerate(shards) if s == shard]
        for place, fresh in zip(places, replay([keys[i] for i in places], 2)):
            expected[place] = fresh
    assert verdicts(rows, capacity=2, shards=4) == expected


def test_rows_without_a_key_are_no_repeats(spark):
    rows = spark.createDataFrame([(0, 0, "a"), (0, 1, None), (0, 2, None), (0, 3, "a")], "partition int, offset bigint, trade_id string")
    found = dedup.keep_first(rows).orderBy("offset").collect()
    assert [(r.offset, r.trade_id) for r in found] == [(0, "a"), (1, None), (2, None)]
