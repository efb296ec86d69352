"""The n-gram Jaccard join and nearest neighbours against brute force."""

import random

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clearspark.llm import kmeans_tree, ngram_join
from clearspark.llm.components import components
from clearspark.llm.prefix_tree import Threshold, forest
from tests.llm.cases import empty_table, odd_rows, odd_table, prose, shingles


def parts(n, links):
    own = list(range(n))
    for a, b in links:
        own = [own[b] if x == own[a] else x for x in own]
    return own


def same_parts(a, b):
    return len(set(zip(a, b, strict=True))) == len(set(a)) == len(set(b))


def alike(a, b, percent):
    return bool(a | b) and 100 * len(a & b) >= percent * len(a | b)


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_trie_connects_what_brute_force_connects(percent):
    rng, limit = random.Random(percent), Threshold(percent)
    for _ in range(150):
        base = [rng.sample(range(60), rng.randint(1, 25)) for _ in range(3)]
        sets = []
        for _ in range(rng.randint(2, 14)):
            own = set(rng.choice(base))
            for _ in range(rng.randint(0, 3)):
                own.add(rng.randint(0, 70))
            sets.append(own)
        arrays = [np.array(sorted(s), np.uint64) for s in sets]
        links = [(i, j) for i in range(len(sets)) for j in range(i) if alike(sets[i], sets[j], percent)]
        assert same_parts(parts(len(sets), forest(arrays, limit)), parts(len(sets), links))
        k = rng.randint(1, len(sets) - 1)
        across = [(i, j) for i, j in links if (i >= k) != (j >= k)]
        assert same_parts(parts(len(sets), forest(arrays[:k], limit, arrays[k:])), parts(len(sets), across))


def test_prefixes_of_alike_sets_share_enough():
    rng, limit = random.Random(4), Threshold(85)
    for _ in range(3000):
        n = rng.randint(1, 120)
        a = set(range(n))
        b = (a - set(rng.sample(sorted(a), rng.randint(0, n // 8)))) | {1000 + i for i in range(rng.randint(0, n // 8))}
        order = {x: rng.random() for x in a | b}
        if b and alike(a, b, 85):
            first = [set(sorted(s, key=order.get)[: limit.prefix(len(s))]) for s in (a, b)]
            assert len(first[0] & first[1]) >= min(limit.common(len(a)), limit.common(len(b)))


def family(seed, size, copies, changes):
    rng, base = random.Random(seed), prose(seed, size, 5000).split()
    for _ in range(copies):
        own = list(base)
        for _ in range(changes):
            own[rng.randrange(size)] = f"new{rng.randrange(10**6)}"
        yield " ".join(own)


def test_groups_of_near_copies(spark):
    texts = [*family(1, 150, 40, 1), *family(2, 60, 25, 2), *family(3, 300, 10, 6), *(prose(s, 80, 300) for s in range(60))]
    texts += [t + " " + prose(9, 70) for t in texts[-20:]] + texts[:5]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [shingles(t, 4) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if alike(sets[i], sets[j], 85)]
    expected = parts(len(texts), links)
    for block in (256, 4):
        found = sorted(ngram_join.near_duplicates(docs, width=4, percent=85, block=block).collect())
        assert [r.n_shingles for r in found] == [len(s) for s in sets]
        smallest = [min(i for i, p in enumerate(expected) if p == own) for own in expected]
        assert [r.component_id for r in found] == smallest


def test_join_of_odd_rows(spark):
    found = ngram_join.near_duplicates(odd_table(spark)).collect()
    assert len(found) == len(odd_rows())
    rows = [(r[0], shingles(r[1], 5)) for r in odd_rows()]
    for r in found:
        own = [s for k, s in rows if k == r.doc_id and len(s) == r.n_shingles]
        if r.n_shingles == 0:
            assert r.component_id == r.doc_id
        elif r.doc_id is None:
            assert r.component_id == 3
        else:
            assert r.component_id == min(k for k, s in rows if k is not None and any(alike(s, o, 80) for o in own))
    assert ngram_join.near_duplicates(empty_table(spark)).count() == 0


def test_spark_hash_is_repeated_in_tasks(spark):
    values = [0, 1, -1, 2**62, -(2**63), 123456789]
    found = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v long").select(F.xxhash64("v")).collect()]
    assert ngram_join._spark_hash(np.array(values)).view(np.int64).tolist() == found


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 103), (103, 101), (7, 7)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert {found[i] for i in range(61)} == {0} and {found[i] for i in (100, 101, 103)} == {100}


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string, v long")


def test_neighbours_reach_the_recall(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 16))
    own = (centres[rng.integers(0, 40, 3000)] + 0.4 * rng.normal(size=(3000, 16))).astype(np.float32)
    own[1000:1400] = own[1000]
    table = vectors(spark, [(i, v.tolist(), "x", 1) for i, v in enumerate(own)])
    found = kmeans_tree.nearest(table, F.col("vec_id") % 20 == 0, leaf=64, groups=7, crowd=16).collect()
    exact, hits = own.astype(float), 0
    for q in range(0, 3000, 20):
        scores = (exact * exact[q]).sum(1)
        scores[q] = -np.inf
        best = np.lexsort((np.arange(3000), -scores))[:20]
        mine = sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert all(abs(r.score - scores[r.vec_id]) < 1e-9 for r in mine)
        assert all((-a.score, a.vec_id) < (-b.score, b.vec_id) for a, b in zip(mine, mine[1:], strict=False))
        hits += len({r.vec_id for r in mine} & set(best.tolist()))
    assert hits / (150 * 20) > 0.9


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (20, None), (8, [0.5, 0.5])]
    found = kmeans_tree.nearest(vectors(spark, [(*r, "x", 1) for r in rows]), F.col("vec_id") % 20 == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"])] == [(0, 1, 1, 0.5), (0, 2, 8, 0.5)]
    assert kmeans_tree.nearest(vectors(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_queries_that_stand_twice(spark):
    rng = np.random.default_rng(5)
    own = rng.normal(size=(60, 4)).astype(np.float32).astype(float).tolist()
    rows = [(i, v, "x", 1) for i, v in enumerate(own)]
    rows += [rows[0], rows[0], (20, own[7], "x", 1), rows[1]]
    found = kmeans_tree.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=5).collect()
    expected = []
    for q, v in {(0, tuple(own[0])), (20, tuple(own[20])), (20, tuple(own[7])), (40, tuple(own[40]))}:
        scores = sorted((-float((np.array(x) * np.array(v)).sum()), i) for i, x, _, _ in rows if i != q)
        expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:5], 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in found) == sorted((*e[:3], round(e[3], 9)) for e in expected)


def test_groups_have_about_equal_shares():
    rng = np.random.default_rng(6)
    sizes = {i: int(n) for i, n in enumerate(rng.zipf(1.5, 200).clip(0, 5000))}
    sizes[50] = sum(sizes.values()) // 2
    first, parts = kmeans_tree.deal(sizes, 16)
    load = Counter()
    for leaf, n in sizes.items():
        for g in range(first[leaf], first[leaf] + parts[leaf]):
            load[g] += n / parts[leaf]
    assert max(load.values()) <= sum(sizes.values()) / 16 + 1 and max(load) < 3 * 16
