"""Approximate nearest neighbours by inner product in a hierarchical k-means tree.

The tree is fitted on a bounded sample and every vector goes down to a leaf. A query walks
best-bin-first: a priority queue holds the bins seen so far, ordered by the largest inner
product their ball allows, and the best one is opened next. How many leaves a query visits
is calibrated: for some queries the true neighbours are found by brute force over all rows,
and the visits are widened until the target share of them lies in the visited leaves.

Leaves are dealt into groups of about equal size, a large leaf into several, and a group's
queries into crowds of bounded size; so neither a common vector nor a common query direction
makes a large task. A task goes through its leaves one after another and holds of each query only
the best so far, so what leaves it grows with the queries and not with the leaves visited.
"""

import heapq
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearspark.session import landed

BRANCH, ROUNDS = 12, 8


@dataclass
class Tree:
    """Nodes by number: the centres and radii of their kids and the kids' numbers; leaves are negative."""

    centres: list[np.ndarray] = field(default_factory=list)
    radii: list[np.ndarray] = field(default_factory=list)
    kids: list[list[int]] = field(default_factory=list)
    leaves: int = 0
    visits: int = 1
    recall: float = 1.0

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf that each vector goes down to, by nearest centre."""
        out = np.zeros(len(vectors), np.int64)
        todo = [(0, np.arange(len(vectors)))] if self.kids else []
        while todo:
            node, rows = todo.pop()
            centres = self.centres[node]
            near = ((centres**2).sum(1) - 2 * vectors[rows] @ centres.T).argmin(1)
            for k, kid in enumerate(self.kids[node]):
                own = rows[near == k]
                if not len(own):
                    continue
                if kid < 0:
                    out[own] = -kid - 1
                else:
                    todo.append((kid, own))
        return out

    def walk(self, query: np.ndarray, visits: int) -> list[int]:
        """The first leaves that the best-bin-first walk opens."""
        if not self.kids:
            return [0]
        length = float(np.sqrt((query**2).sum()))
        heap, out = [(0.0, 0)], []
        while heap and len(out) < visits:
            _, node = heapq.heappop(heap)
            if node < 0:
                out.append(-node - 1)
                continue
            most = self.centres[node] @ query + length * self.radii[node]
            for value, kid in zip(most.tolist(), self.kids[node], strict=True):
                heapq.heappush(heap, (-value, kid))
        return out


def grow(sample: np.ndarray, leaf: int, seed: int = 7) -> Tree:
    """A tree whose leaves have about `leaf` vectors of the sample."""
    tree, rng = Tree(), np.random.default_rng(seed)

    def split(rows: np.ndarray) -> int:
        if len(rows) <= leaf or len(np.unique(sample[rows[:64]], axis=0)) < 2:
            tree.leaves += 1
            return -tree.leaves
        node = len(tree.kids)
        for part in (tree.centres, tree.radii, tree.kids):
            part.append([])
        centres, near = kmeans(sample[rows], min(BRANCH, -(-len(rows) // leaf) + 1), rng)
        radii, kids, kept = [], [], []
        for k in range(len(centres)):
            own = rows[near == k]
            if len(own):
                spread = np.sqrt(((sample[own] - centres[k]) ** 2).sum(1))
                kept.append(k)
                radii.append(float(spread.mean()) / 2)
                kids.append(split(own) if len(own) < len(rows) else _leaf(tree))
        tree.centres[node], tree.radii[node], tree.kids[node] = centres[kept], np.array(radii), kids
        return node

    if len(sample) > leaf:
        split(np.arange(len(sample)))
    tree.leaves = max(tree.leaves, 1)
    return tree if tree.kids else Tree(leaves=1)


def _leaf(tree: Tree) -> int:
    tree.leaves += 1
    return -tree.leaves


def kmeans(points: np.ndarray, k: int, rng) -> tuple[np.ndarray, np.ndarray]:
    centres = points[rng.choice(len(points), k, replace=False)]
    for _ in range(ROUNDS):
        near = ((centres**2).sum(1) - 2 * points @ centres.T).argmin(1)
        for c in range(k):
            own = points[near == c]
            if len(own):
                centres[c] = own.mean(0)
    return centres, ((centres**2).sum(1) - 2 * points @ centres.T).argmin(1)


def usable(vector: str) -> Column:
    """Whether a vector has only finite components and is not zero."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return x.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(x, lambda v: v != 0), F.lit(False))


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed alike for each row, so that equal rows tie."""
    return (vectors * query).sum(1)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= edge)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def truths(rows: DataFrame, queries: pd.DataFrame, tree: Tree, k: int) -> pd.DataFrame:
    """The true neighbours of some queries over all rows, and the leaves they are in."""
    ids, matrix = queries["id"].to_numpy(np.int64), np.stack(queries["v"].to_numpy()).astype(np.float64)
    sent = rows.sparkSession.sparkContext.broadcast((ids, matrix, tree))

    def found(batches):
        ids, matrix, tree = sent.value
        for batch in batches:
            own, vectors = batch.column(0).to_numpy(), _matrix(batch.column(1))
            leaves = tree.leaf_of(vectors)
            for q, query in zip(ids.tolist(), matrix, strict=True):
                scores = products(vectors, query)
                scores[own == q] = -np.inf
                top = best(own, scores, k)
                top = top[scores[top] > -np.inf]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(top), q)), pa.array(own[top]), pa.array(scores[top]), pa.array(leaves[top])], names=["q", "id", "score", "leaf"]
                )

    each = rows.select("id", "v").mapInArrow(found, "q bigint, id bigint, score double, leaf bigint")
    return _nearest(each, k, "q").toPandas()


def _nearest(each: DataFrame, k: int, *query: str) -> DataFrame:
    by = Window.partitionBy(*query).orderBy(F.desc("score"), "id")
    return each.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def fit(rows: DataFrame, queries: DataFrame, k: int, target: float, sample: int, leaf: int, probes: int) -> Tree:
    """The tree of a bounded sample of (id, v), its visits calibrated with `probes` of the queries.

    The sample and the probes are the rows whose hashed id is smallest.
    """
    total = rows.count()
    some = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toPandas()
    if not total:
        return Tree(leaves=1)
    points = np.stack(some["v"].to_numpy()).astype(np.float64)
    tree = grow(points, max(8, round(leaf * len(points) / total)))
    asked = queries.orderBy(F.xxhash64(F.lit("probe"), "id"), "id").limit(probes).toPandas()
    if not len(asked):
        return tree
    true = truths(rows, asked, tree, k)
    places = []
    for q, v in zip(asked["id"].to_numpy(), asked["v"].to_numpy(), strict=True):
        order = {x: i for i, x in enumerate(tree.walk(np.asarray(v, np.float64), tree.leaves))}
        places += [order[x] for x in true[true["q"] == q]["leaf"]]
    places = np.sort(np.array(places)) if places else np.zeros(1)
    need = min(len(places) - 1, int(np.ceil(target * len(places))) - 1)
    tree.visits = int(places[max(need, 0)]) + 1
    tree.recall = float((places < tree.visits).mean())
    return tree


def nearest(
    vectors: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    target: float = 0.95,
    sample: int = 20_000,
    leaf: int = 256,
    probes: int = 128,
    groups: int = 16,
    crowd: int = 4096,
) -> DataFrame:
    """(query_id, rank, vec_id, score): up to k nearest found of each query, by inner product.

    Queries are the rows where `is_query` holds; candidates all rows but those with the
    query's key. Vectors that are null, zero, or hold null or non-finite components take
    no part, nor do those of another length than most, nor rows with a null key. Ties go to
    the smaller key. A query that stands twice is asked once; one key with several vectors has
    a list for each. Repeated rows are candidates each. Every row is indexed; no rows, no
    result.
    """
    right = vectors.filter(usable(vector) & F.col(key).isNotNull())
    rows = right.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.filter(F.size("v") == (sizes["n"] if sizes else 0))
    tree = fit(rows.select("id", "v"), rows.filter("asks").select("id", "v"), k, target, sample, leaf, probes)
    spark = vectors.sparkSession
    sent = spark.sparkContext.broadcast(tree)

    def placed(batches):
        tree = sent.value
        for batch in batches:
            leaves = tree.leaf_of(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves)], names=["id", "v", "asks", "leaf"])

    kind = vectors.schema[vector].dataType.simpleString()
    spread = landed(rows.mapInArrow(placed, f"id bigint, v {kind}, asks boolean, leaf bigint"), "leaves")
    # At most a row for each of the tree's leaves, which the sample bounds.
    own = {r["leaf"]: r["n"] for r in spread.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    dealt = deal(own, groups)
    where = spark.sparkContext.broadcast(dealt)

    def asked(batches):
        """A query goes to each group with the leaves that its walk opens there."""
        tree, (first, parts) = sent.value, where.value
        for batch in batches:
            ids, wanted, kept = batch.column(0), [], []
            for i, query in enumerate(_matrix(batch.column(1))):
                by: dict[int, list[int]] = {}
                for at in tree.walk(query, tree.visits):
                    for g in range(first.get(at, 0), first.get(at, 0) + parts.get(at, 0)):
                        by.setdefault(g, []).append(at)
                for g, leaves in by.items():
                    kept.append(i)
                    wanted.append((g, leaves))
            at = pa.array(kept, pa.int64())
            columns = [pa.array([g for g, _ in wanted], pa.int64()), ids.take(at), batch.column(1).take(at), pa.array([w for _, w in wanted], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["grp", "id", "v", "walk"])

    queries = spread.filter("asks").select("id", "v").distinct()
    asks = landed(queries.mapInArrow(asked, f"grp bigint, id bigint, v {kind}, walk array<bigint>"), "walks")
    crowds = asks.groupBy("grp").agg(F.ceil(F.count("*") / crowd).cast("long").alias("crowds"))
    asks = asks.join(crowds, "grp").withColumn("crowd", F.pmod(F.xxhash64(F.lit("crowd"), "id"), F.col("crowds")))
    first = spark.createDataFrame([(at, g, dealt[1][at]) for at, g in dealt[0].items()], "leaf bigint, first bigint, parts bigint")
    listed = spread.join(first, "leaf").withColumn("grp", F.col("first") + F.pmod(F.xxhash64("id", "v"), F.col("parts")))
    listed = listed.join(crowds, "grp").withColumn("crowd", F.explode(F.expr("sequence(0L, crowds - 1)")))
    # Queries before vectors: leaf -1.
    none = F.lit(None).cast("array<bigint>").alias("walk")
    hashed = F.xxhash64("v").alias("h")
    both = asks.select("grp", "crowd", F.lit(-1).cast("bigint").alias("leaf"), "id", "v", "walk", hashed).unionByName(
        listed.select("grp", "crowd", "leaf", "id", "v", none, F.lit(0).cast("bigint").alias("h"))
    )

    def found(batches):
        task = None
        for group, leaf, ids, own, hashes, walks in _stretches(batches):
            if task is None or task.group != group:
                if task is not None:
                    yield from task.result()
                task = _Crowd(group, k)
            if leaf < 0:
                task.ask(ids, own, hashes, walks)
            else:
                task.look(leaf, ids, own)
        if task is not None:
            yield from task.result()

    dealt_rows = both.repartition("grp", "crowd").sortWithinPartitions("grp", "crowd", "leaf")
    each = dealt_rows.mapInArrow(found, "q bigint, h bigint, id bigint, score double")
    return _nearest(each, k, "q", "h").select(F.col("q").alias("query_id"), F.col("rank"), F.col("id").alias(key), "score")


def deal(sizes: dict[int, int], groups: int) -> tuple[dict[int, int], dict[int, int]]:
    """The first group of each leaf and how many it is spread over; no group has much more than its share of all rows."""
    share = max(1, -(-sum(sizes.values()) // groups))
    first, parts, group, room = {}, {}, 0, share
    for leaf, n in sorted(sizes.items()):
        if n > share:
            if room < share:
                group, room = group + 1, share
            first[leaf], parts[leaf] = group, -(-n // share)
            group += parts[leaf]
            continue
        if room < share and n > room:
            group, room = group + 1, share
        first[leaf], parts[leaf] = group, 1
        room -= n
    return first, parts


class _Crowd:
    """The best rows so far of each query of a crowd, leaf by leaf."""

    def __init__(self, group: tuple[int, int], k: int):
        self.group, self.k = group, k
        self.ids: list[int] = []
        self.hashes: list[int] = []
        self.vectors: list[np.ndarray] = []
        self.tops: list[tuple[np.ndarray, np.ndarray]] = []
        self.visitors: dict[int, list[int]] = {}

    def ask(self, ids: np.ndarray, own: np.ndarray, hashes: np.ndarray, walks: list[list[int]]) -> None:
        for q, h, query, walk in zip(ids.tolist(), hashes.tolist(), own, walks, strict=True):
            for leaf in walk:
                self.visitors.setdefault(leaf, []).append(len(self.ids))
            self.ids.append(q)
            self.hashes.append(h)
            self.vectors.append(query)
            self.tops.append((np.zeros(0, np.int64), np.zeros(0)))

    def look(self, leaf: int, names: np.ndarray, candidates: np.ndarray) -> None:
        visitors = self.visitors.get(leaf, [])
        if not visitors:
            return
        # A quick product finds who may beat a query's worst; the exact one decides.
        rough = candidates @ np.stack([self.vectors[i] for i in visitors]).T
        slack = 1e-9 * (1 + np.abs(rough).max())
        for column, i in enumerate(visitors):
            held, scores = self.tops[i]
            floor = scores[-1] - slack if len(scores) == self.k else -np.inf
            some = np.flatnonzero(rough[:, column] >= floor)
            some = some[names[some] != self.ids[i]]
            if not len(some):
                continue
            if len(some) > 4 * self.k:
                edge = np.partition(rough[some, column], len(some) - self.k)[len(some) - self.k]
                some = some[rough[some, column] >= edge - slack]
            names_ = np.concatenate([held, names[some]])
            scores_ = np.concatenate([scores, products(candidates[some], self.vectors[i])])
            top = best(names_, scores_, self.k)
            self.tops[i] = names_[top], scores_[top]

    def result(self):
        sizes = [len(t[0]) for t in self.tops]
        if not sum(sizes):
            return
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array(self.ids, np.int64), sizes)),
                pa.array(np.repeat(np.array(self.hashes, np.int64), sizes)),
                pa.array(np.concatenate([t[0] for t in self.tops])),
                pa.array(np.concatenate([t[1] for t in self.tops])),
            ],
            names=["q", "h", "id", "score"],
        )


def _stretches(batches):
    """((group, crowd), leaf, ids, vectors, hashes, walks) of each run of equal group, crowd and leaf in a batch."""
    for batch in batches:
        names = np.stack([batch.column(i).to_numpy() for i in range(3)], 1)
        if not len(names):
            continue
        ids, own, hashes = batch.column(3).to_numpy(), _matrix(batch.column(4)), batch.column(6).to_numpy()
        cuts = np.flatnonzero((names[1:] != names[:-1]).any(1)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)], strict=True):
            walks = batch.column(5).slice(a, b - a).to_pylist() if names[a, 2] < 0 else []
            yield (int(names[a, 0]), int(names[a, 1])), int(names[a, 2]), ids[a:b], own[a:b], hashes[a:b], walks
