"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is grown on a bounded sample of unit vectors: every node splits its
members into `BRANCHES` clusters until they are few.  All vectors are sent down to
their leaf.  A query walks the tree best bin first: a priority queue holds the
branches not taken, nearest centre first, and gives leaf after leaf.  How many
leaves are visited is calibrated: for a bounded set of queries the exact
neighbours are found by brute force over all rows, and the visits are widened
until the wanted share of them lies in visited leaves.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import unit
from pulsegrid.llm.vectors import Owners, best, folded, matrix, usable
from pulsegrid.runtime import pin

SAMPLE_VECTORS = 16_384
LEAF_SAMPLES = 192
BRANCHES = 8
CALIBRATION_QUERIES = 256  # half of them set the visits, half measure the recall
RECALL = 0.95
# Vectors that meet queries in one task: enough groups to spread small tables, few enough rows to bound memory.
SPREAD, LEAST_ROWS, MOST_ROWS = 32, 512, 16_384
_ROUNDING = 1e-9  # above what two ways to the same cosine can differ


def _k_means(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centres = points[rng.choice(len(points), k, replace=False)]
    side = np.zeros(len(points), np.int64)
    for _ in range(rounds):
        side = np.argmin((centres**2).sum(axis=1)[None, :] - 2 * points @ centres.T, axis=1)
        fresh = np.array([points[side == c].mean(axis=0) if (side == c).any() else centres[c] for c in range(k)])
        if np.allclose(fresh, centres):
            break
        centres = fresh
    return centres, side


@dataclass(frozen=True)
class Tree:
    """centres[i] is the centre of node i (node 0 the root), first_child[i] its first child or -1 for a leaf, leaf[i] its leaf number."""

    centres: np.ndarray
    first_child: np.ndarray
    children: np.ndarray
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int((self.first_child < 0).sum())

    def descend(self, points: np.ndarray) -> np.ndarray:
        """Leaf of each point: at every node the nearest child."""
        out, todo = np.zeros(len(points), np.int64), [(0, np.arange(len(points)))]
        while todo:
            node, members = todo.pop()
            if self.first_child[node] < 0:
                out[members] = self.leaf[node]
                continue
            first = self.first_child[node]
            centres = self.centres[first : first + self.children[node]]
            side = np.argmin((centres**2).sum(axis=1)[None, :] - 2 * points[members] @ centres.T, axis=1)
            todo += [(first + c, members[side == c]) for c in range(len(centres)) if (side == c).any()]
        return out

    def visits(self, point: np.ndarray, most: int) -> list[int]:
        """Leaves in best-bin-first order, at most `most`."""
        apart = ((self.centres - point) ** 2).sum(axis=1)
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            while self.first_child[node] >= 0:
                first = int(self.first_child[node])
                kids = range(first, first + int(self.children[node]))
                nearest = min(kids, key=lambda c: (apart[c], c))
                for c in kids:
                    if c != nearest:
                        heapq.heappush(queue, (float(apart[c]), c))
                node = nearest
            out.append(int(self.leaf[node]))
        return out


def grow(sample: np.ndarray, leaf_samples: int = LEAF_SAMPLES, branches: int = BRANCHES, seed: int = 11) -> Tree:
    rng = np.random.default_rng(seed)
    dim = sample.shape[1] if sample.ndim == 2 and len(sample) else 1
    centres, first, count, todo = [np.zeros(dim)], [-1], [0], [(0, np.arange(len(sample)))]
    while todo:
        node, members = todo.pop()
        if len(members) <= leaf_samples:
            continue
        means, side = _k_means(sample[members], min(branches, len(members)), rng)
        kept = [c for c in range(len(means)) if (side == c).any()]
        if len(kept) < 2:  # equal points cannot be split
            continue
        first[node], count[node] = len(centres), len(kept)
        for c in kept:
            todo.append((len(centres), members[side == c]))
            centres.append(means[c])
            first.append(-1)
            count.append(0)
    first_child = np.array(first)
    leaf = np.where(first_child < 0, np.cumsum(first_child < 0) - 1, -1)
    return Tree(np.array(centres), first_child, np.array(count), leaf)


def _unit_rows(points: np.ndarray) -> np.ndarray:
    """Divided by their length; scaled first, so that no square over- or underflows."""
    scaled = points / np.abs(points).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def _cosine(query: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Cosines of one vector with many, each by the same order of operations."""
    return (points * query).sum(axis=1) / np.sqrt((points * points).sum(axis=1) * (query * query).sum())


@dataclass(frozen=True)
class Calibration:
    """Leaves that a query visits, the recall this gives other queries than those that set it, and how many there were of both."""

    visits: int
    recall: float
    queries: int


def calibrate(tree: Tree, vectors: DataFrame, queries: list[tuple[int, np.ndarray]], k: int, recall: float = RECALL) -> Calibration:
    """Leaf visits that reach `recall` for a bounded set of queries, against brute force over all `vectors` (vec, ids)."""
    if not queries:
        return Calibration(1, 1.0, 0)
    names = [q for q, _ in queries]
    points = _unit_rows(np.stack([v for _, v in queries]))
    schema = pa.schema([("q", pa.int32()), ("score", pa.float64()), ("leaf", pa.int32())])

    def nearest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple[float, int]]] = [[] for _ in names]
        for batch in batches:
            if not batch.num_rows:
                continue
            theirs = _unit_rows(matrix(batch.column(0), np.float64))
            leaf = tree.descend(theirs)
            ids = batch.column(1).to_pylist()
            near, owners = points @ theirs.T, Owners(ids)
            for q, name in enumerate(names):
                near[q, owners.own_rows(name)] = -np.inf
                top = np.argsort(-near[q], kind="stable")[:k]
                more = [(-float(near[q, i]), int(leaf[i])) for i in top if np.isfinite(near[q, i]) for vec_id in ids[i] if vec_id != name]
                held[q] = sorted(held[q] + more)[:k]
        rows = [(q, -s, leaf) for q, own in enumerate(held) for s, leaf in own]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    local = vectors.select("vec", "ids").mapInArrow(nearest, "q int, score double, leaf int")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "leaf")
    exact = local.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).collect()  # k rows for each calibration query
    places = {q: {leaf: i for i, leaf in enumerate(tree.visits(points[q], tree.leaves))} for q in range(len(names))}
    needed = [(r.q, places[r.q][r.leaf] + 1) for r in exact]
    # Every other query sets the visits; the recall is that of the rest, where there are any.
    setting = sorted(n for q, n in needed if q % 2 == 0 or len(names) == 1)
    if not setting:
        return Calibration(tree.leaves, 1.0, len(names))
    visits = setting[min(len(setting) - 1, int(np.ceil(recall * len(setting))) - 1)]
    measured = [n <= visits for q, n in needed if q % 2 == 1] or [True]
    return Calibration(visits, sum(measured) / len(measured), len(names))


def search(
    embeddings: DataFrame, queries: DataFrame, k: int = 5, recall: float = RECALL, sample: int = SAMPLE_VECTORS
) -> tuple[DataFrame, Calibration]:
    """(query_id, rank, vec_id, score) of the nearest found for each query, and the calibration.

    `embeddings` has vec_id and embedding, `queries` query_id and embedding.  Nearness
    is the cosine in double precision.  Vectors that are null, empty, zero or hold a
    null or non-finite component take no part; neither do null ids, and vectors of
    another length than the query's are a mistake in the table and raise.  A query's
    own id is no candidate, however often it is repeated; equal vectors tie and the
    smaller id comes first.
    """
    point = F.transform("embedding", lambda x: x.cast("double"))
    fit = usable(F.col("embedding")) & F.exists("embedding", lambda x: x != 0)
    rows = embeddings.where(F.col("vec_id").isNotNull() & fit).select(F.col("vec_id").alias("id"), point.alias("vec"))
    asked = queries.where(F.col("query_id").isNotNull() & fit).select("query_id", point.alias("point"))
    vectors = pin(folded(rows, k))
    asked = pin(asked)

    # The tree: at most `sample` distinct vectors, those with the smallest hash.
    chosen = vectors.orderBy(F.xxhash64("vec")).limit(sample).select("vec").toArrow()
    if not chosen.num_rows:
        empty = asked.where("false").select("query_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("vec_id"), F.lit(0.0).alias("score"))
        return empty, Calibration(0, 1.0, 0)
    tree = grow(_unit_rows(matrix(chosen.column("vec"), np.float64)))
    few = asked.orderBy(F.xxhash64("query_id"), "query_id").limit(CALIBRATION_QUERIES).collect()
    measured = calibrate(tree, vectors, [(r.query_id, np.array(r.point)) for r in few], k, recall)

    # Index: every vector in its leaf, leaves in chunks, chunks dealt to groups of about equal size.
    n_vectors, n_asked = vectors.count(), asked.count()

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = pa.array(tree.descend(_unit_rows(matrix(batch.column(0), np.float64))), pa.int32())
                yield pa.RecordBatch.from_arrays([*batch.columns, leaf], names=["vec", "ids", "leaf"])

    index = pin(vectors.select("vec", "ids").mapInArrow(place, "vec array<double>, ids array<long>, leaf int"))
    group_rows = min(MOST_ROWS, max(LEAST_ROWS, n_vectors // SPREAD))
    groups, parts = -(-n_vectors // group_rows), max(1, -(-n_asked // MOST_ROWS))
    sizes = {r.leaf: r["count"] for r in index.groupBy("leaf").count().collect()}  # one row per leaf of the bounded tree
    chunks = {leaf: -(-n // max(1, group_rows // 4)) for leaf, n in sizes.items()}
    first = dict(zip(sorted(chunks), np.cumsum([0, *(chunks[leaf] for leaf in sorted(chunks))])[:-1].tolist()))
    most = measured.visits

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each query the leaves to visit, by the groups that hold parts of them."""
        for batch in batches:
            rows: list[tuple[int, int, list[int]]] = []
            points = _unit_rows(matrix(batch.column(1), np.float64)) if batch.num_rows else []
            for i, point in enumerate(points):
                wanted: dict[int, list[int]] = {}
                for leaf in tree.visits(point, most):
                    for c in range(min(groups, chunks.get(leaf, 0))):
                        wanted.setdefault((first[leaf] + c) % groups, []).append(leaf)
                rows += [(i, g, leaves) for g, leaves in wanted.items()]
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.list_(pa.int32()))],
                names=["query_id", "point", "group", "leaves"],
            )

    salt = lambda n, c: F.least(F.floor(unit(c, seed=13) * n), n - 1).cast("int")
    wanted = asked.mapInArrow(walk, "query_id long, point array<double>, group int, leaves array<int>")
    wanted = wanted.withColumn("part", salt(F.lit(parts), F.col("query_id")))
    by_leaf = F.broadcast(index.sparkSession.createDataFrame([(leaf, first[leaf], chunks[leaf]) for leaf in chunks], "leaf int, _first int, _chunks int"))
    group = F.pmod(F.col("_first") + salt(F.col("_chunks"), F.element_at("ids", 1)), F.lit(groups)).cast("int")
    held = index.join(by_leaf, "leaf").select("vec", "ids", "leaf", group.alias("group"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    schema = pa.schema([("query_id", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])

    def meet(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        """The best of the group's vectors in the leaves that each query visits."""
        if not mine.num_rows or not theirs.num_rows:
            return schema.empty_table()
        points, others = matrix(mine.column("point"), np.float64), matrix(theirs.column("vec"), np.float64)
        flat, leaf = _unit_rows(others), theirs.column("leaf").to_numpy()
        names, ids, leaves = (t.column(c).to_pylist() for t, c in ((mine, "query_id"), (theirs, "ids"), (mine, "leaves")))
        out: list[tuple] = []
        owners = Owners(ids)
        for start in range(0, len(points), 256):
            near = _unit_rows(points[start : start + 256]) @ flat.T
            for i, row in enumerate(near):
                q = start + i
                row[~np.isin(leaf, leaves[q])] = -np.inf
                row[owners.own_rows(names[q])] = -np.inf
                # All that rounding could bring among the k best are ranked exactly.
                edge = np.partition(row, -k)[-k] if len(row) > k else -np.inf
                top = np.flatnonzero(row >= max(edge - _ROUNDING, -2.0))
                exact = _cosine(points[q], others[top])
                out += [(names[q], ids[top[j]], float(exact[j])) for j in owners.ranked(names[q], top, exact, k)]
        if not out:
            return schema.empty_table()
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    key = ["group", "part"]
    met = wanted.groupBy(*key).cogroup(held.groupBy(*key)).applyInArrow(meet, "query_id long, ids array<long>, score double")
    return best(met, k), measured
