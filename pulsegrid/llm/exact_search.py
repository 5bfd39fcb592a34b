"""Exact top-k search by a vector-approximation file.

Every component is quantised to one of `CELLS` cells of its dimension.  A query
block meets a block of rows; from the cells alone each inner product is bounded
from below and above.  The kth largest lower bound rules rows out; the exact
vectors of the others are read in the order of their bounds, best first, until the
kth result found is certain, that is, no bound left can beat it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import unit
from pulsegrid.llm.vectors import Owners, best, folded, matrix, usable
from pulsegrid.runtime import pin

SCALE = 256
CELLS = 64
# Rows per block: enough blocks to spread small tables, few enough rows to bound a task's memory.
SPREAD, LEAST_BLOCK, MOST_BLOCK = 32, 512, 16_384
READ = 32  # exact vectors read at a time
_EXACT_DOUBLE = 1 << 53


@dataclass(frozen=True)
class Cells:
    """Lower edge and width of the cells of each dimension; integers."""

    low: np.ndarray
    width: np.ndarray

    def encode(self, points: np.ndarray) -> np.ndarray:
        return ((points - self.low) // self.width).astype(np.uint8)

    def bounds(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest components of the cells."""
        low = self.low + cells.astype(np.int64) * self.width
        return low, low + self.width - 1


def cells_of(rows: DataFrame, cells: int = CELLS) -> Cells | None:
    """Equal cells between the least and greatest component of each dimension of column `vec`."""
    each = rows.select(F.posexplode("vec").alias("d", "x")).groupBy("d").agg(F.min("x").alias("a"), F.max("x").alias("b"))
    found = sorted(each.collect(), key=lambda r: r.d)  # one row per dimension
    if not found:
        return None
    low = np.array([r.a for r in found], np.int64)
    return Cells(low, np.array([-(-(r.b - r.a + 1) // cells) for r in found], np.int64))


def _top(
    query_id: int, query: np.ndarray, owners: Owners, skip: np.ndarray, low: np.ndarray, high: np.ndarray, exact: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, int]:
    """(rows, scores, rows read): the k best rows for one query, from its bounds; ties to the row with the smaller id."""
    allowed = np.flatnonzero(~skip)
    if len(allowed) > k:
        least = np.partition(low[allowed], -k)[-k]
        allowed = allowed[high[allowed] >= least]
    order = allowed[np.argsort(-high[allowed], kind="stable")]
    rows, scores, at = order[:0], exact[:0, 0], 0
    while at < len(order) and not (len(rows) >= k and scores[k - 1] > high[order[at]]):
        more = order[at : at + READ]
        rows, scores, at = np.concatenate([rows, more]), np.concatenate([scores, exact[more] @ query]), at + len(more)
        place = owners.ranked(query_id, rows, scores, k)
        rows, scores = rows[place], scores[place]
    return rows, scores, at


def top_k(
    query_ids: list[int], queries: np.ndarray, ids: list[list[int]], cells: np.ndarray, exact: np.ndarray, grid: Cells, k: int
) -> list[tuple[int, int, int]]:
    """(query, row, score) of the k best rows of one block for each query, those left out that only the query's own id has."""
    low, high = grid.bounds(cells)
    largest = int(max(np.abs(low).max(), np.abs(high).max())) * max(1, int(np.abs(queries).max())) * queries.shape[1]
    kind = np.float64 if largest < _EXACT_DOUBLE else object  # beyond that, Python's integers keep sums exact
    plus, minus = np.maximum(queries, 0).astype(kind), np.minimum(queries, 0).astype(kind)
    low, high = low.astype(kind), high.astype(kind)
    if kind is object:
        exact, queries = exact.astype(kind), queries.astype(kind)
    owners = Owners(ids)
    out = []
    for start in range(0, len(queries), 256):
        part = slice(start, start + 256)
        upper = plus[part] @ high.T + minus[part] @ low.T
        lower = plus[part] @ low.T + minus[part] @ high.T
        for i, q in enumerate(range(start, min(start + 256, len(queries)))):
            skip = np.zeros(len(ids), bool)
            skip[owners.own_rows(query_ids[q])] = True
            rows, scores, _ = _top(query_ids[q], queries[q], owners, skip, lower[i], upper[i], exact, k)
            out += [(q, int(row), int(score)) for row, score in zip(rows, scores, strict=True)]
    return out


def search(embeddings: DataFrame, queries: DataFrame, k: int = 5, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k greatest inner products of floor(scale * x) vectors, exactly.

    `embeddings` has vec_id and embedding, `queries` query_id and embedding.  Vectors
    that are null, empty or hold a null or non-finite component take no part, nor do
    null ids; zero vectors do.  A query's own id is no candidate; ties go to the
    smaller id.  Components and scores must fit a long.
    """
    floor = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    rows = embeddings.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(F.col("vec_id").alias("id"), floor.alias("vec"))
    asked = pin(queries.where(F.col("query_id").isNotNull() & usable(F.col("embedding"))).select("query_id", floor.alias("point")))
    vectors = pin(folded(rows, k))
    grid = cells_of(vectors)
    n, n_asked = vectors.count(), asked.count()
    block = min(MOST_BLOCK, max(LEAST_BLOCK, n // SPREAD))
    blocks, parts = max(1, -(-n // block)), max(1, -(-n_asked // MOST_BLOCK))
    if grid is None or not n_asked:
        return asked.where("false").select("query_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("vec_id"), F.lit(0).cast("long").alias("score"))

    # The approximation file: cells beside the exact vectors, in blocks.
    def approximate(batches):
        for batch in batches:
            if batch.num_rows:
                codes = grid.encode(matrix(batch.column(0), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array([c.tobytes() for c in codes], pa.binary())], names=["vec", "ids", "cells"]
                )

    filed = pin(vectors.select("vec", "ids").mapInArrow(approximate, "vec array<long>, ids array<long>, cells binary"))
    salt = lambda m, c, seed: F.least(F.floor(unit(c, seed=seed) * m), F.lit(m - 1)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    held = filed.withColumn("block", salt(blocks, F.element_at("ids", 1), 21)).select("vec", "ids", "cells", "block", every(parts).alias("part"))
    wanted = asked.withColumn("part", salt(parts, F.col("query_id"), 22)).select("query_id", "point", "part", every(blocks).alias("block"))
    schema = pa.schema([("query_id", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.int64())])

    def meet(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        if not mine.num_rows or not theirs.num_rows:
            return schema.empty_table()
        names, ids = mine.column("query_id").to_pylist(), theirs.column("ids").to_pylist()
        points, exact = matrix(mine.column("point"), np.int64), matrix(theirs.column("vec"), np.int64)
        codes = np.frombuffer(b"".join(theirs.column("cells").to_pylist()), np.uint8).reshape(len(ids), -1)
        found = top_k(names, points, ids, codes, exact, grid, k)
        columns = [[names[q] for q, _, _ in found], [ids[row] for _, row, _ in found], [int(s) for _, _, s in found]]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    key = ["block", "part"]
    met = wanted.groupBy(*key).cogroup(held.groupBy(*key)).applyInArrow(meet, "query_id long, ids array<long>, score long")
    return best(met, k)
