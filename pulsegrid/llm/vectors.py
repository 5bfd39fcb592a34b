"""What both searches share: usable vectors, equal vectors folded, final ranks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not empty, no null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))


def folded(rows: DataFrame, k: int) -> DataFrame:
    """Distinct vectors (column `vec`) with `ids`, the k + 1 smallest ids among equal ones.

    No more of equal vectors can be among the k nearest of a query, its own row left
    out.  Repeated ids count once.  The limit on ranks is applied before the shuffle,
    so many copies of one vector are not gathered.
    """
    order = Window.partitionBy("vec").orderBy("id")
    first = rows.withColumn("_place", F.dense_rank().over(order)).where(F.col("_place") <= k + 1)
    return first.groupBy("vec").agg(F.array_sort(F.collect_set("id")).alias("ids"))


def matrix(column: pa.ChunkedArray | pa.Array, dtype) -> np.ndarray:
    """List column of equally long lists as a matrix."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(whole, pa.ChunkedArray):
        whole = pa.concat_arrays(whole.chunks) if whole.num_chunks else pa.array([], whole.type)
    n = len(whole)
    return whole.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(n, -1) if n else np.zeros((0, 0), dtype)


class Owners:
    """Who the rows of a block are: `ids[i]` are the sorted ids of row i."""

    def __init__(self, ids: list[list[int]]) -> None:
        self.first = np.array([own[0] for own in ids], np.int64)
        self.second = np.array([own[1] if len(own) > 1 else np.iinfo(np.int64).max for own in ids], np.int64)
        self.only: dict[int, list[int]] = {}
        for i, own in enumerate(ids):
            if len(own) == 1:
                self.only.setdefault(own[0], []).append(i)

    def own_rows(self, query_id: int) -> list[int]:
        """Rows that are nobody else's: no candidates of this query, however many there are."""
        return self.only.get(query_id, [])

    def ranked(self, query_id: int, rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Places in `rows` of the k best, ties by the least id other than the query's; of equal scores, no row
        beyond these can hold one of the k smallest ids."""
        least = np.where(self.first[rows] == query_id, self.second[rows], self.first[rows])
        return np.lexsort((least, -scores))[:k]


def best(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of (query_id, ids, score); ties to the smaller id, a query's own id left out."""
    each = found.select("query_id", F.explode("ids").alias("vec_id"), "score").where(F.col("vec_id") != F.col("query_id")).distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
