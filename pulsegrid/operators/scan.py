"""Ordered numbering and running totals that never need one task per group.

Spark's window functions put a whole window partition into one task.  That is
fine for bounded groups; for a whole table, or a key that holds much of it, the
functions here range-partition on (group, order) instead.  A group may then span
many partitions; what the earlier partitions hold is added from a table with one
row per (group, partition).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.runtime import BROADCAST_ROWS, pin, settled, shuffle_width

_CHUNK = "_chunk"
_SLOT = "_slot"
_SLOT_BITS = 33  # monotonically_increasing_id: partition id above, row index below


def as_columns(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def sorted_chunks(
    df: DataFrame, within: Sequence[str], order_by: Sequence[str | Column], partitions: int | None = None
) -> DataFrame:
    """Globally sort, pin, and tag each row with its chunk and place in it."""
    keys = [*as_columns(within), *as_columns(order_by)]
    width = partitions or shuffle_width(df.sparkSession)
    ranged = (
        df.repartitionByRange(width, *keys)
        .sortWithinPartitions(*keys)
        .withColumn(_SLOT, F.monotonically_increasing_id())
    )
    return (
        pin(ranged)
        .withColumn(_CHUNK, F.shiftright(_SLOT, _SLOT_BITS).cast("int"))
        .withColumn(_SLOT, F.col(_SLOT).bitwiseAND(F.lit((1 << _SLOT_BITS) - 1)))
    )


def _earlier_chunks(chunked: DataFrame, within: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Per (group, chunk): totals of the same group in all earlier chunks.

    Chunks are ranges of the sorted groups, so this table has at most
    (number of groups + number of chunks) rows, and one group at most one row
    per chunk.
    """
    local = chunked.groupBy(*within, _CHUNK).agg(
        F.min(_SLOT).alias("_first"),
        *[F.sum(expr).alias(f"_part_{name}") for name, expr in sums.items()],
    )
    before = Window.partitionBy(*within).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return local.select(
        *[F.col(k).alias(f"_k_{k}") for k in within],
        F.col(_CHUNK).alias("_k_chunk"),
        "_first",
        *[F.sum(f"_part_{name}").over(before).alias(f"_before_{name}") for name in sums],
    )


def _with_earlier(rows: DataFrame, earlier: DataFrame, within: Sequence[str]) -> DataFrame:
    on = F.col(_CHUNK) == F.col("_k_chunk")
    for key in within:
        on = on & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    # Without groups there is one row per partition of the sort.
    return rows.join(earlier if within else F.broadcast(earlier), on, "inner")


def _numbered_in_windows(df: DataFrame, order_by: Sequence[str | Column], within: Sequence[str], name: str) -> DataFrame:
    spec = Window.partitionBy(*within).orderBy(*as_columns(order_by))
    return df.withColumn(name, F.row_number().over(spec).cast("long"))


def number_rows(
    df: DataFrame,
    order_by: Sequence[str | Column],
    within: Sequence[str] = (),
    name: str = "row_no",
    one_task_rows: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """1-based row number in `order_by` order, overall or per `within` group.

    `order_by` must order the rows of a group totally.
    """
    df, few = settled(df, one_task_rows)
    if few:
        return _numbered_in_windows(df, order_by, within, name)
    chunked = sorted_chunks(df, within, order_by, partitions)
    earlier = _earlier_chunks(chunked, within, {"rows": F.lit(1)})
    return (
        _with_earlier(chunked, earlier, within)
        .withColumn(
            name,
            (F.col(_SLOT) - F.col("_first") + F.coalesce("_before_rows", F.lit(0)) + 1).cast("long"),
        )
        .select(*df.columns, name)
    )


def number_by_key(
    df: DataFrame, order_by: Sequence[str], within: Sequence[str] = (), name: str = "row_no", one_task_rows: int | None = None, **scale
) -> DataFrame:
    """`number_rows` for wide tables whose (within, order_by) is a key: only the key is sorted."""
    df, few = settled(df, one_task_rows)
    if few:
        return _numbered_in_windows(df, order_by, within, name)
    keys = [*within, *order_by]
    numbered = number_rows(df.select(*keys), order_by, within, name, 0, **scale)
    numbered = numbered.withColumnsRenamed({k: f"_n_{k}" for k in keys})
    same = F.expr(" AND ".join(f"`{k}` <=> `_n_{k}`" for k in keys))
    return df.join(numbered, same, "inner").select(*df.columns, name)


def running_totals(
    df: DataFrame,
    order_by: Sequence[str | Column],
    sums: Mapping[str, Column],
    within: Sequence[str] = (),
    one_task_rows: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Inclusive running sum of each expression in `sums`."""
    df, few = settled(df, one_task_rows)
    if few:
        spec = (
            Window.partitionBy(*within)
            .orderBy(*as_columns(order_by))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return df.select("*", *[F.sum(expr).over(spec).alias(name) for name, expr in sums.items()])
    return chunked_totals(sorted_chunks(df, within, order_by, partitions), within, sums).drop(_CHUNK, _SLOT)


def chunked_totals(chunked: DataFrame, within: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Running sums over frames from `sorted_chunks`; a window never exceeds one chunk."""
    spec = (
        Window.partitionBy(*within, _CHUNK)
        .orderBy(_SLOT)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = chunked.select("*", *[F.sum(expr).over(spec).alias(f"_local_{n}") for n, expr in sums.items()])
    joined = _with_earlier(local, _earlier_chunks(chunked, within, sums), within)
    for name in sums:
        here, prior = F.col(f"_local_{name}"), F.col(f"_before_{name}")
        # Either may be null: nothing but null values so far in this chunk, or in those before.
        joined = joined.withColumn(name, F.coalesce(here + prior, here, prior))
    return joined.select(*chunked.columns, *sums)


def hot_groups(
    df: DataFrame, keys: Sequence[str], max_rows: int, fraction: float = 0.001, seed: int = 17
) -> DataFrame:
    """Groups that a sample shows to be larger than about `max_rows` rows.

    Only chooses between two exact ways of computing the same result, so a
    missed or surplus group costs time, never rows.
    """
    sampled = df.select(*keys) if fraction >= 1 else df.select(*keys).sample(fraction, seed)
    return (
        sampled.groupBy(*keys)
        .count()
        .where(F.col("count") > F.lit(max_rows * min(fraction, 1.0)))
        .select(*keys)
    )


def broadcast_checked(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a key table whose counted rows are few; otherwise Spark chooses."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def split_by_groups(
    df: DataFrame, groups: DataFrame, keys: Sequence[str], n_groups: int
) -> tuple[DataFrame, DataFrame]:
    """(rows outside `groups`, rows in `groups`); null keys match null keys."""
    marked = broadcast_checked(groups.select(*[F.col(k).alias(f"_g_{k}") for k in keys]), n_groups)
    on = None
    for key in keys:
        term = F.col(key).eqNullSafe(F.col(f"_g_{key}"))
        on = term if on is None else on & term
    return df.join(marked, on, "left_anti"), df.join(marked, on, "left_semi")
