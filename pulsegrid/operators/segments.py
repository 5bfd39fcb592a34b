"""Run array kernels on many small groups per call.

`map_groups` hash-partitions rows by event and sorts them; each task then
streams its Arrow batches and hands the kernel all complete events of a batch at
once, so the cost per event is array arithmetic and not a Python call.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pulsegrid.runtime import spread

Arrays = dict[str, np.ndarray]
# kernel(columns, first row of each group, rows per group) -> columns per group
Kernel = Callable[[Arrays, np.ndarray, np.ndarray], Arrays]


def complete_groups(
    batches: Iterator[pa.RecordBatch], key: str, fold: Callable[[pa.Table], pa.Table] | None = None, fold_rows: int = 100_000
) -> Iterator[pa.Table]:
    """Cut a stream sorted by `key` at group borders.

    A group longer than `fold_rows` is handed to `fold`, which may drop rows that
    cannot matter, so that memory stays bounded while the group streams by.
    """
    held: list[pa.RecordBatch | pa.Table] = []
    held_key, held_rows = None, 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(keys[1:] != keys[:-1])
        if held and keys[0] != held_key:
            yield pa.concat_tables(_tables(held))
            held, held_rows = [], 0
        if len(cuts):
            cut = int(cuts[-1]) + 1
            yield pa.concat_tables(_tables([*held, batch.slice(0, cut)]))
            held, held_rows = [batch.slice(cut)], batch.num_rows - cut
        else:
            held.append(batch)
            held_rows += batch.num_rows
        held_key = keys[-1]
        if fold is not None and held_rows > fold_rows:
            kept = fold(pa.concat_tables(_tables(held)))
            # Later batches are joined to what is kept, so it must have their schema, nullability included.
            held, held_rows = [pa.Table.from_arrays(kept.columns, schema=batch.schema)], kept.num_rows
            fold_rows = max(fold_rows, 2 * held_rows)
    if held:
        yield pa.concat_tables(_tables(held))


def _tables(parts) -> list[pa.Table]:
    return [pa.Table.from_batches([p]) if isinstance(p, pa.RecordBatch) else p for p in parts]


def borders(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1]).astype(np.int64)
    return starts, np.diff(np.append(starts, len(keys)))


def to_arrays(table: pa.Table) -> Arrays:
    return {name: table.column(name).to_numpy() for name in table.column_names}


def map_groups(
    df: DataFrame,
    kernel: Kernel,
    schema: str,
    key: str = "event_no",
    sort: tuple[str, ...] = (),
    fold: Callable[[pa.Table], pa.Table] | None = None,
    fold_rows: int = 100_000,
) -> DataFrame:
    """One output row per `key`; `schema` lists the kernel's columns after it."""
    names = [part.split()[0] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in complete_groups(batches, key, fold, fold_rows):
            columns = to_arrays(table)
            starts, sizes = borders(columns[key])
            out = kernel(columns, starts, sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[key][starts]), *[pa.array(out[n]) for n in names]], names=[key, *names]
            )

    kind = df.schema[key].dataType.simpleString()
    # A given number of tasks: merging small ones by size would leave array work to few cores.
    return (
        df.repartition(spread(df), key)
        .sortWithinPartitions(key, *sort)
        .mapInArrow(run, f"{key} {kind}, {schema}")
    )
