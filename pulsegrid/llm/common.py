"""Shared by the operators: bounded Arrow slices, stable hashes, held-out rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import count

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text is worked on in slices of at most so many rows and about so many bytes.
SLICE_ROWS = 512
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice has at most `rows` rows and its texts about `limit` bytes; a longer text is alone.

    What the worker holds beside a slice is one Arrow batch, which Spark bounds by rows and bytes.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and (held + n > limit or i - start >= rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)


def pieces(text: str, limit: int = SLICE_BYTES) -> Iterator[str]:
    """Parts of a long text, cut at white space; a run of `limit` characters without any is cut as it is."""
    start, n = 0, len(text)
    while n - start > limit:
        end = start + limit
        cut = max(text.rfind(" ", start, end), text.rfind("\n", start, end))
        end = cut + 1 if cut > start else end
        yield text[start:end]
        start = end
    yield text[start:]


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def remainder_of_three(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(remainder_of_three(doc_id) == 1, F.lit(False))


def may_learn(doc_id: Column) -> Column:
    """Rows a model may be fitted on: an id whose remainder is not 1."""
    return F.coalesce(remainder_of_three(doc_id) != 1, F.lit(False))


def unit(*columns: Column, seed: int = 0) -> Column:
    """A number strictly between 0 and 1 from the hash of the columns; 52 bits, the same in every run."""
    bits = F.shiftrightunsigned(F.xxhash64(*columns, F.lit(seed)), 12)
    return (bits.cast("double") + 0.5) / float(1 << 52)


def with_scanned(
    docs: DataFrame,
    text: str,
    new: list[tuple[str, pa.DataType, str]],
    make: Callable[[], Callable[[list[str | None]], list]],
    keep: Sequence[str] | None = None,
    binary: bool = False,
) -> DataFrame:
    """`docs` (or its columns `keep`) with new columns computed from the text, slice by slice.

    `make` runs once in a task and returns the function that maps a list of
    texts to one column for each of `new` (name, Arrow type, SQL type).  Columns of `docs` with the new names are
    replaced.  With `binary` the texts come as UTF-8 bytes.
    """
    names = [n for n, _, _ in new]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    own = text not in kept or binary
    scanned = next(n for n in _free_names("_scanned") if n not in (*kept, *names)) if own else text
    columns = [F.col(f"`{c}`") for c in kept]
    if own:
        columns.append((F.col(f"`{text}`").cast("binary") if binary else F.col(f"`{text}`")).alias(scanned))
    frame = docs.select(*columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for part in slices(batches, scanned):
            made = work(part.column(scanned).to_pylist())
            at = [i for i, f in enumerate(part.schema) if f.name in kept]
            fields = [*(part.schema.field(i) for i in at), *(pa.field(n, t) for n, t, _ in new)]
            yield batch_of(pa.schema(fields), [*(part.column(i) for i in at), *made])

    fields = [f for f in frame.schema if f.name in kept]
    for name, _, kind in new:
        fields += T.StructType.fromDDL(f"`{name}` {kind}")
    return frame.mapInArrow(run, T.StructType(fields))


def _free_names(stem: str) -> Iterator[str]:
    yield stem
    yield from (f"{stem}{i}" for i in count(1))


def whole_rows(docs: DataFrame, *beside: str) -> DataFrame:
    """Every row as the struct `_doc` with copies of the columns `beside`, so that own columns of any name stay out of the way.

    `select("_doc.*")` gives the rows back.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), *[F.col(f"`{c}`") for c in beside])
