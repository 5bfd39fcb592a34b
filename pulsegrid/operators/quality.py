"""Checks on written tables: completeness, order, ranges, indexes of row ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.functions.ids import shifted_event_no

_REAL = ("float", "double")


def _undefined(name: str, kind: str) -> Column:
    missing = F.col(name).isNull()
    return missing | F.isnan(F.col(name)) if kind in _REAL else missing


def file_name() -> Column:
    return F.col("_metadata.file_name")


def undefined_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Null or NaN values per column, and whether the group is clean; one pass."""
    keys = list(by)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name not in keys}
    counts = [F.count(F.when(_undefined(n, k), 1)).alias(f"undefined_{n}") for n, k in kinds.items()]
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *counts)
    total = None
    for name in kinds:
        total = F.col(f"undefined_{name}") if total is None else total + F.col(f"undefined_{name}")
    return out.withColumn("is_clean", total == 0)


def unexpected_columns(df: DataFrame, expected: Sequence[str]) -> dict[str, list[str]]:
    """Schema check without reading data."""
    present = set(df.columns)
    return {
        "missing": [c for c in expected if c not in present],
        "surplus": [c for c in df.columns if c not in set(expected)],
    }


def event_ranges(df: DataFrame, file: str = "file_name") -> DataFrame:
    return df.groupBy(file).agg(F.min("event_no").alias("first_event"), F.max("event_no").alias("last_event"))


def range_overlaps(ranges: DataFrame, file: str = "file_name") -> DataFrame:
    """Ranges in order of their start, each compared with the one before.

    One row per file or part, so the single window stays as small as the file list.
    """
    line = Window.orderBy("first_event", "last_event", file)
    rows = ranges.withColumn("previous", F.lag(file).over(line)).withColumn("_end", F.lag("last_event").over(line))
    overlap = F.least("_end", "last_event") - F.col("first_event") + 1
    return rows.where(F.col("_end") >= F.col("first_event")).select(
        file, "previous", "first_event", "last_event", overlap.alias("overlap")
    )


def range_conflicts(ranges: DataFrame, file: str = "file_name") -> DataFrame:
    """Ranges in order of their start that begin within any earlier one, with the earlier range that reaches farthest.

    A sweep over the starts with the running maximum of the ends, so a long range is met by all that lie behind it, not
    only by its neighbour.  One row per file or part, so the single window stays as small as the file list.
    """
    line = Window.orderBy("first_event", "last_event", file).rowsBetween(Window.unboundedPreceding, -1)
    far = F.max(F.struct(F.col("last_event").alias("last_event"), F.col(file).alias("name"))).over(line)
    met = ranges.withColumn("_far", far).where(F.col("_far.last_event") >= F.col("first_event"))
    overlap = F.least("_far.last_event", "last_event") - F.col("first_event") + 1
    return met.select(file, F.col("_far.name").alias("earlier"), "first_event", "last_event", overlap.alias("overlap"))


def row_hash(df: DataFrame, seed: int = 0) -> Column:
    """Hash of a row by its columns in order of name; a null counts as a value of its own."""
    cells = []
    for name in sorted(df.columns):
        cells += [F.col(f"`{name}`"), F.isnull(F.col(f"`{name}`"))]
    return F.xxhash64(*cells, F.lit(seed))


def multiset_digest(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per group: rows, sum and exclusive or of the row hashes.

    Does not depend on the order of rows, and repeated rows count; two hashes of 64 bits make equal digests of unequal
    rows improbable.  Rows stay where they are: only the digests of groups are shuffled.
    """
    first = row_hash(df).cast("decimal(20,0)")
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(first).alias("hash_sum"), F.bit_xor(row_hash(df, 1)).alias("hash_xor")
    )


def compare_tables(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group of either table: rows on both sides, and 1 if they hold the same rows equally often.

    Tables of other columns than each other's are a mistake and raise.
    """
    odd = unexpected_columns(right, left.columns)
    if any(odd.values()):
        raise ValueError(f"the tables have other columns: {odd}")
    keys = list(by)
    a, b = multiset_digest(left, keys), multiset_digest(right.select(left.columns), keys)
    a = a.select(*[F.col(k).alias(f"_a_{k}") for k in keys], F.struct("n_rows", "hash_sum", "hash_xor").alias("_a"))
    b = b.select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.struct("n_rows", "hash_sum", "hash_xor").alias("_b"))
    same = F.expr(" AND ".join(f"`_a_{k}` <=> `_b_{k}`" for k in keys))
    return a.join(b, same, "full").select(
        *[F.coalesce(f"_a_{k}", f"_b_{k}").alias(k) for k in keys],
        F.coalesce("_a.n_rows", F.lit(0)).cast("long").alias("n_left"), F.coalesce("_b.n_rows", F.lit(0)).cast("long").alias("n_right"),
        F.col("_a").eqNullSafe(F.col("_b")).cast("int").alias("equal"),
    )


def offset_drops(truth: DataFrame, order_by: Sequence[str] = ("event_no",), within: Sequence[str] = ("part_no",)) -> DataFrame:
    """Rows where the offset falls or the shard changes: the edges of shards.

    Compares each row with its predecessor; joins consecutive row numbers, so
    that a part of any size stays distributed.
    """
    from pulsegrid.operators.scan import number_rows

    keys = list(within)
    rows = number_rows(truth.select(*keys, *order_by, "shard_no", "offset"), order_by, keys, "_n")
    before = rows.select(
        *keys, (F.col("_n") + 1).alias("_n"), F.col("offset").alias("_offset"), F.col("shard_no").alias("_shard")
    )
    both = rows.join(before, [*keys, "_n"], "left")
    fell = F.coalesce(F.col("offset") < F.col("_offset"), F.lit(False))
    edge = F.coalesce(F.col("shard_no") != F.col("_shard"), F.lit(True))
    return both.where(fell | edge).select(
        *keys, *order_by, "shard_no", "offset", fell.alias("offset_fell"), edge.alias("shard_edge")
    )


def slice_audit(truth: DataFrame, doms: DataFrame) -> DataFrame:
    """Per shard: rows promised by the truth table against rows present."""
    keys = ["part_no", "shard_no"]
    promised = truth.groupBy(*keys).agg(F.sum("N_doms").alias("promised"), F.max("offset").alias("last_offset"))
    present = doms.groupBy(*keys).agg(F.count(F.lit(1)).alias("present"))
    return promised.join(present, keys, "left").select(
        *keys, "promised", "last_offset", F.coalesce("present", F.lit(0)).cast("long").alias("present"),
        ((F.col("promised") == F.coalesce("present", F.lit(0))) & (F.col("promised") == F.col("last_offset"))).alias("consistent"),
    )


def synopsis(rows: DataFrame, row_id: str, dataset: int | None = None) -> DataFrame:
    """First and last row of each event in each file; `row_id` counts rows of a file from 1."""
    event = F.col("event_no").cast("long") if dataset is None else shifted_event_no(F.lit(dataset), F.col("event_no"))
    return (
        rows.groupBy(event.alias("event_no"), "file_name")
        .agg(F.min(row_id).cast("long").alias("start_offset"), F.max(row_id).cast("long").alias("end_offset"))
    )


def file_rows(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet rows with the name and path of their file and their place in it, from 1."""
    return spark.read.parquet(*paths).select(
        "*", file_name().alias("file_name"), F.col("_metadata.file_path").alias("file_path"), (F.col("_metadata.row_index") + 1).alias("row_id")
    )


def without_synopsis(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows of files whose synopsis does not yet cover all their events."""
    have = existing.groupBy("file_name").agg(F.count(F.lit(1)).alias("have"))
    need = rows.groupBy("file_name").agg(F.count_distinct("event_no").alias("need"))
    open_files = need.join(have, "file_name", "left").where(F.coalesce("have", F.lit(0)) < F.col("need"))
    return rows.join(open_files.select("file_name"), "file_name", "left_semi")


def missing_runs(events: DataFrame, first: int, last: int) -> DataFrame:
    """Run numbers of a range without any event."""
    runs = events.sparkSession.range(first, last + 1).withColumnRenamed("id", "RunID")
    return runs.join(events.select(F.col("RunID").cast("long").alias("RunID")).distinct(), "RunID", "left_anti")


def negative_charges(df: DataFrame, column: str, marker: float | None = -1.0) -> DataFrame:
    """Rows with a negative value that is not the marker."""
    negative = F.col(column) < 0
    return df.where(negative if marker is None else negative & (F.col(column) != marker))


def inconsistent_values(df: DataFrame, by: str, column: str) -> DataFrame:
    """Groups in which a column that should be constant varies."""
    return df.groupBy(by).agg(F.count_distinct(column).alias("n_values")).where(F.col("n_values") > 1)
