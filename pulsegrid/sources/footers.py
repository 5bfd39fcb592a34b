"""Parquet footers as a Spark data source: what a file holds, without reading a column.

    footers(spark, path, key="event_no")

One row per file: rows, row groups, columns with their types, null counts, and the least and greatest value of one
whole-number column, all from the statistics that writers leave in the footer.  Files are opened by the tasks, through
the file system their address names.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FILES_PER_TASK = 64
_SCHEMA = pa.schema(
    [
        ("file_path", pa.string()), ("n_rows", pa.int64()), ("n_row_groups", pa.int32()), ("n_columns", pa.int32()),
        ("columns", pa.map_(pa.string(), pa.string())), ("nulls", pa.map_(pa.string(), pa.int64())),
        ("first_key", pa.int64()), ("last_key", pa.int64()),
    ]
)
_SPARK = (
    "file_path string, n_rows bigint, n_row_groups int, n_columns int, columns map<string,string>, nulls map<string,bigint>, "
    "first_key bigint, last_key bigint"
)


def read_footer(address: str, key: str | None = None) -> tuple:
    """A row of the source; null counts and ends are null where any row group lacks its statistics."""
    parts = urlsplit(address)
    system, path = (pafs.LocalFileSystem(), unquote(parts.path)) if parts.scheme in ("", "file") else pafs.FileSystem.from_uri(address)
    with system.open_input_file(path) as file:
        meta = pq.read_metadata(file)
    nulls: dict[str, int | None] = {}
    low = high = None
    known = meta.num_row_groups > 0
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        for c in range(group.num_columns):
            column = group.column(c)
            name, stats = column.path_in_schema, column.statistics
            missing = stats.null_count if stats is not None and stats.has_null_count else None
            before = nulls.get(name, 0)
            nulls[name] = None if missing is None or before is None else before + missing
            if name == key:
                if stats is not None and stats.has_min_max:
                    low, high = min(x for x in (low, stats.min) if x is not None), max(x for x in (high, stats.max) if x is not None)
                elif missing is None or missing < group.num_rows:
                    known = False
    kinds = [(f.name, str(f.type)) for f in meta.schema.to_arrow_schema()]
    ends = (low, high) if known else (None, None)
    return address, meta.num_rows, meta.num_row_groups, len(kinds), kinds, list(nulls.items()), *ends


class _Files(InputPartition):
    def __init__(self, files: Sequence[str]):
        self.files = list(files)


class FooterReader(DataSourceReader):
    def __init__(self, options):
        self.files, self.key = json.loads(options["files"]), options.get("key")
        self.size = int(options.get("filespertask", FILES_PER_TASK))

    def partitions(self) -> list[InputPartition]:
        return [_Files(self.files[i : i + self.size]) for i in range(0, len(self.files), self.size)] or [_Files([])]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        rows = [read_footer(name, self.key) for name in partition.files]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


class ParquetFooters(DataSource):
    @classmethod
    def name(cls) -> str:
        return "parquet_footers"

    def schema(self) -> str:
        return _SPARK

    def reader(self, schema) -> FooterReader:
        return FooterReader({k.lower(): v for k, v in self.options.items()})


def footers(spark: SparkSession, path: str, key: str | None = None, files_per_task: int = FILES_PER_TASK) -> DataFrame:
    """The footers of all Parquet files at `path`; Spark lists them, tasks open them."""
    spark.dataSource.register(ParquetFooters)
    reader = spark.read.format("parquet_footers").option("files", json.dumps(sorted(spark.read.parquet(path).inputFiles())))
    reader = reader.option("filesPerTask", str(files_per_task))
    return (reader.option("key", key) if key else reader).load()


def footer_audit(spark: SparkSession, path: str, key: str, expected: Sequence[str]) -> DataFrame:
    """Per file: rows, ends of `key`, columns that are missing or surplus beside `expected`, and how many have nulls."""
    names = F.map_keys("columns")
    wanted = F.array(*[F.lit(c) for c in expected])
    return footers(spark, path, key).select(
        "file_path", "n_rows", F.col("first_key").alias("first_event"), F.col("last_key").alias("last_event"), "n_columns",
        F.array_sort(F.array_except(wanted, names)).alias("missing"), F.array_sort(F.array_except(names, wanted)).alias("surplus"),
        F.size(F.map_filter("nulls", lambda _, n: F.coalesce(n > 0, F.lit(True)))).alias("n_with_nulls"),
    )
