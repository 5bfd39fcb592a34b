"""SQLite files as a Spark data source.

    spark.dataSource.register(SqliteSource)
    spark.read.format("sqlite").option("path", folder).option("table", "SRTInIcePulses").load()

Each file is split into ranges of row ids by its size, so one large file is read by
many tasks.  The options `columns` (names, comma-separated) and `where` (a condition
in SQL) are answered by the file.  They belong to one load(): filters that Spark
itself pushes into a Python source stay in force for every other use of the same
loaded frame (seen with 4.1.2), so this source leaves filters to Spark.
Wanted events are looked up through the files' own indexes by `read_events`, which takes
them as a frame; every call has its own.
Files must lie on a folder that all executors can open.
"""

from __future__ import annotations

import glob
import os
import re
import sqlite3
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql import functions as F

BYTES_PER_TASK = 256 * 1024 * 1024
FETCH_ROWS = 50_000


def spark_type(declared: str) -> str:
    """Type of a column by the affinity rules of SQLite."""
    declared = declared.upper()
    if "INT" in declared:
        return "bigint"
    return "string" if any(word in declared for word in ("CHAR", "CLOB", "TEXT")) else "double"


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def source_files(path: str, parts: str | None = None) -> list[str]:
    """Files of a folder or pattern; `parts` (numbers, comma-separated) keeps those whose name ends in one of them."""
    found = sorted(glob.glob(os.path.join(path, "*.db"))) if os.path.isdir(path) else sorted(glob.glob(path))
    if not parts:
        return found
    wanted = {int(p) for p in parts.split(",")}
    return [f for f in found if part_of(os.path.basename(f)) in wanted]


# The last field of a file name between `_` and the ending.
_PART = r"(?:^|_)(\d+)(?:\.[^_]*)?$"


def part_of(name: str) -> int | None:
    found = re.search(_PART, name)
    return int(found[1]) if found else None


def table_names(path: str) -> list[str]:
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as con:
        return [r[0] for r in con.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name")]


def resolve_table(path: str, candidates: Sequence[str]) -> str:
    """The first candidate that exists in the first file, e.g. truth or Truth."""
    present = table_names(source_files(path)[0])
    for name in candidates:
        if name in present:
            return name
    raise ValueError(f"none of {list(candidates)} in {path}: {present}")


class _Share(InputPartition):
    """The `index`th of `shares` equal ranges of a file's row ids."""

    def __init__(self, file: str, index: int, shares: int):
        self.file, self.index, self.shares = file, index, shares


class SqliteReader(DataSourceReader):
    def __init__(self, schema, options):
        self.schema, self.options = schema, options

    def partitions(self) -> list[InputPartition]:
        # Files are only listed here; tasks open them.
        size = int(self.options.get("bytespertask", BYTES_PER_TASK))
        out = []
        for file in source_files(self.options["path"], self.options.get("parts")):
            shares = max(1, -(-os.path.getsize(file) // size))
            out += [_Share(file, i, shares) for i in range(shares)]
        return out or [_Share("", 0, 1)]

    def read(self, partition: _Share) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        fields = pa.schema([pa.field(f.name, _arrow(f.dataType.simpleString())) for f in self.schema.fields])
        special = {"file_name": "?", "row_id": "rowid"}
        columns = [special.get(n, quoted(n)) for n in fields.names]
        lead = [os.path.basename(partition.file)] if "file_name" in fields.names else []
        chosen = f" AND ({self.options['where']})" if self.options.get("where") else ""
        sql = f"SELECT {', '.join(columns)} FROM {quoted(self.options['table'])} WHERE rowid BETWEEN ? AND ?{chosen} ORDER BY rowid"
        with sqlite3.connect(f"file:{partition.file}?mode=ro", uri=True) as con:
            # Both ends come from the b-tree, not from a scan.
            table = quoted(self.options["table"])
            low = con.execute(f"SELECT min(rowid) FROM {table}").fetchone()[0]
            if low is None:
                return
            span = con.execute(f"SELECT max(rowid) FROM {table}").fetchone()[0] - low + 1
            first, after = (low + span * i // partition.shares for i in (partition.index, partition.index + 1))
            cursor = con.execute(sql, [*lead, first, after - 1])
            while rows := cursor.fetchmany(FETCH_ROWS):
                cells = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(cells, fields)], schema=fields
                )


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(), "string": pa.string()}[kind]


class _Written(WriterCommitMessage):
    def __init__(self, staged: str | None):
        self.staged = staged


class SqliteWriter(DataSourceArrowWriter):
    """One database file per task; files appear under their names on commit."""

    def __init__(self, schema, options, overwrite):
        self.schema, self.options, self.overwrite = schema, options, overwrite

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        import uuid

        folder, table = self.options["path"], quoted(self.options["table"])
        os.makedirs(folder, exist_ok=True)
        staged = os.path.join(folder, f".{uuid.uuid4().hex}.staged")
        names = [f.name for f in self.schema.fields]
        kinds = {"bigint": "INTEGER", "int": "INTEGER", "double": "REAL", "float": "REAL"}
        declared = ", ".join(f"{quoted(f.name)} {kinds.get(f.dataType.simpleString(), 'TEXT')}" for f in self.schema.fields)
        con, count = sqlite3.connect(staged), 0
        try:
            con.execute(f"CREATE TABLE {table} ({declared})")
            insert = f"INSERT INTO {table} VALUES ({','.join('?' * len(names))})"
            for batch in batches:
                con.executemany(insert, zip(*[column.to_pylist() for column in batch.columns]))
                count += batch.num_rows
            if "event_no" in names:
                con.execute(f"CREATE INDEX {quoted('by_event_' + self.options['table'])} ON {table} (event_no)")
            con.commit()
        finally:
            con.close()
        if count == 0:
            os.remove(staged)
            return _Written(None)
        return _Written(staged)

    def commit(self, messages) -> None:
        """New files are numbered on from the highest there is; none is replaced.  Overwriting takes this table, and no other, out of the old ones."""
        folder, table = self.options["path"], self.options["table"]
        numbers = [part_of(os.path.basename(f)) for f in source_files(folder)]
        start = max([n for n in numbers if n is not None], default=0) + 1
        if self.overwrite:
            for old in source_files(folder):
                present = table_names(old)
                if present == [table]:
                    os.remove(old)
                elif table in present:
                    with sqlite3.connect(old) as con:
                        con.execute(f"DROP TABLE {quoted(table)}")
        for number, message in enumerate([m for m in messages if m and m.staged], start):
            # link() fails if the name is taken, unlike replace()
            os.link(message.staged, os.path.join(folder, f"merged_part_{number}.db"))
            os.remove(message.staged)

    def abort(self, messages) -> None:
        for message in messages:
            if message and message.staged and os.path.exists(message.staged):
                os.remove(message.staged)


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> str:
        table = quoted(self.options["table"])
        files = source_files(self.options["path"], self.options.get("parts"))
        if not files:
            raise ValueError(f"no files in {self.options['path']}, parts {self.options.get('parts') or 'all'}")
        with sqlite3.connect(f"file:{files[0]}?mode=ro", uri=True) as con:
            info = con.execute(f"PRAGMA table_info({table})").fetchall()
        kinds = {name: spark_type(kind) for _, name, kind, *_ in info}
        wanted = [c.strip() for c in self.options["columns"].split(",")] if self.options.get("columns") else list(kinds)
        columns = [f"`{name}` {kinds[name]}" for name in wanted]
        if str(self.options.get("rowIds", "false")).lower() == "true":
            columns += ["file_name string", "row_id bigint"]
        return ", ".join(columns)

    def reader(self, schema) -> DataSourceReader:
        return SqliteReader(schema, {k.lower(): v for k, v in self.options.items()})

    def writer(self, schema, overwrite: bool) -> SqliteWriter:
        return SqliteWriter(schema, {k.lower(): v for k, v in self.options.items()}, overwrite)


def read_sqlite(spark, path: str, table: str, row_ids: bool = False, **options) -> DataFrame:
    """Rows of a table in all files of a folder; if row ids are kept, `part_no` is the number that ends the file name, and a name without one is an error."""
    spark.dataSource.register(SqliteSource)
    reader = spark.read.format("sqlite").option("path", path).option("table", table).option("rowIds", str(row_ids).lower())
    for key, value in options.items():
        reader = reader.option(key, str(value))
    df = reader.load()
    if row_ids:
        number = F.regexp_extract("file_name", _PART, 1)
        unknown = F.raise_error(F.concat(F.lit("no part number in the file name "), F.col("file_name")))
        df = df.withColumn("part_no", F.when(number != "", number.cast("int")).otherwise(unknown.cast("int")))
    return df


EVENTS_PER_LOOKUP = 500


def read_events(spark, path: str, table: str, wanted: DataFrame, key: str = "event_no") -> DataFrame:
    """Rows of the events in `wanted` (part_no, `key`), looked up by `key` in the files of these parts.

    The wanted ids are dealt to tasks in chunks of one file; a task asks the file for its chunk, which an index on `key`
    answers without a scan.  Columns are those of the table, part_no and row_id; ids that are not there give no rows.
    """
    spark.dataSource.register(SqliteSource)
    found = source_files(path)
    fields = spark.read.format("sqlite").option("path", path).option("table", table).load().schema.fields
    names = [f.name for f in fields]
    files = spark.createDataFrame([(part_of(os.path.basename(f)), f) for f in found], "part_no int, _file string")
    asked = wanted.select(F.col("part_no").cast("int").alias("part_no"), F.col(key).cast("long").alias("_id")).where("_id IS NOT NULL").distinct()
    chunk = F.pmod(F.xxhash64("_id"), F.lit(1024))
    asked = asked.join(F.broadcast(files), "part_no").repartition("_file", chunk).sortWithinPartitions("_file", "_id")  # one row per file
    schema = pa.schema([*[pa.field(f.name, _arrow(f.dataType.simpleString())) for f in fields], pa.field("part_no", pa.int32()), pa.field("row_id", pa.int64())])
    columns = ", ".join([*map(quoted, names), "?", "rowid"])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_file: dict[tuple[str, int], list[int]] = {}
            for part, number, name in zip(*(batch.column(c).to_pylist() for c in ("part_no", "_id", "_file"))):
                by_file.setdefault((name, part), []).append(number)
            for (name, part), numbers in by_file.items():
                with sqlite3.connect(f"file:{name}?mode=ro", uri=True) as con:
                    for i in range(0, len(numbers), EVENTS_PER_LOOKUP):
                        some = numbers[i : i + EVENTS_PER_LOOKUP]
                        sql = f"SELECT {columns} FROM {quoted(table)} WHERE {quoted(key)} IN ({','.join('?' * len(some))})"
                        cursor = con.execute(sql, [part, *some])
                        while rows := cursor.fetchmany(FETCH_ROWS):
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
    return asked.select("part_no", "_id", "_file").mapInArrow(look_up, ", ".join([*kinds, "part_no int", "row_id bigint"]))


def write_sqlite(df: DataFrame, path: str, table: str, overwrite: bool = False) -> None:
    df.sparkSession.dataSource.register(SqliteSource)
    df.write.format("sqlite").option("path", path).option("table", table).mode("overwrite" if overwrite else "append").save()
