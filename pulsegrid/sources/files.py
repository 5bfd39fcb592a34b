"""CSV listings, job logs, receipts and the folder layout of datasets."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.schema import GEOMETRY

# Run numbers left out when listings are split.
SKIPPED_RUNS = (2201000020, 2201000107, 2201000731, 2201000858, 2201000904, 2201000963)
# End of fixed values.


def read_geometry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=GEOMETRY)


def read_clean_ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema="RunID bigint, EventID int")


def listing_fields(lines: DataFrame, least: int, column: str = "value") -> DataFrame:
    """Comma-separated fields of text lines; lines with fewer than `least` are dropped."""
    fields = F.split(F.col(column), ",")
    return lines.select(F.col(column).alias("line"), fields.alias("fields")).where(F.size("fields") >= least)


def reduced_listing(lines: DataFrame, column: str = "value") -> DataFrame:
    """(RunID, EventID) of each well-formed line, each pair once, compared as text."""
    rows = listing_fields(lines, 4, column).where(~F.get("fields", F.lit(0)).rlike("[A-Za-z]"))
    return rows.select(
        F.get("fields", F.lit(0)).alias("RunID"), F.get("fields", F.lit(2)).alias("EventID")
    ).distinct()


def run_bucket(run: Column) -> Column:
    """Start of the block of one hundred runs, within a thousand."""
    return F.floor(run % 1000 / 100) * 100


def bucket_file(bucket: Column) -> Column:
    return F.format_string("clean_event_ids_%07d-%07d.csv", bucket.cast("long"), (bucket + 99).cast("long"))


def bucketed_listing(rows: DataFrame) -> DataFrame:
    """Listing rows with the block and file they belong to; known-bad runs are left out."""
    run = F.col("RunID").cast("long")
    kept = rows.where(~run.isin(*SKIPPED_RUNS)).withColumn("bucket", run_bucket(run).cast("long"))
    return kept.withColumn("file_name", bucket_file(F.col("bucket")))


def write_bucketed_listing(rows: DataFrame, path: str) -> None:
    """One folder of CSV files per block; large blocks are written by many tasks."""
    bucketed_listing(rows).drop("bucket").write.partitionBy("file_name").mode("overwrite").csv(path, header=True)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def is_number(column: Column) -> Column:
    return column.rlike(r"^\d+$")


def is_stripped(column: Column) -> Column:
    return column == F.trim(column)


# The wording of the job logs.
_CLOCK = r"Elapsed time:\s*(\d+)h\s*(\d+)m\s*(\d+)s"
_SOURCE_SIZE = r"Source part file size:\s*([\d.]+)\s*(GB|MB)"
_MEMORY = r"Memory:\s*([\d.]+)\s*GB total,\s*([\d.]+)\s*GB available"
_CELL = r"^\s*\|\s*(.*?)\s*\|\s*(.*?)\s*\|"
_BORDER = r"^\s*\+.*\+\s*$"
# End of fixed values.


def _size_kb(text: Column) -> Column:
    value = F.regexp_extract(text, r"([\d.]+)\s*(?:KB|MB|GB)", 1).try_cast("double")
    unit = F.regexp_extract(text, r"[\d.]+\s*(KB|MB|GB)", 1)
    return F.when(unit == "GB", value * 1024 * 1024).when(unit == "MB", value * 1024).otherwise(value)


def _line_values(lines: DataFrame, log: str, column: str, order: Sequence[str]) -> DataFrame:
    """What each line says, as numbers: patterns run once, only on lines with their fixed words, and before lines move."""
    text = F.col(column)

    def found(words: str, pattern: str, group: int) -> Column:
        return F.when(text.contains(words), F.regexp_extract(text, pattern, group))

    def number(words: str, pattern: str, group: int = 1) -> Column:
        return found(words, pattern, group).try_cast("double")

    clock = [number("Elapsed time:", _CLOCK, i) for i in (1, 2, 3)]
    in_mb = F.when(found("Source part file size:", _SOURCE_SIZE, 2) == "GB", 1024.0).otherwise(1.0)
    cells = lines.select(
        log, *order,
        F.coalesce(text.contains("+") & text.rlike(_BORDER), F.lit(False)).alias("_border"),
        (number("Source part file size:", _SOURCE_SIZE) * in_mb).alias("_source_mb"),
        F.when(~text.contains("shard"), clock[0] * 3600 + clock[1] * 60 + clock[2]).alias("_seconds"),
        number("Memory:", _MEMORY, 1).alias("_total"), number("Memory:", _MEMORY, 2).alias("_available"),
        found("|", _CELL, 1).alias("_title"), found("|", _CELL, 2).alias("_value"),
    )
    title = F.col("_title")
    sized = F.lit(None).cast("string")
    for prefix, suffix in (("Total ", " Size"), ("Avg ", " Shard Size"), ("Truth ", " Size")):
        sized = F.when(title.startswith(prefix) & title.endswith(suffix), prefix.strip()).otherwise(sized)
    kept = cells.withColumn("_sized", sized)
    return kept.withColumn("_kb", F.when(F.col("_sized").isNotNull(), _size_kb(F.col("_value")))).drop("_title", "_value")


def parse_log_lines(lines: DataFrame, log: str = "log", column: str = "value", order: Sequence[str] = ("line",)) -> DataFrame:
    """One row per job log: sizes, memory, elapsed time.

    `order` puts the lines of a log in order.  Of repeated lines the last counts.  Table cells count between the second
    and the third border of a log, that is, in the body of its first table.  Lines of one log meet in one task.
    """
    by_line = Window.partitionBy(log).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = _line_values(lines, log, column, order).withColumn("_borders", F.count_if("_border").over(by_line)).withColumn("_at", F.struct(*order))
    in_table = (F.col("_borders") == 2) & ~F.col("_border")

    def last(name: str, where: Column | None = None) -> Column:
        known = F.col(name) if where is None else F.when(where, F.col(name))
        return F.max_by(known, F.when(known.isNotNull(), F.col("_at")))

    def sized(kind: str) -> Column:
        return last("_kb", in_table & (F.col("_sized") == kind))

    return placed.groupBy(log).agg(
        (last("_source_mb") / 1024).alias("source_file_size_GB"),
        (sized("Total") / (1024 * 1024)).alias("total_shard_size_GB"),
        (sized("Avg") / 1024).alias("avg_shard_size_MB"),
        (sized("Truth") / 1024).alias("truth_file_size_MB"),
        last("_seconds").cast("long").alias("elapsed_time_sec"),
        last("_total").alias("memory_total_GB"),
        last("_available").alias("memory_available_GB"),
    )


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Job logs below a folder; the folder of a log names its dataset."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select(
        "value", F.col("_metadata.file_path").alias("log"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")
    )  # the number rises along a block of a file; blocks come in any order
    table = parse_log_lines(lines, order=("block", "line"))
    return table.withColumn("subdir_no", F.regexp_extract("log", r"/(\d+)/[^/]*$", 1).try_cast("int"))


def latex_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Table rows in LaTeX, in order of the first two columns; a repeated first cell is blanked.

    Meant for report tables of a few rows.
    """
    line = Window.orderBy(columns[0], columns[1])
    first = F.when(F.lag(columns[0]).over(line) == F.col(columns[0]), "").otherwise(F.col(columns[0]))
    cells = [
        F.format_string("%.2f", F.col(c)) if df.schema[c].dataType.simpleString() == "double" else F.col(c).cast("string")
        for c in columns[1:]
    ]
    return df.select(
        F.row_number().over(line).alias("place"),
        F.concat(F.lit("    "), F.concat_ws(" & ", first, *cells), F.lit(" \\\\")).alias("row"),
    )


def size_report(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Number, total and average size of the files below a folder; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("length")
    )
    return files.agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("total_bytes"), F.avg("length").alias("average_bytes")
    )


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _write_parts(
    rows: DataFrame, path: str, keys: Sequence[str], parts: Sequence[int] | None, check: Callable[[DataFrame], str | None] | None, kind: str = "parquet"
) -> None:
    """Write a table partitioned by `keys`, the first of which is part_no.

    Without `parts` the table is replaced.  With them only these parts are: the rows are written beside the table and
    read back for `check`, which names a fault or returns None; then the folders of the parts are exchanged, and all
    other files stay untouched.  A part that came out empty goes.  Parts are exchanged one after another, so a reader
    meanwhile may see some old and some new ones.
    """
    writer = rows.write.mode("overwrite").partitionBy(*keys).format(kind)
    if kind == "csv":
        writer = writer.option("header", "true")
    if parts is None:
        writer.save(path)
        return
    spark = rows.sparkSession
    staged = f"{path}/.staged-{uuid.uuid4().hex}"
    system, place = _file_system(spark, path)
    writer.save(staged)
    try:
        fault = check(spark.read.schema(rows.schema).format(kind).load(staged)) if check else None
        if fault:
            raise ValueError(f"{path}: {fault}; nothing was replaced")
        for part in parts:
            fresh, old = place(f"{staged}/part_no={part}"), place(f"{path}/part_no={part}")
            if system.exists(old):
                system.delete(old, True)
            if system.exists(fresh):
                system.rename(fresh, old)
    finally:
        system.delete(place(staged), True)


def write_summary(
    doms: DataFrame, path: str, source: str, subdir: str, parts: Sequence[int] | None = None, check: Callable[[DataFrame], str | None] | None = None
) -> None:
    """Sensor rows as <path>/<source>/<subdir>/doms/part_no=../shard_no=.., events in order; with `parts` only these are replaced."""
    keys = ["part_no", "shard_no"]
    order = [c for c in ("event_no", "string", "dom_number") if c in doms.columns]
    rows = doms.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)  # a large shard may span several tasks
    _write_parts(rows, f"{path}/{source}/{subdir}/doms", keys, parts, check)


def write_truth(
    truth: DataFrame, path: str, source: str, subdir: str, parts: Sequence[int] | None = None, check: Callable[[DataFrame], str | None] | None = None
) -> None:
    """Truth rows as <path>/<source>/<subdir>/truth/part_no=.., sorted and split by event; with `parts` only these are replaced."""
    rows = truth.repartitionByRange("part_no", "event_no").sortWithinPartitions("part_no", "event_no")
    _write_parts(rows, f"{path}/{source}/{subdir}/truth", ["part_no"], parts, check)


def write_numbers(numbers: DataFrame, path: str, source: str, subdir: str, parts: Sequence[int] | None = None) -> None:
    """Receipt of old and new event numbers as CSV, <path>/<source>/<subdir>/numbers/part_no=.., in order of the new ones."""
    rows = numbers.repartitionByRange("part_no", "event_no").sortWithinPartitions("part_no", "event_no")
    _write_parts(rows, f"{path}/{source}/{subdir}/numbers", ["part_no"], parts, None, "csv")


def read_dataset(spark: SparkSession, path: str, source: str, subdir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{source}/{subdir}/{table}")


def write_receipt(receipt: DataFrame, path: str, parts: Sequence[int] | None = None) -> None:
    """Receipts as JSON; with `parts` the lines of other parts stay."""
    if parts is not None:
        spark = receipt.sparkSession
        system, place = _file_system(spark, path)
        if system.exists(place(path)):
            others = spark.read.schema(receipt.schema).json(path).where(~F.col("part_no").isin(*parts))
            # one line per part, held here as the folder is replaced
            receipt = receipt.unionByName(spark.createDataFrame(others.collect(), receipt.schema))
        receipt = receipt.coalesce(1)
    receipt.write.mode("overwrite").json(path)
