"""A synopsis kept up to date file by file.

The ledger lists the files that are finished, each with its length and time of change.  An update lists the folder,
leaves out what the ledger holds, and opens the other files only; a file that was written anew counts as another one.
The synopsis is written before the ledger, so after a failure in between the same files are done again, and the rows
written for them before are not read: only the rows of the ledger's last entry of a file count.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.operators.quality import file_rows, synopsis

_STATE = "file_path string, length bigint, changed timestamp, run string"


def listing(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Files below a folder with length and time of change; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select(F.col("path").alias("file_path"), "length", F.col("modificationTime").alias("changed"))


def _written(spark: SparkSession, path: str, schema: str) -> DataFrame:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    exists = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(schema).parquet(path) if exists else spark.createDataFrame([], schema)


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """The last entry of each finished file."""
    rows = _written(spark, f"{target}/ledger", _STATE)
    last = rows.groupBy("file_path").agg(F.max(F.struct("changed", "length", "run")).alias("e"))
    return last.select("file_path", "e.length", "e.changed", "e.run")


def unfinished(spark: SparkSession, path: str, target: str) -> DataFrame:
    return listing(spark, path).join(ledger(spark, target).drop("run"), ["file_path", "length", "changed"], "left_anti")


def update_synopsis(spark: SparkSession, path: str, target: str, event: str = "event_no") -> int:
    """Add the rows of new and changed files below `path` to the synopsis at `target`; returns how many files were opened."""
    open_files = [(r.file_path, r.length, r.changed) for r in unfinished(spark, path, target).collect()]  # names only
    if not open_files:
        return 0
    run = uuid.uuid4().hex
    rows = file_rows(spark, *[name for name, _, _ in open_files]).withColumnRenamed(event, "event_no")
    made = synopsis(rows.drop("file_name").withColumnRenamed("file_path", "file_name"), "row_id").withColumnRenamed("file_name", "file_path")
    made.withColumn("run", F.lit(run)).write.mode("append").parquet(f"{target}/synopsis")
    done = spark.createDataFrame([(*f, run) for f in open_files], _STATE)
    done.coalesce(1).write.mode("append").parquet(f"{target}/ledger")
    return len(open_files)


def read_synopsis(spark: SparkSession, target: str) -> DataFrame:
    """event_no, file_path, start_offset, end_offset of every finished file as it is now."""
    rows = _written(spark, f"{target}/synopsis", "event_no bigint, file_path string, start_offset bigint, end_offset bigint, run string")
    return rows.join(ledger(spark, target).select("file_path", "run"), ["file_path", "run"], "left_semi").drop("run")
