"""Session helpers: counted size checks and pinned (written) frames."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# A frame of at most this many rows, counted, may be sorted by one task.
ONE_TASK_ROWS = 1_000_000
# Tables of a few key columns are broadcast up to this many rows (some megabytes).
BROADCAST_ROWS = 100_000
# A task that shuffles by key gets about this much of the input files (some hundred thousand rows).
TASK_BYTES = 8 << 20
# Files whose sizes are asked for; of more, evenly chosen ones stand for all.
SIZED_FILES = 200


def build_session(cores: str = "8", app: str = "pulsegrid", **conf: str) -> SparkSession:
    """Local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at the folder named by the cluster.

    Only a local session, where driver and executors share one disk, may fall
    back to a temporary folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="pulsegrid-checkpoint-")
    sc.setCheckpointDir(folder)


_PINNED: list[str] = []


def pin(df: DataFrame) -> DataFrame:
    """Write `df` once as Parquet below the checkpoint folder and read on from there.

    Values that depend on the physical partitioning stay fixed afterwards, also
    when an executor is lost and tasks are run again, and every later use reads
    only the columns it needs.
    """
    spark = df.sparkSession
    use_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/pinned-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _PINNED.append(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._is_pinned = True
    return written


@contextmanager
def released_pins(spark: SparkSession) -> Iterator[None]:
    """Delete what is pinned inside the block when it ends; pins made before stay, also those that other frames read.

    For jobs that have written their results: frames built on these pins end with them.
    """
    mine: list[str] = []
    before = set(_PINNED)
    try:
        yield
    finally:
        mine = [p for p in _PINNED if p not in before]
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for name in mine:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
            _PINNED.remove(name)


def settled(df: DataFrame, limit: int | None = None) -> tuple[DataFrame, bool]:
    """(the frame, whether one task may hold all of it).

    The frame is written first, unless it was, and counted from the footers of what is written; so its plan runs once for
    the count and the result together.  With a limit of 0 nothing is written or counted.
    """
    if limit == 0:
        return df, False
    if not getattr(df, "_is_pinned", False):
        df = pin(df)
    return df, df.count() <= (ONE_TASK_ROWS if limit is None else limit)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame) -> int:
    """Tasks for a shuffle of `df` by key: their number grows with the files that the frame reads, so the share of one stays.

    At least as many as the session's; frames of the same files get the same number, so Spark leaves repeated shuffles out.
    """
    spark = df.sparkSession
    names = sorted(df.inputFiles())
    some = names[:: -(-len(names) // SIZED_FILES) or 1]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name)) for name in some]
    held = sum(path.getFileSystem(conf).getFileStatus(path).getLen() for path in paths)
    return max(shuffle_width(spark), held * len(names) // (TASK_BYTES * max(1, len(some))))
