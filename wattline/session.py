"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Input bytes meant for one shuffle partition.
BYTES_PER_PARTITION = 256 * 1024 * 1024
# The most partitions that one shuffle is given: a driver keeps the place of map tasks times
# partitions blocks.
MOST_PARTITIONS = 50_000


def build_session(app_name: str = "wattline", **settings: str) -> SparkSession:
    """Session with UTC as its zone and adaptive execution on; `settings` are further Spark settings.

    The advisory size is what a task that writes readings gets. More would make larger files for a
    hot site (shuffled rows shrink to about a fifth as Parquet), but also more files for a task that
    writes small sites. The number of shuffle partitions is left to the caller, to
    `shuffle_sized_for` and to adaptive coalescing.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: `spark.checkpoint.dir` as the cluster names it.

    Only a local-mode session that names none gets a folder of its own; on a cluster a
    machine-local folder would be invisible to the other machines, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(folder)
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="wattline-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the work folder that no other run uses."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"


def drop_dir(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that this run wrote, on whatever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the work folder: later steps all see the same ones."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_UNKNOWN_BYTES = 2**62  # Spark gives a size above this to inputs that it knows nothing of


def input_bytes(df: DataFrame) -> int:
    """Size of the tables that `df` reads, as the optimizer knows it from the file listing.

    Nothing is scanned. An input of unknown size counts as nothing.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(size for size in sizes if size < _UNKNOWN_BYTES)


def passes_for(
    df: DataFrame,
    bytes_per_partition: int = BYTES_PER_PARTITION,
    most_partitions: int = MOST_PARTITIONS,
) -> int:
    """In how many parts `df`'s input has to be shuffled so that no partition is larger than meant."""
    return max(1, math.ceil(input_bytes(df) / (bytes_per_partition * most_partitions)))


@contextmanager
def shuffle_sized_for(
    df: DataFrame,
    bytes_per_partition: int = BYTES_PER_PARTITION,
    most_partitions: int = MOST_PARTITIONS,
    passes: int = 1,
) -> Iterator[int]:
    """Raise the number of shuffle partitions to suit the size of `df`'s input, then restore it.

    Adaptive execution merges small partitions of an aggregation but never splits large ones, so
    the number must be high enough at the start. It follows the size up to `most_partitions`; beyond
    that partitions grow and spill, unless the work is done in `passes_for` parts, one after the
    other, which is what `passes` says. Plans are made when they run, so only what runs inside the
    block is sized by it.
    """
    spark, setting = df.sparkSession, "spark.sql.shuffle.partitions"
    configured = spark.conf.get(setting)
    needed = math.ceil(input_bytes(df) / passes / bytes_per_partition)
    wanted = max(int(configured), min(needed, most_partitions))
    spark.conf.set(setting, wanted)
    try:
        yield wanted
    finally:
        spark.conf.set(setting, configured)
