"""Reading from a path that may not exist yet; laying rows out for a partitioned write."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load_or_empty(spark: SparkSession, ddl: str, load: Callable[[], DataFrame]) -> DataFrame:
    """What `load` reads, or an empty frame of the schema when nothing lies at its path."""
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of the folders that match a pattern; none when nothing does."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in found or [] if status.isDirectory()]


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def folder_name(spark: SparkSession, key: str, value: str | None) -> str:
    """The folder that a partitioned write makes for a value."""
    if value is None or value == "":
        return f"{key}=__HIVE_DEFAULT_PARTITION__"
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return f"{key}={utils.escapePathName(value)}"


def gathered(df: DataFrame, *columns: str) -> DataFrame:
    """Bring rows of equal `columns` together, so that a write partitioned by them makes few files.

    The rebalance hint lets adaptive execution split what exceeds the advisory partition size over
    several tasks, so one hot value does not become one task. Without adaptive execution the hint
    does nothing, and a plain hash repartition takes its place.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return df.hint("rebalance", *map(F.col, columns))
    return df.repartition(*columns)
