"""Cleaned readings, daily figures and quality records: partitioned files and their readers."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import schema
from wattline.session import drop_dir
from wattline.sources.paths import folder_name, folders, gathered, load_or_empty


# Tasks for each core that write small files.
_TASKS_PER_CORE = 4
# Size that a file of readings should have.
FILE_BYTES = 128 * 1024 * 1024


def write_silver(
    df: DataFrame, base: str, max_records_per_file: int | None = None, append: bool = False
) -> None:
    """Write readings by date and site; the partitions that occur in `df` are replaced, no others.

    `append` adds files to them instead.

    A site's day becomes one file, or several written by several tasks when it is large.
    """
    (
        gathered(df.select(*schema.names(schema.SILVER)), *schema.SITE_DAY)
        .write.mode("append" if append else "overwrite")
        .options(**_writer_options(max_records_per_file))
        .partitionBy(*schema.SITE_DAY)
        .parquet(base)
    )


def write_gold(df: DataFrame, base: str) -> None:
    """Write daily figures by date and site.

    Each partition is one row, so the cost is the number of files and not of bytes. Dealing the rows
    out to `small_file_tasks` keeps adaptive execution from merging the few bytes into one task
    that writes all files one after the other.
    """
    tasks = small_file_tasks(df.sparkSession)
    (
        df.select(*schema.names(schema.GOLD))
        .repartition(tasks)
        .write.mode("overwrite")
        .options(**_writer_options(None))
        .partitionBy(*schema.SITE_DAY)
        .parquet(base)
    )


def small_file_tasks(spark: SparkSession) -> int:
    """Number of tasks for a write of many small files: enough for all cores, and not more than a shuffle has."""
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(configured, _TASKS_PER_CORE * max(1, spark.sparkContext.defaultParallelism))


def write_states(df: DataFrame, base: str) -> None:
    """Write the states behind the figures by date; the dates that occur in `df` are replaced whole.

    One file per date; dates are dealt out to tasks as in `write_gold`.
    """
    tasks = small_file_tasks(df.sparkSession)
    (
        df.select(*schema.names(schema.STATES))
        .repartition(tasks, "event_date")
        .write.mode("overwrite")
        .options(**_writer_options(None))
        .partitionBy("event_date")
        .parquet(base)
    )


def read_states(spark: SparkSession, base: str, dates: Iterable[str]) -> DataFrame:
    return read_dates(spark, base, schema.STATES, dates)


def dates_with_states(spark: SparkSession, base: str, dates: Iterable[str]) -> list[str]:
    """Those of the dates whose states are stored, by their folders."""
    return [day for day in dates if folders(spark, f"{base}/event_date={date.fromisoformat(day).isoformat()}")]


def scattered_folders(spark: SparkSession, base: str, dates: Iterable[str], file_bytes: int = FILE_BYTES) -> list[str]:
    """Site-days of the dates with several files of less than half of `file_bytes` on average.

    Files are listed by the tasks, not opened; only the folders found come to the driver.
    """
    wanted = ",".join(sorted({date.fromisoformat(d).isoformat() for d in dates}))
    files = load_or_empty(
        spark,
        "path string, length long",
        lambda: spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(f"{base}/event_date={{{wanted}}}")
        .select("path", "length"),
    )
    folder = F.regexp_replace("path", "/[^/]*$", "").alias("folder")
    found = files.groupBy(folder).agg(F.count(F.lit(1)).alias("files"), F.avg("length").alias("mean"))
    return sorted(r.folder for r in found.where((F.col("files") > 1) & (F.col("mean") < file_bytes / 2)).collect())


def drop_other_sites(
    spark: SparkSession, base: str, sites: dict[str, set[str | None]]
) -> None:
    """Remove the partitions of each given date whose site is not among the date's sites."""
    for day, names in sites.items():
        own = {folder_name(spark, "site_id", name) for name in names}
        for folder in folders(spark, f"{base}/event_date={date.fromisoformat(day).isoformat()}/site_id=*"):
            if folder.rsplit("/", 1)[1] not in own:
                drop_dir(spark, folder)


def drop_quality(spark: SparkSession, base: str, dates: Iterable[str]) -> None:
    """Withdraw the records of some days."""
    for day in dates:
        drop_dir(spark, f"{base}/quality_date={date.fromisoformat(day).isoformat()}")


def write_quality(df: DataFrame, base: str) -> None:
    """Write one JSON record per day into `<base>/quality_date=<day>/`; a day's record is replaced."""
    (
        df.select(*schema.names(schema.QUALITY), F.col("process_date").alias("quality_date"))
        .coalesce(1)
        .write.mode("overwrite")
        .options(**_writer_options(None))
        .partitionBy("quality_date")
        .json(base)
    )


def read_silver(spark: SparkSession, base: str, dates: Iterable[str] | None = None) -> DataFrame:
    """Cleaned readings, of all dates or of some.

    The declared schema keeps a site such as `01` a text; inference would make it a number.
    """
    return read_dates(spark, base, schema.SILVER, dates)


def view_silver(spark: SparkSession, base: str, name: str = "silver_telemetry") -> None:
    """Make the cleaned readings a view for SQL; a predicate on `event_date` prunes partitions."""
    read_silver(spark, base).createOrReplaceTempView(name)


def silver_table(spark: SparkSession, base: str, name: str = "silver_telemetry") -> None:
    """Make the cleaned readings an external table of the session's catalog, or bring it up to date.

    Its partitions are those that lie below `base` now, so a predicate on `event_date` is answered
    from the catalog, without listing the other dates. To be called again after a run. The files are not
    the table's: dropping it leaves them. A table of that name that lies elsewhere is an error.
    """
    columns = ", ".join(schema.SILVER.split(", "))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(schema.SITE_DAY)}) LOCATION '{base}'"
    )
    located = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    if not _same_place(spark, located, base):
        raise ValueError(f"{name} lies at {located}")
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def _same_place(spark: SparkSession, one: str, other: str) -> bool:
    def whole(path):
        path = spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()

    return whole(one) == whole(other)


def read_gold(spark: SparkSession, base: str, dates: Iterable[str] | None = None) -> DataFrame:
    """Daily figures, of all dates or of some."""
    return read_dates(spark, base, schema.GOLD, dates)


def read_dates(
    spark: SparkSession, base: str, ddl: str, dates: Iterable[str] | None, key: str = "event_date"
) -> DataFrame:
    """Parquet rows of the given dates. Only their folders are listed, not those of every date."""
    reader = spark.read.schema(ddl).option("basePath", base)
    if dates is None:
        return load_or_empty(spark, ddl, lambda: reader.parquet(base))
    wanted = sorted({date.fromisoformat(d) for d in dates})
    if not wanted:
        return spark.createDataFrame([], ddl)
    path = f"{base}/{key}={{{','.join(d.isoformat() for d in wanted)}}}"
    return load_or_empty(spark, ddl, lambda: reader.parquet(path)).where(F.col(key).isin(wanted))


def read_quality(spark: SparkSession, base: str) -> DataFrame:
    """All quality records."""
    return (
        spark.read.schema(f"{schema.QUALITY}, quality_date string").json(base).drop("quality_date")
    )


def _writer_options(max_records_per_file: int | None) -> dict[str, str]:
    options = {"partitionOverwriteMode": "dynamic"}
    if max_records_per_file:
        options["maxRecordsPerFile"] = str(max_records_per_file)
    return options
