"""The daily run: raw records to cleaned readings, daily figures and quality records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import schema
from wattline.operators.cleaning import clean_readings, drop_untimed, keep_first, with_event_time
from wattline.operators.enrichment import enrich_capacity
from wattline.operators.kpis import figures, site_states
from wattline.operators.quality import day_quality
from wattline.plans.late import LATE, compact_days, finish_merges, merge_late
from wattline.session import (
    BYTES_PER_PARTITION,
    MOST_PARTITIONS,
    drop_dir,
    fresh_dir,
    input_bytes,
    passes_for,
    shuffle_sized_for,
)
from wattline.sources import lake
from wattline.sources.bronze import read_raw_days
from wattline.sources.devices import read_devices
from wattline.sources.paths import folders, gathered

__all__ = ["LATE", "LakePaths", "RunOptions", "compact_days", "dates_between", "merge_late", "run_day", "run_days"]

_RUN_KEY = ("process_date", *schema.KEY)


@dataclass(frozen=True)
class LakePaths:
    raw: str
    silver: str
    gold: str
    metrics: str
    devices: str
    late: str

    @property
    def states(self) -> str:
        """Partial sums behind the figures, to which late rows are added."""
        return f"{self.gold}_states"

    @property
    def merging(self) -> str:
        """Merges and compactions that are under way."""
        return f"{self.silver}_merging"

    @classmethod
    def below(cls, base: str, devices: str | None = None) -> LakePaths:
        return cls(
            raw=f"{base}/raw",
            silver=f"{base}/silver",
            gold=f"{base}/gold",
            metrics=f"{base}/metrics",
            devices=devices or f"{base}/reference/devices.csv",
            late=f"{base}/late",
        )


@dataclass(frozen=True)
class RunOptions:
    """Choices where the data can go wrong.

    off_date: rows whose own date is not the day of their folder. `late` keeps them apart until
        `merge_late`; `overwrite` writes them under their own date, replacing what lies there, so
        several days are then run one after the other, in order.
    stale_sites: a site that an earlier run of the day had and this one lacks. `keep` leaves its
        partition; `drop` removes it, after the day's new partitions are written.
    duplicate_devices: see `enrich_capacity`.
    bytes_per_partition, most_partitions: raw bytes meant for one shuffle partition, and the most
        partitions of one pass. Days that together need more are run in several passes; a single day
        that needs more is deduplicated in several parts of its keys.
    """

    layout: str = "dated"
    off_date: str = "late"
    stale_sites: str = "keep"
    duplicate_devices: str = "fail"
    max_records_per_file: int | None = None
    bytes_per_partition: int = BYTES_PER_PARTITION
    most_partitions: int = MOST_PARTITIONS

    def __post_init__(self):
        if self.off_date not in ("late", "overwrite"):
            raise ValueError(f"unknown rule for off-date rows: {self.off_date}")
        if self.stale_sites not in ("keep", "drop"):
            raise ValueError(f"unknown rule for stale sites: {self.stale_sites}")
        if self.off_date == "overwrite" and self.stale_sites == "drop":
            raise ValueError("dates that only off-date rows touch must not be replaced whole")


def timed_readings(raw: DataFrame) -> DataFrame:
    """Raw records with their time; a blank site is none."""
    return with_event_time(raw.withColumn("site_id", F.nullif(F.col("site_id"), F.lit(""))))


def first_readings(timed: DataFrame, keys: Sequence[str] = schema.KEY) -> DataFrame:
    """First row per key with its number of `copies`, ranges; rows without a time still in."""
    return clean_readings(keep_first(timed, keys, schema.names(schema.TELEMETRY), copies="copies"))


def prepared_readings(raw: DataFrame, keys: Sequence[str] = schema.KEY) -> DataFrame:
    """Time, first row per key with its number of `copies`, ranges; rows without a time still in."""
    return first_readings(timed_readings(raw), keys)


def silver_readings(raw: DataFrame, devices: DataFrame, duplicates: str = "fail") -> DataFrame:
    """The whole chain from raw records to enriched readings; only the dimension is read at once."""
    cleaned = drop_untimed(prepared_readings(raw)).drop("copies")
    return enrich_capacity(cleaned, devices, duplicates).select(*schema.names(schema.SILVER))


def dates_between(first: str, days: int) -> list[str]:
    """`days` consecutive dates."""
    begin = date.fromisoformat(first)
    return [(begin + timedelta(days=i)).isoformat() for i in range(days)]


def run_day(
    spark: SparkSession, paths: LakePaths, process_date: str, options: RunOptions = RunOptions()
) -> DataFrame:
    """Process one day; see `run_days`."""
    return run_days(spark, paths, [process_date], options)


def run_days(
    spark: SparkSession,
    paths: LakePaths,
    dates: Sequence[str],
    options: RunOptions = RunOptions(),
) -> DataFrame:
    """Process the given days in one job chain and return their quality records.

    The raw text is read once: parsed, deduplicated and cleaned rows go to an intermediate Parquet
    table in the shared work folder. It cuts the lineage, fixes which of several copies survived,
    and feeds every later step, so counts are exact also when executors are lost on the way.
    Each day keeps its own keys, so the result equals running the days one by one.

    A merge of late rows that failed on the way is finished first, see `merge_late`.

    Order of the writes: the days' quality records are withdrawn, then readings, late rows, daily
    figures and quality records are written. A quality record is therefore the mark of a finished
    day, also when a day is run again. A day without raw rows writes nothing at all.
    """
    dates = sorted(set(dates))
    finish_merges(spark, paths)
    if options.off_date == "overwrite":
        passes = [[day] for day in dates]
    else:
        passes = _passes(spark, paths, dates, options)
    done = [_run_pass(spark, paths, days, options) for days in passes]
    return reduce(DataFrame.unionByName, done) if done else spark.createDataFrame([], schema.QUALITY)


def _passes(
    spark: SparkSession, paths: LakePaths, dates: list[str], options: RunOptions
) -> list[list[str]]:
    """Consecutive dates whose raw files fit in one pass; sizes come from the file listing."""

    def size(days):
        return input_bytes(read_raw_days(spark, paths.raw, days, options.layout))

    most = options.most_partitions * options.bytes_per_partition
    if not dates or size(dates) <= most:
        return [dates] if dates else []
    passes, room = [], 0
    for day in dates:
        own = size([day])
        if own > room:
            passes.append([])
            room = most
        passes[-1].append(day)
        room -= own
    return passes


def _run_pass(
    spark: SparkSession, paths: LakePaths, dates: list[str], options: RunOptions
) -> DataFrame:
    stage_path, sizes = fresh_dir(spark, "prepared"), (options.bytes_per_partition, options.most_partitions)
    raw = read_raw_days(spark, paths.raw, dates, options.layout)
    parts = passes_for(raw, *sizes)
    try:
        with shuffle_sized_for(raw, *sizes, passes=parts):
            if parts == 1:
                prepared_readings(raw, _RUN_KEY).write.parquet(stage_path)
            else:
                _prepare_in_parts(raw, parts, stage_path)
            return _write_days(spark, paths, spark.read.parquet(stage_path), options)
    finally:
        drop_dir(spark, stage_path)


def _prepare_in_parts(raw: DataFrame, parts: int, stage_path: str) -> None:
    """What one pass would write, from one shuffle after the other over disjoint parts of the keys.

    The raw text is still read once: parsed rows are written by part, without a shuffle, and each
    part is then deduplicated by itself. All copies of a key have its hash, so they meet in one part.
    """
    spark, parsed_path = raw.sparkSession, fresh_dir(raw.sparkSession, "parsed")
    timed = timed_readings(raw)
    try:
        part = F.pmod(F.xxhash64(*_RUN_KEY), F.lit(parts)).alias("part")
        timed.select("*", part).write.partitionBy("part").parquet(parsed_path)
        for path in folders(spark, f"{parsed_path}/part=*"):
            own = spark.read.schema(timed.schema).parquet(path)
            first_readings(own, _RUN_KEY).write.mode("append").parquet(stage_path)
    finally:
        drop_dir(spark, parsed_path)


def _write_days(
    spark: SparkSession, paths: LakePaths, stage: DataFrame, options: RunOptions
) -> DataFrame:
    quality = day_quality(stage).collect()  # one row per requested day
    if not quality:
        return spark.createDataFrame([], schema.QUALITY)
    done = sorted(row["process_date"] for row in quality)
    timed = drop_untimed(stage)
    readings = enrich_capacity(timed, read_devices(spark, paths.devices), options.duplicate_devices)
    if options.duplicate_devices == "fan_out":
        quality = _count_nulls_again(day_quality(stage), readings).collect()
    lake.drop_quality(spark, paths.metrics, done)
    on_date = F.col("event_date") == F.col("process_date").cast("date")
    touched = done
    if options.off_date == "late":
        lake.write_silver(readings.where(on_date), paths.silver, options.max_records_per_file)
        with_late = {row["process_date"] for row in quality if row["off_date_rows"]}
        _write_late(timed.where(~on_date), paths.late, done, with_late)
    else:
        lake.write_silver(readings, paths.silver, options.max_records_per_file)
        dates = timed.select("event_date").distinct().collect()  # a row per date
        touched = [row["event_date"].isoformat() for row in dates]
    sites = {}
    if options.stale_sites == "drop":
        now = timed.where(on_date).select("process_date", "site_id").distinct().collect()  # a row per folder
        sites = {day: {row["site_id"] for row in now if row["process_date"] == day} for day in done}
    lake.drop_other_sites(spark, paths.silver, sites)
    lake.write_states(site_states(lake.read_silver(spark, paths.silver, touched)), paths.states)
    lake.write_gold(figures(lake.read_states(spark, paths.states, touched)), paths.gold)
    lake.drop_other_sites(spark, paths.gold, sites)
    finished = spark.createDataFrame(
        [tuple(row[c] for c in schema.names(schema.QUALITY)) for row in quality], schema.QUALITY
    )
    lake.write_quality(finished, paths.metrics)
    return finished


def _count_nulls_again(quality: DataFrame, readings: DataFrame) -> DataFrame:
    """Quality records whose NULL counts are taken from readings multiplied by repeated devices."""
    counts = readings.groupBy("process_date").agg(
        F.count_if(F.col("power_w").isNull()).alias("null_power"),
        F.count_if(F.col("soc_percent").isNull()).alias("null_soc"),
    )
    return (
        quality.drop("null_power", "null_soc")
        .join(counts, "process_date", "left")
        .fillna(0, ["null_power", "null_soc"])
    )


def _write_late(rows: DataFrame, base: str, dates: Sequence[str], with_late: set[str]) -> None:
    """One folder per date and processed day. What the processed day held before is replaced whole: a
    re-run leaves no late row of the last one."""
    spark, written = rows.sparkSession, set()
    if with_late:
        (
            gathered(rows.select(*schema.names(LATE)), "event_date", "process_date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("event_date", "process_date")
            .parquet(base)
        )
        pairs = rows.select("event_date", "process_date").distinct().collect()  # a row per folder
        written = {f"event_date={p['event_date']}/process_date={p['process_date']}" for p in pairs}
    for day in dates:
        for folder in folders(spark, f"{base}/event_date=*/process_date={day}"):
            if "/".join(folder.rsplit("/", 2)[1:]) not in written:
                drop_dir(spark, folder)
