"""Late rows: adding them to the dates they belong to, and keeping the files of those dates few.

Both change what lies there already, so both write what they are about to do below `paths.merging` first. A
call that failed on the way is finished by the next `merge_late`, `compact_days` or run, whichever comes first;
two must not go on at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import schema
from wattline.operators.cleaning import keep_first
from wattline.operators.enrichment import enrich_capacity
from wattline.operators.kpis import figures, merged_states, site_states
from wattline.session import drop_dir, stored
from wattline.sources import lake
from wattline.sources.devices import read_devices
from wattline.sources.paths import exists, folders

if TYPE_CHECKING:
    from wattline.plans.daily import LakePaths

# A late row is a cleaned reading that has not met its device yet.
LATE = f"{schema.SILVER.replace('capacity_kwh double, ', '')}, process_date string"


def merge_late(
    spark: SparkSession,
    paths: LakePaths,
    dates: Sequence[str],
    duplicate_devices: str = "fail",
    compact: bool = True,
) -> None:
    """Add the late rows of some dates to them; a reading already there wins over a late one.

    Only the new rows are written, as further files of their partitions. The figures follow from the
    stored states, to which the states of the new rows are added: no reading that was there before is
    read again but for its key. Doing it twice adds nothing. To be called again after a later
    `run_days` of such a date, which writes only the day's own rows. `compact`: see `compact_days`.
    """
    finish_merges(spark, paths)
    late = lake.read_dates(spark, paths.late, LATE, dates)
    if late.isEmpty():
        return
    late = keep_first(late, schema.KEY, ["process_date"])
    # the date's readings are many and the late rows few: cut the former down before comparing
    present = lake.read_silver(spark, paths.silver, dates).select(*schema.KEY)
    taken = present.alias("l").join(late.alias("r"), same(schema.KEY), "left_semi")
    new = late.alias("l").join(taken.alias("r"), same(schema.KEY), "left_anti")
    readings = enrich_capacity(new, read_devices(spark, paths.devices), duplicate_devices)
    path = f"{paths.merging}/merge-{uuid.uuid4().hex}"
    readings.select(*schema.names(schema.SILVER)).write.parquet(path)
    _finish_merge(spark, paths, path)
    if compact:
        compact_days(spark, paths, dates)


def finish_merges(spark: SparkSession, paths: LakePaths) -> None:
    """Finish what an earlier call left undone; drop what it had not yet begun to change."""
    for path in folders(spark, f"{paths.merging}/*"):
        if not exists(spark, f"{path}/_SUCCESS"):
            drop_dir(spark, path)
        elif "/merge-" in path:
            _finish_merge(spark, paths, path, again=True)
        else:
            _finish_compaction(spark, paths, path)


def _finish_merge(spark: SparkSession, paths: LakePaths, path: str, again: bool = False) -> None:
    """Append the new rows, then bring states and figures up to date.

    `again`: some of it may be done. Then only rows that are missing are appended, and the states of the
    dates come from all their readings.
    """
    rows = spark.read.schema(schema.SILVER).parquet(path)
    dates = sorted(r.event_date.isoformat() for r in rows.select("event_date").distinct().collect())  # a row per date
    if dates:
        missing = rows
        if again:
            whole = [*schema.KEY, "capacity_kwh"]  # a key has several rows where devices repeat
            there = lake.read_silver(spark, paths.silver, dates).select(*whole)
            missing = stored(rows.alias("l").join(there.alias("r"), same(whole), "left_anti"), "missing")
        lake.write_silver(missing, paths.silver, append=True)
        known = [] if again else lake.dates_with_states(spark, paths.states, dates)
        others = [day for day in dates if day not in known]  # also of lakes that are older than the states
        old = lake.read_states(spark, paths.states, known)
        states = merged_states(old.unionByName(site_states(rows.where(F.col("event_date").cast("string").isin(known)))))
        if others:
            states = states.unionByName(site_states(lake.read_silver(spark, paths.silver, others)))
        states = stored(states, "states")
        lake.write_states(states, paths.states)
        touched = rows.select(*schema.SITE_DAY).distinct()
        changed = states.alias("l").join(touched.alias("r"), same(schema.SITE_DAY), "left_semi")
        lake.write_gold(figures(changed), paths.gold)
    drop_dir(spark, path)


def compact_days(
    spark: SparkSession, paths: LakePaths, dates: Sequence[str], file_bytes: int = lake.FILE_BYTES
) -> int:
    """Rewrite the site-days of some dates that lie in many small files; returns how many there were.

    A site-day is scattered if it has several files that are, on average, below half of `file_bytes`. The others are
    not read. The rows are copied before their partitions are replaced, so a failure loses none.
    """
    finish_merges(spark, paths)
    scattered = lake.scattered_folders(spark, paths.silver, dates, file_bytes)
    if scattered:
        rows = spark.read.schema(schema.SILVER).option("basePath", paths.silver).parquet(*scattered)
        path = f"{paths.merging}/compact-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        _finish_compaction(spark, paths, path)
    return len(scattered)


def _finish_compaction(spark: SparkSession, paths: LakePaths, path: str) -> None:
    lake.write_silver(spark.read.schema(schema.SILVER).parquet(path), paths.silver)
    drop_dir(spark, path)


def same(columns: Sequence[str]) -> Column:
    """Equality of the sides `l` and `r` of a join in which NULL equals NULL."""
    tests = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in columns]
    return reduce(lambda a, b: a & b, tests)
