"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR    the tables (default /root/testdata/sf0.1)
BENCH_CPUS      threads (default 8)
BENCH_COPIES    how often the readings are repeated, under other device ids, for the two runs over
                raw files (default 10)

`run_single_pass` is `run_days`. `run_separate_actions` gives the same tables the plain way, one
action per figure over an uncached plan, and is what the former is measured against.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verification import views as v
from verification.queries import registered
from wattline import schema
from wattline.operators.cleaning import clean_readings, drop_untimed, with_event_time
from wattline.operators.kpis import site_daily
from wattline.plans.daily import LakePaths, RunOptions, run_days
from wattline.session import build_session, fresh_dir
from wattline.sources import lake
from wattline.sources.bronze import read_raw_days, write_bronze
from wattline.sources.devices import read_devices

HEADLINES = [
    "gold_site_daily",
    "silver_telemetry",
    "dedupe_keys",
    "enrich_capacity",
    "clean_telemetry",
    "distinct_keys",
    "duplicate_keys_top50",
    "sql_null_profile",
    "status_counts",
    "expected_grid",
    "expected_power",
    "bounded_running_sum",
    "to_json_records",
    "bronze_jsonl_roundtrip",
]


def seconds(action) -> float:
    begun = time.perf_counter()
    action()
    return round(time.perf_counter() - begun, 3)


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def raw_files(spark: SparkSession, sf_dir: str, copies: int) -> LakePaths:
    """A lake with `copies` times the readings, each copy under device ids of its own."""
    paths = LakePaths.below(fresh_dir(spark, "bench"))
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    repeated = v.delivered(spark, sf_dir).withColumn("copy", copy)
    own_id = F.when(F.col("copy") == 0, F.col("device_id")).otherwise(F.concat("device_id", F.lit("-"), "copy"))
    write_bronze(repeated.withColumn("device_id", own_id), paths.raw, F.col("day"))
    v.devices(spark, sf_dir).write.option("header", True).csv(paths.devices)
    return paths


def run_separate_actions(spark: SparkSession, paths: LakePaths, dates: list[str]) -> None:
    raw = read_raw_days(spark, paths.raw, dates, "keyed").drop("process_date")
    if raw.isEmpty():
        return
    timed = with_event_time(raw)
    rows = timed.count()
    timed.select(*schema.KEY).distinct().count()
    cleaned = clean_readings(drop_untimed(timed.dropDuplicates(list(schema.KEY))))
    readings = cleaned.join(F.broadcast(read_devices(spark, paths.devices)), "device_id", "left")
    readings.where(F.col("power_w").isNull()).count()
    readings.where(F.col("soc_percent").isNull()).count()
    lake.write_silver(readings, paths.silver)
    lake.write_gold(site_daily(readings), paths.gold)
    raw.count()
    assert rows


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    copies = int(os.environ.get("BENCH_COPIES", "10"))
    spark = build_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {name: fn for name, (fn, _) in registered().items()}
    timings = {}
    for name in HEADLINES:
        consume(queries[name](spark, sf_dir))  # compile and warm up
        timings[name] = min(seconds(lambda: consume(queries[name](spark, sf_dir))) for _ in range(2))

    dates = v.all_dates(spark, sf_dir)
    paths = raw_files(spark, sf_dir, copies)
    other = LakePaths(paths.raw, *[f"{fresh_dir(spark, 'bench')}/{x}" for x in ("silver", "gold", "metrics")],
                      devices=paths.devices, late=paths.late)
    runs = {
        "run_single_pass": lambda: run_days(spark, paths, dates, RunOptions(layout="keyed")),
        "run_separate_actions": lambda: run_separate_actions(spark, other, dates),
    }
    for _ in range(2):
        for name, run in runs.items():
            timings[name] = min(timings.get(name, float("inf")), seconds(run))
    assert lake.read_silver(spark, paths.silver).count() == lake.read_silver(spark, other.silver).count()

    value = round(sum(s for name, s in timings.items() if name != "run_separate_actions"), 3)
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": value,
        "unit": "sec",
        "queries": timings,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "copies": copies,
        "speedup_over_separate_actions": round(timings["run_separate_actions"] / timings["run_single_pass"], 2),
    }))


if __name__ == "__main__":
    sys.exit(main())
