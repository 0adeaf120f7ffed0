"""The samples a device is expected to deliver."""

from __future__ import annotations

import math
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.readings import (
    expected_power,
    fixed_decimals,
    interval_energy,
    temperature_baseline,
)
from wattline.functions.times import day_fraction, iso_utc

_DAY_MICROS = 86_400_000_000
SAMPLES_PER_TASK = 1_000_000


def expected_grid(
    devices: DataFrame, start: str, days: int, rows_per_day: int, spread: int | None = None
) -> DataFrame:
    """`rows_per_day` evenly spaced instants on each of `days` dates, for every device row.

    Both sequences are made inside each device's row, so there is no join. The device days are first
    dealt out to `spread` tasks, as a device file of one partition would make the whole grid in one;
    by default to the session's shuffle partitions, or more where a task would get over
    `SAMPLES_PER_TASK` samples. For that the devices are counted when the plan is built.
    """
    if days < 1 or rows_per_day < 1:
        raise ValueError("days and rows_per_day must be positive")
    first = datetime.combine(date.fromisoformat(start), datetime.min.time(), timezone.utc)
    first_micros = F.lit(int(first.timestamp()) * 1_000_000)
    offset = F.bround(F.col("sample") * (_DAY_MICROS / rows_per_day)).cast("long")
    ts = F.timestamp_micros(first_micros + F.col("day_number") * F.lit(_DAY_MICROS) + offset)
    if spread is None:
        samples = devices.count() * days * rows_per_day
        configured = int(devices.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        spread = max(configured, math.ceil(samples / SAMPLES_PER_TASK))
    device_days = devices.withColumn("day_number", F.explode(_numbers(days)))
    return (
        device_days.repartition(spread, *device_days.columns)
        .withColumn("sample", F.explode(_numbers(rows_per_day)))
        .withColumn("ts", ts)
        .drop("day_number")
    )


def expected_readings(
    devices: DataFrame, start: str, days: int, rows_per_day: int, spread: int | None = None
) -> DataFrame:
    """What each device is expected to report at each sample, from its capacity and the time of day.

    `devices` has `device_id, site_id, capacity_kwh`. The curves carry no noise.
    """
    fraction = day_fraction(F.col("ts"))
    power = expected_power(fraction, F.col("capacity_kwh"))
    energy = interval_energy(power, 86_400 / rows_per_day)
    return expected_grid(devices, start, days, rows_per_day, spread).select(
        iso_utc(F.col("ts")).alias("ts_utc"),
        "device_id",
        "site_id",
        fixed_decimals(power, 3).alias("power_w"),
        fixed_decimals(energy, 6).alias("energy_wh"),
        fixed_decimals(temperature_baseline(fraction), 3).alias("temperature_c"),
    )


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))
