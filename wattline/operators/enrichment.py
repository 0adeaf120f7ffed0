"""Attach the capacity of the device to each reading."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.session import stored

# A dimension is broadcast only up to this many bytes (measured, see `profile_devices`).
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024
_ROW_OVERHEAD_BYTES = 64
# Salts for each partition's worth of a hot device: several, so that they fall evenly on the partitions.
_SALTS = 4


class DuplicateDevices(ValueError):
    """The dimension lists a device more than once, which would multiply its readings."""


@dataclass(frozen=True)
class DeviceProfile:
    rows: int
    duplicates: int
    approx_bytes: int


def profile_devices(devices: DataFrame) -> DeviceProfile:
    """Row count, surplus rows of repeated ids, and size of the dimension, in one small job.

    A NULL id matches no reading, so it is not a duplicate.
    """
    per_id = devices.groupBy("device_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.octet_length(F.col("device_id").cast("string"))).alias("id_bytes"),
    )
    found = per_id.agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("device_id").isNotNull(), F.col("n") - 1)).alias("duplicates"),
        F.sum("id_bytes").alias("id_bytes"),
    ).first()
    rows = found["n"] or 0
    return DeviceProfile(
        rows, found["duplicates"] or 0, (found["id_bytes"] or 0) + rows * _ROW_OVERHEAD_BYTES
    )


def one_per_device(devices: DataFrame) -> DataFrame:
    """Keep one row per device: the smallest capacity that is not NULL."""
    return devices.groupBy("device_id").agg(F.min("capacity_kwh").alias("capacity_kwh"))


def enrich_capacity(
    readings: DataFrame,
    devices: DataFrame,
    duplicates: str = "fail",
    broadcast_limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Left join on `device_id`; a reading without a device gets a NULL capacity.

    `duplicates` says what happens when the dimension repeats a device: `fail`, `keep_one`, or
    `fan_out` (each reading once per match). The dimension is measured first. Up to the limit it
    is broadcast, so the readings are not shuffled; beyond it both sides are shuffled by device and
    merged, where adaptive execution splits a device that holds many of the readings. Without it,
    `salted` deals such devices out.
    """
    if duplicates not in ("fail", "keep_one", "fan_out"):
        raise ValueError(f"unknown rule for duplicate devices: {duplicates}")
    devices = devices.select("device_id", "capacity_kwh")
    profile = profile_devices(devices)
    if profile.duplicates and duplicates == "fail":
        raise DuplicateDevices(f"{profile.duplicates} surplus rows repeat a device_id")
    if profile.duplicates and duplicates == "keep_one":
        devices = one_per_device(devices)
    if profile.approx_bytes <= broadcast_limit_bytes:
        return readings.join(F.broadcast(devices), "device_id", "left")
    if readings.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return readings.join(devices.hint("merge"), "device_id", "left")
    return salted(readings, devices)


def salted(readings: DataFrame, devices: DataFrame) -> DataFrame:
    """The merge join with the readings of each hot device dealt out to several tasks.

    Devices with more readings than a partition would have on average are hot; there are fewer of
    them than partitions, so they are broadcast. A hot device's readings get one of several salts, by their hash,
    and its row of the dimension is repeated for each. Readings without a device match nothing, but
    are dealt out alike.
    """
    partitions = int(readings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = readings.groupBy("device_id").agg(F.count(F.lit(1)).alias("n"))
    share = max(1.0, (counts.agg(F.sum("n")).first()[0] or 0) / partitions)
    hot_id, salts, salt = (_free(readings, n) for n in ("hot_id", "salts", "salt"))
    hot = counts.where(F.col("n") > share).select(F.col("device_id").alias(hot_id), F.ceil(_SALTS * F.col("n") / share).cast("int").alias(salts))
    hot = F.broadcast(stored(hot, "hot"))
    of = F.col("device_id").eqNullSafe(F.col(hot_id))
    own = F.coalesce(F.pmod(F.xxhash64(*readings.columns), F.col(salts)), F.lit(0)).cast("int")
    dealt = readings.join(hot, of, "left").withColumn(salt, own).drop(hot_id, salts)
    every = F.explode(F.sequence(F.lit(0), F.coalesce(salts, F.lit(1)) - 1))
    repeated = devices.join(hot, of, "left").withColumn(salt, every).drop(hot_id, salts)
    return dealt.join(repeated.hint("merge"), ["device_id", salt], "left").drop(salt)


def _free(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name
