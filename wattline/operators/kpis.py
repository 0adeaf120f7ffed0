"""Daily figures per site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline import schema

# Fixed value: the status of a healthy reading.
HEALTHY = "OK"


def uptime_percent() -> Column:
    """Share of readings that are healthy; one without a status counts as not healthy."""
    return F.count_if(F.col("status") == HEALTHY) / F.count(F.lit(1)) * 100.0


def anomaly_count() -> Column:
    """Readings with a status other than the healthy one; one without a status is no anomaly."""
    return F.count_if(F.col("status") != HEALTHY)


def site_daily(readings: DataFrame) -> DataFrame:
    """Energy, peak power, mean temperature, uptime and anomalies per date and site.

    Every aggregate has a partial form, so a hot site is reduced to one row per input partition
    before the shuffle. NaN is the largest power; energy keeps its sign.
    """
    return readings.groupBy(*schema.SITE_DAY).agg(
        F.sum("energy_wh").alias("energy_wh_total"),
        F.max("power_w").alias("peak_power_w"),
        F.avg("temperature_c").alias("avg_temp_c"),
        uptime_percent().alias("uptime_percent"),
        anomaly_count().alias("anomaly_count"),
    )


def site_states(readings: DataFrame) -> DataFrame:
    """What the figures are made of, in a form that can be added to: see `merged_states`."""
    return readings.groupBy(*schema.SITE_DAY).agg(
        F.sum("energy_wh").alias("energy_wh"),
        F.max("power_w").alias("peak_power_w"),
        F.sum("temperature_c").alias("temperature_sum"),
        F.count("temperature_c").alias("temperature_rows"),
        F.count_if(F.col("status") == HEALTHY).alias("healthy_rows"),
        anomaly_count().alias("anomaly_count"),
        F.count(F.lit(1)).alias("all_rows"),
    )


def merged_states(states: DataFrame) -> DataFrame:
    """One state per date and site, of all readings that went into any of the given ones."""
    added = [c for c in states.columns if c not in (*schema.SITE_DAY, "peak_power_w")]
    return states.groupBy(*schema.SITE_DAY).agg(F.max("peak_power_w").alias("peak_power_w"), *[F.sum(c).alias(c) for c in added])


def figures(states: DataFrame) -> DataFrame:
    """The figures of `site_daily`."""
    return states.select(
        *schema.SITE_DAY,
        F.col("energy_wh").alias("energy_wh_total"),
        "peak_power_w",
        F.try_divide("temperature_sum", "temperature_rows").alias("avg_temp_c"),
        (F.col("healthy_rows") / F.col("all_rows") * 100.0).alias("uptime_percent"),
        "anomaly_count",
    )
