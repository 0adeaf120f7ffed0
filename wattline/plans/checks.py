"""SQL checks on a frame of readings, for one date or for every date at once.

The date is a query parameter, never pasted into the text.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

_COUNTS = """
    count(*) AS rows_total,
    sum(int(power_w IS NULL)) AS null_power,
    sum(int(soc_percent IS NULL)) AS null_soc
"""
_OUTSIDE = "soc_percent < 0 OR soc_percent > 100"


def null_profile(
    spark: SparkSession, readings: DataFrame, event_date: str | None = None
) -> DataFrame:
    """Rows and NULL counts of a date (the two sums are NULL when it has no rows), or by date."""
    if event_date is None:
        return spark.sql(
            f"SELECT event_date, {_COUNTS} FROM {{readings}} GROUP BY event_date", readings=readings
        )
    return spark.sql(
        f"SELECT {_COUNTS} FROM {{readings}} WHERE event_date = :day",
        args={"day": date.fromisoformat(event_date)},
        readings=readings,
    )


def soc_out_of_bounds(
    spark: SparkSession, readings: DataFrame, event_date: str | None = None
) -> DataFrame:
    """Readings of a date whose state of charge is outside its range, or by date."""
    if event_date is None:
        return spark.sql(
            f"SELECT event_date, count_if({_OUTSIDE}) AS out_of_bounds_soc "
            "FROM {readings} GROUP BY event_date",
            readings=readings,
        )
    return spark.sql(
        "SELECT count(*) AS out_of_bounds_soc FROM {readings} "
        f"WHERE event_date = :day AND ({_OUTSIDE})",
        args={"day": date.fromisoformat(event_date)},
        readings=readings,
    )


def duplicate_keys(
    spark: SparkSession, readings: DataFrame, event_date: str | None = None, top: int = 50
) -> DataFrame:
    """The keys with most copies, of a date or of all; ties in order of device and time."""
    where = "" if event_date is None else "WHERE event_date = :day"
    return spark.sql(
        f"SELECT device_id, ts, count(*) AS cnt FROM {{readings}} {where} "
        "GROUP BY device_id, ts HAVING cnt > 1 ORDER BY cnt DESC, device_id, ts LIMIT :top",
        args={"top": top} | ({} if event_date is None else {"day": date.fromisoformat(event_date)}),
        readings=readings,
    )
