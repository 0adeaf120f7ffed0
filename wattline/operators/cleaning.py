"""From raw records to cleaned readings: time, duplicates, ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline import schema
from wattline.functions.readings import (
    SOC_RANGE,
    TEMPERATURE_RANGE,
    floor_at_zero,
    null_outside,
)
from wattline.functions.times import parse_utc, utc_date


def with_event_time(df: DataFrame) -> DataFrame:
    """Add `ts` and `event_date`, both NULL where `ts_utc` is not a valid time."""
    return df.withColumn("ts", parse_utc(F.col("ts_utc"))).withColumn(
        "event_date", utc_date(F.col("ts"))
    )


def keep_first(
    df: DataFrame,
    keys: Sequence[str] = schema.KEY,
    order_by: Sequence[str] | None = None,
    copies: str | None = None,
) -> DataFrame:
    """One row per key: the smallest by `order_by`, then by the other columns, NULLs last.

    NULL keys are equal to each other. `copies` names a column for the number of rows a key had.

    Every input partition reduces a key to one row before the shuffle, so a key holding a third of
    all rows costs one row per partition: with `copies` by an aggregate over one struct, without by
    a rank of 1, which sorts but does not copy rows. The key's hash leads the keys because sorting
    by a number is decided on the sort prefix.
    """
    keys = list(keys)
    order_by = [c for c in order_by or [] if c not in keys]
    rest = order_by + [c for c in df.columns if c not in keys and c not in order_by]
    if not copies and rest:
        per_key = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*[F.col(c).asc_nulls_last() for c in rest])
        ranked = df.withColumn("rank_of_row", F.row_number().over(per_key))
        return ranked.where(F.col("rank_of_row") == 1).drop("rank_of_row")
    fields = []
    for position, name in enumerate(rest):
        if df.schema[name].nullable:  # NULLs last
            fields.append(F.col(name).isNull().alias(f"null_{position}"))
        fields.append(F.col(name).alias(f"col_{position}"))
    survivors = df.groupBy(F.xxhash64(*keys).alias("key_hash"), *keys).agg(
        F.count(F.lit(1)).alias("copies_of_key"), F.min(F.struct(*fields)).alias("first_row")
    )
    values = {name: F.col(f"first_row.col_{position}") for position, name in enumerate(rest)}
    columns = [values[c].alias(c) if c in values else F.col(c) for c in df.columns]
    if copies:
        columns.append(F.col("copies_of_key").alias(copies))
    return survivors.select(*columns)


def drop_untimed(df: DataFrame) -> DataFrame:
    """Leave out the rows whose time did not parse.

    `event_date` is NULL exactly when `ts` is. A test of `ts`, a grouping key, would be pushed below
    `keep_first` and there parse every text a second time.
    """
    return df.where(F.col("event_date").isNotNull())


def clean_readings(df: DataFrame) -> DataFrame:
    """Negative power to zero; state of charge and temperature outside their range to NULL."""
    return df.withColumns(
        {
            "power_w": floor_at_zero(F.col("power_w")),
            "soc_percent": null_outside(F.col("soc_percent"), SOC_RANGE),
            "temperature_c": null_outside(F.col("temperature_c"), TEMPERATURE_RANGE),
        }
    )
