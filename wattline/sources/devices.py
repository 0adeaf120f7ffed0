"""The device dimension: CSV files with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: capacity of a device when the file has no such column.
DEFAULT_CAPACITY_KWH = 200.0


def read_device_files(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, named by the header, which must be the same in every file.

    Rows are read by position, so a file whose header differs would put values in wrong columns:
    reading it is an error. The names come from one header line.
    """
    header = spark.read.option("header", True).csv(path).schema
    return spark.read.schema(header).options(header=True, enforceSchema=False).csv(path)


def read_devices(spark: SparkSession, path: str) -> DataFrame:
    """`device_id, capacity_kwh` as text and double; ids untouched, bad numbers NULL."""
    return read_device_files(spark, path).select(
        "device_id", F.col("capacity_kwh").try_cast("double").alias("capacity_kwh")
    )


def read_devices_normalized(spark: SparkSession, path: str) -> DataFrame:
    """The dimension with trimmed ids, and a default capacity if the files lack the column."""
    return normalize_devices(read_device_files(spark, path))


def normalize_devices(rows: DataFrame) -> DataFrame:
    """Trim text ids; `capacity_kwh` as a number, or the default where there is no such column."""
    capacity = (
        F.col("capacity_kwh").try_cast("double")
        if "capacity_kwh" in rows.columns
        else F.lit(DEFAULT_CAPACITY_KWH)
    )
    return rows.select(
        F.trim(F.col("device_id").cast("string")).alias("device_id"),
        F.trim(F.col("site_id").cast("string")).alias("site_id"),
        capacity.alias("capacity_kwh"),
    )
