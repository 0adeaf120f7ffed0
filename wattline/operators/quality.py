"""Row, key and NULL counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from wattline import schema


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows_total"))


def key_counts(df: DataFrame, keys: Sequence[str] = schema.KEY) -> DataFrame:
    """`rows_total, distinct_keys, duplicate_keys` in one pass; NULL is a key value like any other.

    Counts per key first, so that repeated keys shrink before the shuffle.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    rows = F.coalesce(F.sum("copies"), F.lit(0))
    return per_key.agg(
        rows.alias("rows_total"),
        F.count(F.lit(1)).alias("distinct_keys"),
        (rows - F.count(F.lit(1))).alias("duplicate_keys"),
    )


def day_quality(cleaned: DataFrame, copies: str = "copies") -> DataFrame:
    """One quality record per `process_date`, from cleaned survivors that carry their copy count.

    `rows_total` and `duplicate_keys` are about raw rows and include those without a valid time;
    the NULL counts are about cleaned readings and do not. `off_date_rows` counts the readings of
    another date than the processed one; it is not part of the stored record.
    """
    timed = F.col("ts").isNotNull()
    off_date = F.col("event_date") != F.col("process_date").cast("date")
    return cleaned.groupBy("process_date").agg(
        F.sum(copies).alias("rows_total"),
        (F.sum(copies) - F.count(F.lit(1))).alias("duplicate_keys"),
        F.count_if(timed & F.col("power_w").isNull()).alias("null_power"),
        F.count_if(timed & F.col("soc_percent").isNull()).alias("null_soc"),
        F.count_if(off_date).alias("off_date_rows"),
    )


def observed_quality(cleaned: DataFrame, copies: str = "copies") -> tuple[DataFrame, Observation]:
    """The rows, and the sums of `day_quality` over all of them, counted while the rows are used.

    It costs no job of its own. After the first action on the returned rows, `Observation.get` has
    the sums, of what that action read: a plan that skips rows or reads them twice counts them so, which is
    why the stored records come from `day_quality`.
    """
    counts = Observation()
    timed = F.col("ts").isNotNull()
    rows = F.coalesce(F.sum(copies), F.lit(0))
    off_date = F.col("event_date") != F.col("process_date").cast("date")
    observed = cleaned.observe(
        counts,
        rows.alias("rows_total"),
        (rows - F.count(F.lit(1))).alias("duplicate_keys"),
        F.count_if(timed & F.col("power_w").isNull()).alias("null_power"),
        F.count_if(timed & F.col("soc_percent").isNull()).alias("null_soc"),
        F.count_if(off_date).alias("off_date_rows"),
    )
    return observed, counts


def status_counts(df: DataFrame) -> DataFrame:
    """Healthy, other and missing statuses, kept apart as three-valued comparison does."""
    return df.agg(
        F.count_if(F.col("status") == "OK").alias("ok_rows"),
        F.count_if(F.col("status") != "OK").alias("not_ok_rows"),
        F.count_if(F.col("status").isNull()).alias("no_status_rows"),
    )


def written_layout(df: DataFrame) -> DataFrame:
    """Number of files that hold the rows of a scan, and of the folders those files lie in."""
    files = df.select(F.col("_metadata.file_path").alias("file")).distinct()
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_distinct(F.regexp_replace("file", "/[^/]*$", "")).alias("folders"),
    )
