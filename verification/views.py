"""Telemetry-shaped views of the given tables, once for Spark and once as SQL.

`events` stands for the readings of devices (hours as sample times, which makes repeated keys) and
`supplier` for the device dimension.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import schema
from wattline.functions.readings import VOLTAGE_RANGE, clamp, ratio_or_zero
from wattline.functions.times import ISO_UTC
from wattline.operators.cleaning import clean_readings, drop_untimed, keep_first, with_event_time
from wattline.plans.daily import LakePaths, dates_between
from wattline.session import fresh_dir
from wattline.sources.bronze import write_bronze
from wattline.sources.paths import folders


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_id",
        F.date_format(F.date_trunc("hour", "ts"), ISO_UTC).alias("ts_utc"),
        F.col("user_id").alias("device_id"),
        F.format_string("S%02d", F.col("user_id") % 5 + 1).alias("site_id"),
        (F.col("value") - 20).alias("power_w"),
        (F.col("value") / 60).alias("energy_wh"),
        (F.col("value") - 30).alias("temperature_c"),
        (F.get_json_object("props", "$.k").cast("double") * 1.2 - 5).alias("soc_percent"),
        F.when(F.col("event_type") == "error", "FAULT").otherwise("OK").alias("status"),
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        F.col("s_suppkey").alias("device_id"), F.col("s_acctbal").alias("capacity_kwh")
    )


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_event_time(telemetry(spark, sf_dir))


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = keep_first(parsed(spark, sf_dir), schema.KEY, ["event_id"], copies="copies")
    return clean_readings(rows)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_untimed(prepared(spark, sf_dir)).drop("copies")


def delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same readings as raw records, text ids and all ten fields, with their day of delivery.

    Some times are not in the agreed form and some readings have no power.
    """
    voltage = clamp(F.col("power_w") + 370, VOLTAGE_RANGE)
    return (
        telemetry(spark, sf_dir)
        .withColumn("day", F.substring("ts_utc", 1, 10))
        .withColumn("ts_utc", F.when(F.col("event_id") % 31 == 3, F.concat(F.lit("bad "), "ts_utc")).otherwise(F.col("ts_utc")))
        .withColumn("device_id", F.col("device_id").cast("string"))
        .withColumn("voltage_v", voltage)
        .withColumn("current_a", ratio_or_zero(F.col("power_w"), F.col("voltage_v")))
        .withColumn("power_w", F.when(F.col("event_id") % 17 != 5, F.col("power_w")))
        .select(*schema.names(schema.TELEMETRY), "day")
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(spark, sf_dir).drop("day")


def all_dates(spark: SparkSession, sf_dir: str, margin: int = 0) -> list[str]:
    """Every date of the table, and `margin` dates before and after it."""
    span = (
        events(spark, sf_dir)
        .agg(F.min(F.to_date("ts")).alias("first"), F.max(F.to_date("ts")).alias("last"))
        .select(
            F.date_sub("first", margin).cast("string").alias("first"),
            (F.datediff("last", "first") + 1 + 2 * margin).alias("days"),
        )
        .first()
    )
    return dates_between(span["first"], span["days"])


def lake(spark: SparkSession, sf_dir: str, day: Column | None = None) -> LakePaths:
    """A fresh lake whose raw folders and device file hold the whole tables; `day` is the day of
    delivery unless another is given."""
    paths = LakePaths.below(fresh_dir(spark, "lake"))
    write_bronze(delivered(spark, sf_dir), paths.raw, F.col("day") if day is None else day)
    devices(spark, sf_dir).write.option("header", True).csv(paths.devices)
    return paths


def dated_files(spark: SparkSession, sf_dir: str) -> str:
    """The raw records as devices deliver them, `YYYY/MM/DD/<site>/*.jsonl`; a folder for each site and day."""
    keyed, base = lake(spark, sf_dir).raw, fresh_dir(spark, "dated")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in folders(spark, f"{keyed}/raw_date=*/raw_site=*"):
        day, site = (part.split("=", 1)[1] for part in folder.rsplit("/", 2)[1:])
        target = f"{base}/{day.replace('-', '/')}/{site}"
        fs.mkdirs(path(target))
        for i, status in enumerate(fs.globStatus(path(f"{folder}/*.json"))):
            fs.rename(status.getPath(), path(f"{target}/part{i}.jsonl"))
    return base


# --- the same views as SQL ---------------------------------------------------------------------

TELEMETRY = """telemetry AS (
  SELECT event_id, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ') AS ts_utc,
    user_id AS device_id, printf('S%02d', user_id % 5 + 1) AS site_id,
    value - 20 AS power_w, value / 60 AS energy_wh, value - 30 AS temperature_c,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) * 1.2 - 5 AS soc_percent,
    CASE WHEN event_type = 'error' THEN 'FAULT' ELSE 'OK' END AS status
  FROM events)"""

PARSED = TELEMETRY + """, parsed AS (
  SELECT *, try_strptime(ts_utc, '%Y-%m-%dT%H:%M:%SZ') AS ts,
    CAST(try_strptime(ts_utc, '%Y-%m-%dT%H:%M:%SZ') AS DATE) AS event_date
  FROM telemetry)"""

DEDUPED = PARSED + """, deduped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY device_id, ts ORDER BY event_id) AS rn FROM parsed)
  WHERE rn = 1)"""

CLEANED = DEDUPED + """, cleaned AS (
  SELECT * REPLACE (
    CASE WHEN power_w < 0 THEN 0 ELSE power_w END AS power_w,
    CASE WHEN soc_percent < 0 OR soc_percent > 100 THEN NULL ELSE soc_percent END AS soc_percent,
    CASE WHEN temperature_c < -20 OR temperature_c > 80 THEN NULL ELSE temperature_c END
      AS temperature_c)
  FROM deduped WHERE ts IS NOT NULL)"""

SILVER = CLEANED + """, devices AS (
  SELECT s_suppkey AS device_id, s_acctbal AS capacity_kwh FROM supplier
), silver AS (
  SELECT cleaned.*, capacity_kwh FROM cleaned LEFT JOIN devices USING (device_id))"""

RECORDS = TELEMETRY + """, delivered AS (
  SELECT CASE WHEN event_id % 31 = 3 THEN 'bad ' || ts_utc ELSE ts_utc END AS ts_utc,
    CAST(device_id AS VARCHAR) AS device_id, site_id,
    CASE WHEN event_id % 17 <> 5 THEN power_w END AS power_w, energy_wh,
    greatest(360, least(440, power_w + 370)) AS voltage_v,
    power_w / greatest(360, least(440, power_w + 370)) AS current_a,
    temperature_c, soc_percent, status, ts_utc[1:10] AS day
  FROM telemetry
), records AS (SELECT * EXCLUDE (day) FROM delivered)"""

RECORDS_SILVER = RECORDS + """, timed AS (
  SELECT *, CAST(try_strptime(ts_utc, '%Y-%m-%dT%H:%M:%SZ') AS TIMESTAMP) AS ts FROM delivered
), ranked AS (  -- one key without a time for each device and day
  SELECT *, CAST(ts AS DATE) AS event_date,
    row_number() OVER (PARTITION BY day, device_id, ts ORDER BY ts_utc, site_id, power_w NULLS LAST, energy_wh,
      voltage_v, current_a, temperature_c, soc_percent, status) AS rn
  FROM timed
), survivors AS (SELECT * EXCLUDE (rn, day) FROM ranked WHERE rn = 1 AND ts IS NOT NULL
), silver AS (
  SELECT survivors.* REPLACE (
    CASE WHEN power_w < 0 THEN 0 ELSE power_w END AS power_w,
    CASE WHEN soc_percent < 0 OR soc_percent > 100 THEN NULL ELSE soc_percent END AS soc_percent,
    CASE WHEN temperature_c < -20 OR temperature_c > 80 THEN NULL ELSE temperature_c END
      AS temperature_c),
    s_acctbal AS capacity_kwh
  FROM survivors LEFT JOIN supplier ON survivors.device_id = CAST(s_suppkey AS VARCHAR))"""

GOLD_SELECT = """SELECT event_date, site_id, round(sum(energy_wh), 6) AS energy_wh_total,
  max(power_w) AS peak_power_w, round(avg(temperature_c), 6) AS avg_temp_c,
  round(count(*) FILTER (status = 'OK') / count(*) * 100.0, 6) AS uptime_percent,
  count(*) FILTER (status <> 'OK') AS anomaly_count
FROM {source} GROUP BY event_date, site_id"""
