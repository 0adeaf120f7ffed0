"""Name -> (query, SQL or None)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verification import views as v
from wattline import schema
from wattline.functions import readings as r
from wattline.functions import times as t
from wattline.operators.cleaning import clean_readings, drop_untimed, keep_first, with_event_time
from wattline.operators.enrichment import enrich_capacity
from wattline.operators.grid import expected_grid, expected_readings
from wattline.operators.kpis import site_daily, uptime_percent
from wattline.operators.quality import (
    key_counts,
    observed_quality,
    row_count,
    status_counts,
    written_layout,
)
from wattline.operators.running import bounded_running_sum
from wattline.plans import checks
from wattline.plans.daily import LATE, RunOptions, merge_late, prepared_readings, run_days
from wattline.session import fresh_dir
from wattline.sources import lake
from wattline.sources.bronze import read_raw_days, write_bronze
from wattline.sources.devices import read_devices, read_devices_normalized

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}
KEYED = RunOptions(layout="keyed")


def query(sql: str | None = None):
    def register(fn: Query) -> Query:
        REGISTRY[fn.__name__] = (fn, sql)
        return fn

    return register


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def rounded_gold(gold: DataFrame) -> DataFrame:
    """Sums and means in a form that does not depend on the order of addition."""
    return gold.select(
        "event_date",
        "site_id",
        F.round("energy_wh_total", 6).alias("energy_wh_total"),
        "peak_power_w",
        F.round("avg_temp_c", 6).alias("avg_temp_c"),
        F.round("uptime_percent", 6).alias("uptime_percent"),
        "anomaly_count",
    )


# --- scans and sources -------------------------------------------------------------------------


@query(with_(v.RECORDS, "SELECT * EXCLUDE (day), day AS process_date FROM delivered"))
def raw_day_scan_dated(spark, sf_dir):
    """Every day in the layout in which devices deliver it."""
    return read_raw_days(spark, v.dated_files(spark, sf_dir), v.all_dates(spark, sf_dir))


@query(with_(v.RECORDS, "SELECT * EXCLUDE (day), day AS process_date FROM delivered"))
def raw_day_scan(spark, sf_dir):
    """Every day of the table, each selected by its folder; the day comes from the path."""
    paths = v.lake(spark, sf_dir)
    return read_raw_days(spark, paths.raw, v.all_dates(spark, sf_dir), "keyed")


@query(with_(v.RECORDS, """SELECT * REPLACE (CAST(NULL AS DOUBLE) AS voltage_v,
  CAST(NULL AS DOUBLE) AS current_a) FROM records"""))
def raw_schema_projection(spark, sf_dir):
    """JSON lines with missing and surplus keys, read under the declared schema."""
    path = fresh_dir(spark, "lines")
    other_keys = v.records(spark, sf_dir).drop("voltage_v", "current_a").withColumn("extra", F.lit(1))
    other_keys.write.json(path)
    return spark.read.schema(schema.TELEMETRY).json(path)


@query(with_(v.PARSED, """SELECT strftime(d, '%Y-%m-%d') AS process_date, count(event_id) AS rows_total
FROM (SELECT unnest(generate_series(min(event_date) - INTERVAL 2 DAY, max(event_date) + INTERVAL 2 DAY,
  INTERVAL 1 DAY)) AS d FROM parsed)
LEFT JOIN parsed ON event_date = CAST(d AS DATE) GROUP BY d"""))
def empty_day(spark, sf_dir):
    """Raw rows of every date and of two dates before and after, whose folders do not exist."""
    paths = v.lake(spark, sf_dir)
    dates = v.all_dates(spark, sf_dir, margin=2)
    found = read_raw_days(spark, paths.raw, dates, "keyed").groupBy("process_date").count()
    calendar = spark.createDataFrame([(d,) for d in dates], "process_date string")
    return calendar.join(found, "process_date", "left").select(
        "process_date", F.coalesce("count", F.lit(0)).alias("rows_total")
    )


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS device_id,
  CASE WHEN s_nationkey = 3 THEN NULL ELSE s_acctbal END AS capacity_kwh FROM supplier""")
def device_dim_scan(spark, sf_dir):
    """Device file in which some capacities are not numbers."""
    path = fresh_dir(spark, "devices")
    (
        spark.read.parquet(f"{sf_dir}/supplier.parquet")
        .select(
            F.lit("battery").alias("device_type"),
            F.when(F.col("s_nationkey") == 3, "n/a")
            .otherwise(F.col("s_acctbal").cast("string"))
            .alias("capacity_kwh"),
            F.col("s_suppkey").alias("device_id"),
        )
        .write.option("header", True)
        .csv(path)
    )
    return read_devices(spark, path)


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS device_id, printf('S%02d', s_suppkey % 5 + 1) AS site_id,
  200.0::DOUBLE AS capacity_kwh FROM supplier""")
def device_dim_normalized(spark, sf_dir):
    """Device file with blanks around the ids and without a capacity column."""
    path = fresh_dir(spark, "devices")
    (
        spark.read.parquet(f"{sf_dir}/supplier.parquet")
        .select(
            F.format_string(" %d ", "s_suppkey").alias("device_id"),
            F.format_string(" S%02d ", F.col("s_suppkey") % 5 + 1).alias("site_id"),
        )
        .write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )
    return read_devices_normalized(spark, path)


_SILVER_COLUMNS = ", ".join(schema.names(schema.SILVER))


def _written_lake(spark, sf_dir):
    paths = v.lake(spark, sf_dir)
    run_days(spark, paths, v.all_dates(spark, sf_dir), KEYED)
    return paths


_EVERY_OTHER = "(event_date - (SELECT min(event_date) FROM silver)) % 2 = 0"


@query(with_(v.RECORDS_SILVER, f"SELECT {_SILVER_COLUMNS} FROM silver WHERE {_EVERY_OTHER}"))
def silver_date_scan(spark, sf_dir):
    """Readings of every other date, whose folders alone are listed."""
    paths = _written_lake(spark, sf_dir)
    return lake.read_silver(spark, paths.silver, v.all_dates(spark, sf_dir)[::2])


# --- sinks and runs ----------------------------------------------------------------------------


@query(with_(v.RECORDS_SILVER, f"SELECT {_SILVER_COLUMNS} FROM silver"))
def silver_roundtrip(spark, sf_dir):
    paths = v.lake(spark, sf_dir)
    run_days(spark, paths, v.all_dates(spark, sf_dir), KEYED)
    return lake.read_silver(spark, paths.silver)


@query(with_(v.RECORDS_SILVER, v.GOLD_SELECT.format(source="silver")))
def gold_roundtrip(spark, sf_dir):
    paths = v.lake(spark, sf_dir)
    run_days(spark, paths, v.all_dates(spark, sf_dir), KEYED)
    return rounded_gold(lake.read_gold(spark, paths.gold))


def _rerun(spark, sf_dir):
    """All dates, then all dates again, then one date alone."""
    paths = v.lake(spark, sf_dir)
    dates = v.all_dates(spark, sf_dir)
    run_days(spark, paths, dates, KEYED)
    run_days(spark, paths, dates, KEYED)
    run_days(spark, paths, dates[:1], KEYED)
    return paths


@query(with_(v.RECORDS_SILVER, v.GOLD_SELECT.format(source="silver")))
def idempotent_rerun(spark, sf_dir):
    return rounded_gold(lake.read_gold(spark, _rerun(spark, sf_dir).gold))


@query(with_(v.RECORDS_SILVER, f"SELECT {_SILVER_COLUMNS} FROM silver"))
def idempotent_rerun_readings(spark, sf_dir):
    return lake.read_silver(spark, _rerun(spark, sf_dir).silver)


_QUALITY_SELECT = """SELECT day AS process_date, count(*) AS rows_total,
  count(*) FILTER (rn > 1) AS duplicate_keys,
  count(*) FILTER (rn = 1 AND ts IS NOT NULL AND power_w IS NULL) AS null_power,
  count(*) FILTER (rn = 1 AND ts IS NOT NULL AND (soc_percent < 0 OR soc_percent > 100 OR soc_percent IS NULL)) AS null_soc
FROM ranked GROUP BY day"""


@query(with_(v.RECORDS_SILVER, _QUALITY_SELECT))
def quality_summary(spark, sf_dir):
    """Quality records of all dates as a run wrote them, read back."""
    return lake.read_quality(spark, _written_lake(spark, sf_dir).metrics)


@query(with_(v.RECORDS_SILVER, f"""SELECT sum(rows_total)::BIGINT AS rows_total, sum(duplicate_keys)::BIGINT AS duplicate_keys,
  sum(null_power)::BIGINT AS null_power, sum(null_soc)::BIGINT AS null_soc FROM ({_QUALITY_SELECT})"""))
def quality_observed(spark, sf_dir):
    """The counts of all days, observed while the prepared rows are written."""
    raw = v.delivered(spark, sf_dir).withColumnRenamed("day", "process_date")
    prepared = prepared_readings(raw, ("process_date", *schema.KEY))
    rows, counts = observed_quality(prepared)
    rows.write.parquet(fresh_dir(spark, "observed"))
    names = ["rows_total", "duplicate_keys", "null_power", "null_soc"]
    return spark.createDataFrame([tuple(counts.get[n] for n in names)], ", ".join(f"{n} long" for n in names))


@query(with_(v.RECORDS_SILVER, _QUALITY_SELECT))
def multi_day_run(spark, sf_dir):
    """Quality records of a run over all dates at once."""
    paths = v.lake(spark, sf_dir)
    return run_days(spark, paths, v.all_dates(spark, sf_dir), KEYED)


@query(with_(v.RECORDS, "SELECT * EXCLUDE (day), day AS process_date FROM delivered"))
def bronze_jsonl_roundtrip(spark, sf_dir):
    """Records, some with bad times, written by their day of delivery and read as a run reads them."""
    path = fresh_dir(spark, "bronze")
    write_bronze(v.delivered(spark, sf_dir), path, F.col("day"))
    return read_raw_days(spark, path, v.all_dates(spark, sf_dir), "keyed")


@query(with_(v.RECORDS_SILVER, """SELECT count(DISTINCT (event_date, site_id)) AS files,
  count(DISTINCT (event_date, site_id)) AS folders FROM silver"""))
def silver_file_layout(spark, sf_dir):
    paths = v.lake(spark, sf_dir)
    run_days(spark, paths, v.all_dates(spark, sf_dir), KEYED)
    return written_layout(lake.read_silver(spark, paths.silver))


def _lake_with_late_rows(spark, sf_dir):
    """Readings of the last hour lie in the folder of the day before, but for the first date's."""
    dates = v.all_dates(spark, sf_dir)
    moved = (F.hour(t.parse_utc(F.col("ts_utc"))) == 23) & (F.col("day") != dates[0])
    day = F.when(moved, F.date_sub(F.to_date("day"), 1).cast("string")).otherwise(F.col("day"))
    paths = v.lake(spark, sf_dir, day)
    run_days(spark, paths, dates, KEYED)
    return paths, dates


@query(with_(v.RECORDS_SILVER, f"""SELECT * EXCLUDE (capacity_kwh),
  strftime(event_date - 1, '%Y-%m-%d') AS process_date
FROM (SELECT {_SILVER_COLUMNS} FROM silver) WHERE hour(ts) = 23
  AND event_date > (SELECT min(event_date) FROM survivors)"""))
def late_rows_kept_apart(spark, sf_dir):
    paths, _ = _lake_with_late_rows(spark, sf_dir)
    return lake.read_dates(spark, paths.late, LATE, None)


@query(with_(v.RECORDS_SILVER, f"SELECT {_SILVER_COLUMNS} FROM silver"))
def late_rows_merged(spark, sf_dir):
    """After the merge the readings are those of a table without late rows."""
    paths, dates = _lake_with_late_rows(spark, sf_dir)
    merge_late(spark, paths, dates)
    return lake.read_silver(spark, paths.silver)


@query(with_(v.RECORDS_SILVER, """SELECT count(DISTINCT (event_date, site_id)) AS files,
  count(DISTINCT (event_date, site_id)) AS folders FROM silver"""))
def merged_file_layout(spark, sf_dir):
    """After merges of one date after the other, each site-day is one file again."""
    paths, dates = _lake_with_late_rows(spark, sf_dir)
    for first in range(0, len(dates), 10):
        merge_late(spark, paths, dates[first : first + 10])
    return written_layout(lake.read_silver(spark, paths.silver))


@query(with_(v.RECORDS_SILVER, v.GOLD_SELECT.format(source="silver")))
def late_gold_merged(spark, sf_dir):
    """The figures after the merge."""
    paths, dates = _lake_with_late_rows(spark, sf_dir)
    merge_late(spark, paths, dates)
    return rounded_gold(lake.read_gold(spark, paths.gold))


_PARITY = v.RECORDS_SILVER.replace("delivered AS (", "as_dated AS (").replace("records AS (SELECT * EXCLUDE (day) FROM delivered)", """delivered AS (
  SELECT * REPLACE (CASE WHEN ts_utc LIKE '%T23:%' AND ts_utc NOT LIKE 'bad%' AND day <> (SELECT min(day) FROM as_dated)
    THEN strftime(CAST(day AS DATE) - 1, '%Y-%m-%d') ELSE day END AS day) FROM as_dated
), records AS (SELECT * EXCLUDE (day) FROM delivered)""").replace("SELECT * EXCLUDE (rn, day) FROM ranked WHERE rn = 1 AND ts IS NOT NULL", """
  -- the last day that wrote a partition left its rows there
  SELECT * EXCLUDE (rn, day, last) FROM (SELECT *, max(day) OVER (PARTITION BY event_date, site_id) AS last
    FROM ranked WHERE rn = 1 AND ts IS NOT NULL) WHERE day = last""")


@query(with_(_PARITY, v.GOLD_SELECT.format(source="silver")))
def parity_multi_day(spark, sf_dir):
    """Off-date rows are written under their own date, and the date's own run then replaces them."""
    dates = v.all_dates(spark, sf_dir)
    moved = (F.hour(t.parse_utc(F.col("ts_utc"))) == 23) & (F.col("day") != dates[0])
    day = F.when(moved, F.date_sub(F.to_date("day"), 1).cast("string")).otherwise(F.col("day"))
    paths = v.lake(spark, sf_dir, day)
    run_days(spark, paths, dates, RunOptions(layout="keyed", off_date="overwrite"))
    return rounded_gold(lake.read_gold(spark, paths.gold))


# --- projections -------------------------------------------------------------------------------


@query(with_(v.TELEMETRY, """SELECT event_id, ts_utc, try_strptime(ts_utc, '%Y-%m-%dT%H:%M:%SZ') AS ts
FROM (SELECT event_id, CASE WHEN status = 'FAULT' THEN 'bad ' || ts_utc ELSE ts_utc END AS ts_utc
  FROM telemetry)"""))
def parse_timestamp(spark, sf_dir):
    """Times of which the faulty devices' are not in the agreed form."""
    bad = F.when(F.col("status") == "FAULT", F.concat(F.lit("bad "), "ts_utc")).otherwise(F.col("ts_utc"))
    return v.telemetry(spark, sf_dir).select("event_id", bad.alias("ts_utc")).withColumn(
        "ts", t.parse_utc(F.col("ts_utc"))
    )


@query(with_(v.PARSED, "SELECT event_id, event_date FROM parsed"))
def event_date(spark, sf_dir):
    return v.parsed(spark, sf_dir).select("event_id", "event_date")


@query(with_(v.TELEMETRY, """SELECT event_id, CASE WHEN power_w < 0 THEN 0 ELSE power_w END AS power_w
FROM telemetry"""))
def clamp_negative_power(spark, sf_dir):
    return v.telemetry(spark, sf_dir).select(
        "event_id", r.floor_at_zero(F.col("power_w")).alias("power_w")
    )


@query(with_(v.TELEMETRY, """SELECT event_id,
  CASE WHEN soc_percent BETWEEN 0 AND 100 THEN soc_percent END AS soc_percent FROM telemetry"""))
def null_out_of_range_soc(spark, sf_dir):
    return v.telemetry(spark, sf_dir).select(
        "event_id", r.null_outside(F.col("soc_percent"), r.SOC_RANGE).alias("soc_percent")
    )


@query(with_(v.TELEMETRY, """SELECT event_id,
  CASE WHEN temperature_c BETWEEN -20 AND 80 THEN temperature_c END AS temperature_c FROM telemetry"""))
def null_out_of_range_temp(spark, sf_dir):
    return v.telemetry(spark, sf_dir).select(
        "event_id", r.null_outside(F.col("temperature_c"), r.TEMPERATURE_RANGE).alias("temperature_c")
    )


@query(with_(v.TELEMETRY, """SELECT * REPLACE (
  CASE WHEN power_w < 0 THEN 0 ELSE power_w END AS power_w,
  CASE WHEN soc_percent BETWEEN 0 AND 100 THEN soc_percent END AS soc_percent,
  CASE WHEN temperature_c BETWEEN -20 AND 80 THEN temperature_c END AS temperature_c) FROM telemetry"""))
def clean_telemetry(spark, sf_dir):
    return clean_readings(v.telemetry(spark, sf_dir))


# --- filters, duplicates, joins ----------------------------------------------------------------


@query(with_(v.TELEMETRY, """SELECT event_id, device_id, strptime(ts_utc, '%Y-%m-%dT%H:%M:%SZ') AS ts
FROM telemetry WHERE status <> 'FAULT'"""))
def drop_unparseable_ts(spark, sf_dir):
    rows = v.telemetry(spark, sf_dir).select("event_id", "device_id", "ts_utc", "status")
    bad = F.when(F.col("status") == "FAULT", "not a time").otherwise(F.col("ts_utc"))
    timed = drop_untimed(with_event_time(rows.withColumn("ts_utc", bad)))
    return timed.select("event_id", "device_id", "ts")


@query(with_(v.DEDUPED, "SELECT * FROM deduped"))
def dedupe_keys(spark, sf_dir):
    return keep_first(v.parsed(spark, sf_dir), schema.KEY, ["event_id"])


@query(with_(v.SILVER, "SELECT device_id, ts, capacity_kwh FROM silver"))
def enrich_capacity_query(spark, sf_dir):
    return enrich_capacity(v.cleaned(spark, sf_dir), v.devices(spark, sf_dir)).select(
        "device_id", "ts", "capacity_kwh"
    )


@query(with_(v.SILVER, "SELECT device_id, ts, capacity_kwh FROM silver"))
def enrich_capacity_merged(spark, sf_dir):
    """The same join for a dimension too large to broadcast."""
    return enrich_capacity(
        v.cleaned(spark, sf_dir), v.devices(spark, sf_dir), broadcast_limit_bytes=0
    ).select("device_id", "ts", "capacity_kwh")


def _repeated_devices(spark, sf_dir):
    """Devices of large capacity are listed twice."""
    rows = v.devices(spark, sf_dir)
    again = rows.where(F.col("capacity_kwh") > 5000).withColumn("capacity_kwh", F.col("capacity_kwh") + 1)
    return rows.unionByName(again)


@query(with_(v.SILVER, "SELECT device_id, ts, capacity_kwh FROM silver"))
def repeated_devices_kept_once(spark, sf_dir):
    return enrich_capacity(
        v.cleaned(spark, sf_dir), _repeated_devices(spark, sf_dir), "keep_one"
    ).select("device_id", "ts", "capacity_kwh")


@query(with_(v.SILVER, """SELECT device_id, ts, capacity_kwh FROM silver UNION ALL
SELECT device_id, ts, capacity_kwh + 1 FROM silver
WHERE capacity_kwh > 5000"""))
def repeated_devices_fan_out(spark, sf_dir):
    return enrich_capacity(
        v.cleaned(spark, sf_dir), _repeated_devices(spark, sf_dir), "fan_out"
    ).select("device_id", "ts", "capacity_kwh")


@query(with_(v.SILVER, "SELECT * FROM silver"))
def silver_telemetry(spark, sf_dir):
    return enrich_capacity(v.cleaned(spark, sf_dir), v.devices(spark, sf_dir))


# --- aggregates and checks ---------------------------------------------------------------------


@query(with_(v.CLEANED, v.GOLD_SELECT.format(source="cleaned")))
def gold_site_daily(spark, sf_dir):
    """The figures by the chain as it runs: time, first of each key, ranges, figures."""
    return rounded_gold(site_daily(v.cleaned(spark, sf_dir)))


@query(with_(v.CLEANED, """SELECT event_date, site_id,
  round(count(*) FILTER (status = 'OK') / count(*) * 100.0, 6) AS uptime_percent
FROM cleaned GROUP BY ALL"""))
def uptime_percent_query(spark, sf_dir):
    return (
        v.cleaned(spark, sf_dir)
        .groupBy(*schema.SITE_DAY)
        .agg(F.round(uptime_percent(), 6).alias("uptime_percent"))
    )


@query("SELECT count(*) AS rows_total FROM events")
def rows_total(spark, sf_dir):
    return row_count(v.telemetry(spark, sf_dir))


@query(with_(v.PARSED, "SELECT count(*) AS distinct_keys FROM (SELECT DISTINCT device_id, ts FROM parsed)"))
def distinct_keys(spark, sf_dir):
    return key_counts(v.parsed(spark, sf_dir)).select("distinct_keys")


@query(with_(v.PARSED, """SELECT (SELECT count(*) FROM parsed)
  - (SELECT count(*) FROM (SELECT DISTINCT device_id, ts FROM parsed)) AS duplicate_keys"""))
def duplicate_count(spark, sf_dir):
    return key_counts(v.parsed(spark, sf_dir)).select("duplicate_keys")


@query(with_(v.TELEMETRY + """, labelled AS (
  SELECT nullif(status, CASE WHEN power_w < 0 THEN 'OK' END) AS status FROM telemetry)""",
"""SELECT count(*) FILTER (status = 'OK') AS ok_rows, count(*) FILTER (status <> 'OK') AS not_ok_rows,
  count(*) FILTER (status IS NULL) AS no_status_rows FROM labelled"""))
def status_counts_query(spark, sf_dir):
    """Some healthy rows have lost their status."""
    lost = F.nullif(F.col("status"), F.when(F.col("power_w") < 0, "OK"))
    return status_counts(v.telemetry(spark, sf_dir).withColumn("status", lost))


@query(with_(v.CLEANED, """SELECT event_date, count(*) AS rows_total,
  CAST(sum(CASE WHEN power_w IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_power,
  CAST(sum(CASE WHEN soc_percent IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_soc
FROM cleaned GROUP BY event_date"""))
def sql_null_profile(spark, sf_dir):
    return checks.null_profile(spark, v.cleaned(spark, sf_dir))


@query(with_(v.PARSED, """SELECT event_date, count(*) FILTER (soc_percent < 0 OR soc_percent > 100)
  AS out_of_bounds_soc FROM parsed GROUP BY event_date"""))
def soc_bounds_check(spark, sf_dir):
    return checks.soc_out_of_bounds(spark, v.parsed(spark, sf_dir))


@query(with_(v.PARSED, """SELECT device_id, ts, count(*) AS cnt FROM parsed GROUP BY device_id, ts
HAVING count(*) > 1 ORDER BY cnt DESC, device_id, ts LIMIT 50"""))
def duplicate_keys_top50(spark, sf_dir):
    return checks.duplicate_keys(spark, v.parsed(spark, sf_dir))


def _a_day_and_none(spark, sf_dir):
    """A date in the middle of the table and one long before it."""
    dates = v.all_dates(spark, sf_dir)
    return [("within", dates[len(dates) // 2]), ("before", "1900-01-01")]


_DAY = """day AS (SELECT unnest(['within', 'before']) AS which, unnest([(SELECT first(d) FROM (
  SELECT d FROM (SELECT unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS d FROM events)
  ORDER BY d LIMIT 1 OFFSET (SELECT (date_diff('day', min(CAST(ts AS DATE)), max(CAST(ts AS DATE))) + 1) // 2 FROM events))),
  TIMESTAMP '1900-01-01']) AS d)"""


@query(with_(v.RECORDS_SILVER + ", " + _DAY, """SELECT which, count(device_id) + count(*) FILTER (device_id IS NULL AND ts IS NOT NULL) AS rows_total,
  CASE WHEN count(ts) > 0 THEN count(*) FILTER (ts IS NOT NULL AND power_w IS NULL) END AS null_power,
  CASE WHEN count(ts) > 0 THEN count(*) FILTER (ts IS NOT NULL AND soc_percent IS NULL) END AS null_soc
FROM day LEFT JOIN silver ON event_date = CAST(d AS DATE) GROUP BY which"""))
def sql_null_profile_day(spark, sf_dir):
    """Written readings of a date with rows, and of one without: its sums are NULL."""
    readings = lake.read_silver(spark, _written_lake(spark, sf_dir).silver)
    return reduce(DataFrame.unionByName, [
        checks.null_profile(spark, readings, day).withColumn("which", F.lit(which))
        for which, day in _a_day_and_none(spark, sf_dir)
    ])


@query(with_(v.RECORDS_SILVER + ", " + _DAY, """SELECT event_date, site_id, count(*) AS rows_total FROM silver
WHERE event_date = (SELECT CAST(d AS DATE) FROM day WHERE which = 'within') GROUP BY event_date, site_id"""))
def silver_table_day(spark, sf_dir):
    """A date's readings per site, from the external table."""
    name = f"silver_{uuid.uuid4().hex}"
    lake.silver_table(spark, _written_lake(spark, sf_dir).silver, name)
    (_, day), _ = _a_day_and_none(spark, sf_dir)
    return spark.sql(
        f"SELECT event_date, site_id, count(*) AS rows_total FROM {name} WHERE event_date = :day GROUP BY event_date, site_id",
        args={"day": date.fromisoformat(day)},
    )


@query(with_(v.RECORDS + ", " + _DAY, """SELECT which, count(*) FILTER (soc_percent < 0 OR soc_percent > 100) AS out_of_bounds_soc
FROM day LEFT JOIN delivered ON CAST(try_strptime(ts_utc, '%Y-%m-%dT%H:%M:%SZ') AS DATE) = CAST(d AS DATE) GROUP BY which"""))
def soc_bounds_day(spark, sf_dir):
    """Raw readings of a date: in the written ones nothing is out of bounds."""
    readings = with_event_time(v.records(spark, sf_dir))
    return reduce(DataFrame.unionByName, [
        checks.soc_out_of_bounds(spark, readings, day).withColumn("which", F.lit(which))
        for which, day in _a_day_and_none(spark, sf_dir)
    ])


@query(with_(v.RECORDS + ", " + _DAY, """SELECT device_id, CAST(try_strptime(ts_utc, '%Y-%m-%dT%H:%M:%SZ') AS TIMESTAMP) AS ts, count(*) AS cnt
FROM delivered JOIN day ON CAST(try_strptime(ts_utc, '%Y-%m-%dT%H:%M:%SZ') AS DATE) = CAST(d AS DATE)
GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY cnt DESC, device_id, ts LIMIT 50"""))
def duplicate_keys_day(spark, sf_dir):
    readings = with_event_time(v.records(spark, sf_dir))
    return reduce(DataFrame.unionByName, [
        checks.duplicate_keys(spark, readings, day) for _, day in _a_day_and_none(spark, sf_dir)
    ])


# --- expected samples and derived quantities ---------------------------------------------------


@query("""SELECT s_suppkey AS device_id, sample, make_timestamp(epoch_us(day)
  + CAST(round_even(sample * (86400000000 / 7), 0) AS BIGINT)) AS ts
FROM supplier, (SELECT unnest(range(7)) AS sample),
  (SELECT unnest(generate_series(date_trunc('day', min(ts)), max(ts), INTERVAL 1 DAY)) AS day FROM events)""")
def expected_grid_query(spark, sf_dir):
    """Seven samples a day, so the interval is not a whole number of microseconds."""
    dates = v.all_dates(spark, sf_dir)
    return expected_grid(v.devices(spark, sf_dir).select("device_id"), dates[0], len(dates), 7)


_FRACTION = "((epoch_us(ts) % 86400000000) / 86400000000.0)"


@query(f"""SELECT strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts_utc, device_id, site_id,
  round_even(power_w, 3) AS power_w, round_even(power_w * (86400 / 7.0 / 3600), 6) AS energy_wh,
  round_even(30 + 5 * sin(2 * pi() * fraction), 3) AS temperature_c
FROM (SELECT *, greatest(0, sin(2 * pi() * fraction - pi() / 2)) * greatest(500, s_acctbal * 500) AS power_w
  FROM (SELECT *, {_FRACTION} AS fraction
    FROM (SELECT s_suppkey AS device_id, printf('S%02d', s_suppkey % 5 + 1) AS site_id, s_acctbal,
        make_timestamp(epoch_us(day) + CAST(round_even(sample * (86400000000 / 7), 0) AS BIGINT)) AS ts
      FROM supplier, (SELECT unnest(range(7)) AS sample),
        (SELECT unnest(generate_series(date_trunc('day', min(ts)), max(ts), INTERVAL 1 DAY)) AS day FROM events))))""")
def expected_readings_query(spark, sf_dir):
    dates = v.all_dates(spark, sf_dir)
    devices = v.devices(spark, sf_dir).withColumn(
        "site_id", F.format_string("S%02d", F.col("device_id") % 5 + 1)
    )
    return expected_readings(devices, dates[0], len(dates), 7)


@query(f"SELECT event_id, {_FRACTION} AS day_fraction FROM events")
def day_fraction(spark, sf_dir):
    return v.events(spark, sf_dir).select(
        "event_id", t.day_fraction(F.col("ts")).alias("day_fraction")
    )


@query(f"""SELECT event_id, round(greatest(0, sin(2 * pi() * {_FRACTION} - pi() / 2)), 6) AS diurnal
FROM events""")
def diurnal_curve(spark, sf_dir):
    return v.events(spark, sf_dir).select(
        "event_id", F.round(r.diurnal(t.day_fraction(F.col("ts"))), 6).alias("diurnal")
    )


@query("""SELECT s_suppkey AS device_id, greatest(500, s_acctbal * 500) AS rated_peak_w FROM supplier""")
def rated_peak_power(spark, sf_dir):
    return v.devices(spark, sf_dir).select(
        "device_id", r.rated_peak(F.col("capacity_kwh")).alias("rated_peak_w")
    )


@query(f"""SELECT event_id, round(greatest(0, greatest(0, sin(2 * pi() * {_FRACTION} - pi() / 2))
  * greatest(500, s_acctbal * 500)), 3) AS expected_power_w
FROM events LEFT JOIN supplier ON user_id = s_suppkey""")
def expected_power(spark, sf_dir):
    rows = v.events(spark, sf_dir).select("event_id", "ts", F.col("user_id").alias("device_id"))
    power = r.expected_power(t.day_fraction(F.col("ts")), F.col("capacity_kwh"))
    return enrich_capacity(rows, v.devices(spark, sf_dir)).select(
        "event_id", F.round(power, 3).alias("expected_power_w")
    )


@query(with_(v.TELEMETRY, """SELECT event_id, round(greatest(0, power_w * (3600 / 7.0 / 3600)), 9)
  AS energy_wh FROM telemetry"""))
def interval_energy(spark, sf_dir):
    return v.telemetry(spark, sf_dir).select(
        "event_id", F.round(r.interval_energy(F.col("power_w"), 3600 / 7), 9).alias("energy_wh")
    )


@query("SELECT event_id, greatest(360, least(440, value + 350)) AS voltage_v FROM events")
def clamp_voltage(spark, sf_dir):
    return v.events(spark, sf_dir).select(
        "event_id", r.clamp(F.col("value") + 350, r.VOLTAGE_RANGE).alias("voltage_v")
    )


@query(with_(v.TELEMETRY, """SELECT event_id, CASE WHEN temperature_c > 0
  THEN power_w / temperature_c ELSE 0 END AS current_a FROM telemetry"""))
def derive_current(spark, sf_dir):
    return v.telemetry(spark, sf_dir).select(
        "event_id", r.ratio_or_zero(F.col("power_w"), F.col("temperature_c")).alias("current_a")
    )


@query(f"""SELECT event_id, round(30 + 5 * sin(2 * pi() * {_FRACTION}), 6) AS temperature_c
FROM events""")
def temp_baseline(spark, sf_dir):
    return v.events(spark, sf_dir).select(
        "event_id",
        F.round(r.temperature_baseline(t.day_fraction(F.col("ts"))), 6).alias("temperature_c"),
    )


@query(with_(v.PARSED, """SELECT event_id, device_id, event_date, round(list_reduce(
  list_prepend(50.0::DOUBLE, list(power_w) OVER (PARTITION BY device_id, event_date
    ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
  lambda a, x: greatest(0, least(100, a + x))), 6) AS level
FROM parsed"""))
def bounded_running_sum_query(spark, sf_dir):
    rows = v.parsed(spark, sf_dir).select("event_id", "device_id", "event_date", "ts", "power_w")
    levels = bounded_running_sum(
        rows,
        group=["device_id", "event_date"],
        order=["ts", "event_id"],
        delta="power_w",
        start=50.0,
        bounds=r.SOC_RANGE,
        name="level",
    )
    return levels.select("event_id", "device_id", "event_date", F.round("level", 6).alias("level"))


@query(with_(v.TELEMETRY, """SELECT event_id, CASE WHEN energy_wh >= 0.01 THEN 'OK' ELSE 'FAULT' END
  AS status FROM telemetry"""))
def threshold_status(spark, sf_dir):
    return v.telemetry(spark, sf_dir).select(
        "event_id", r.status_label(F.col("energy_wh")).alias("status")
    )


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts_utc FROM events")
def iso_format(spark, sf_dir):
    return v.events(spark, sf_dir).select("event_id", t.iso_utc(F.col("ts")).alias("ts_utc"))


@query("""SELECT event_id, round_even(value / 7, 3) AS by_three, round_even(value / 7, 6) AS by_six
FROM events""")
def round_fields(spark, sf_dir):
    x = F.col("value") / 7
    return v.events(spark, sf_dir).select(
        "event_id", r.fixed_decimals(x, 3).alias("by_three"), r.fixed_decimals(x, 6).alias("by_six")
    )


@query(with_(v.TELEMETRY, """SELECT event_id, CAST(to_json({ts_utc: ts_utc, device_id: device_id,
  site_id: site_id, power_w: round_even(power_w, 3), status: nullif(status, 'FAULT')}) AS VARCHAR) AS record
FROM telemetry"""))
def to_json_records(spark, sf_dir):
    rows = v.telemetry(spark, sf_dir).withColumns(
        {
            "power_w": r.fixed_decimals(F.col("power_w"), 3),
            "status": F.nullif(F.col("status"), F.lit("FAULT")),
        }
    )
    record = r.as_json("ts_utc", "device_id", "site_id", "power_w", "status")
    return rows.select("event_id", record.alias("record"))


@query("SELECT event_id, strftime(ts, '%Y/%m/%d') AS path FROM events")
def date_path(spark, sf_dir):
    return v.events(spark, sf_dir).select(
        "event_id", t.date_path(F.to_date("ts")).alias("path")
    )


def registered() -> dict[str, tuple[Query, str | None]]:
    """Queries by name; `_query` only keeps a function's name from hiding an imported one."""
    return {name.removesuffix("_query"): entry for name, entry in REGISTRY.items()}
