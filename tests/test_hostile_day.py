"""A day of records that reach every rule: malformed, repeated, out of range, off date."""

import math
from datetime import date

import pytest

from wattline.plans.daily import RunOptions, prepared_readings, run_day
from wattline.sources import lake
from wattline.sources.bronze import read_raw_day

DAY = "2025-08-01"


@pytest.fixture
def hostile(raw):
    d = lambda clock, device, site, **f: raw.reading(DAY, clock, device, site, **f)
    raw.lines(
        DAY, "S", "one",
        d("00:00:00", "D1", "01", power_w=100.0, energy_wh=10.0, temperature_c=25.0, soc_percent=50.0, status="OK"),
        d("00:00:00", "D1", "01", power_w=90.0, energy_wh=11.0, temperature_c=25.0, soc_percent=50.0, status="OK"),
        d("00:01:00", "D1", "01", power_w=-5, energy_wh=1.0, temperature_c=-20.0, soc_percent=0, status="OK"),
        d("00:02:00", "D1", "01", power_w=None, energy_wh=None, temperature_c=-20.1, soc_percent=100.1, status="FAULT"),
        d("00:00:00", "D2", "02", power_w="12.5", energy_wh=2.0, temperature_c=80.0, soc_percent=100.0, status=None),
        '{"ts_utc":"2025-08-01T00:01:00Z","device_id":"D2","site_id":"02","power_w":NaN,"energy_wh":3.0,'
        '"temperature_c":"NaN","soc_percent":NaN,"status":"ok","extra":1}',
    )
    raw.lines(
        DAY, "T", "two",
        d("00:00:00", "D4", "02", power_w=7, energy_wh=4.0, temperature_c=81, soc_percent=-0.1, status="OK"),
        "not json",
        "",
        {"ts_utc": "bad", "device_id": "D1", "site_id": "01", "power_w": 1.0, "status": "OK"},
        {"device_id": "D1", "site_id": "01", "power_w": 1.0, "status": "OK"},
        raw.reading("2025-07-31", "23:59:59", "D4", "01", power_w=1.0, energy_wh=9.0, temperature_c=20.0,
                    soc_percent=10.0, status="OK"),
        {"ts_utc": "2025-08-01T00:00:00Z", "device_id": "D5", "power_w": 2.0, "energy_wh": 5.0,
         "temperature_c": 20.0, "soc_percent": 20.0, "status": "OK"},
        {"ts_utc": "2025-08-01T00:03:00.5Z", "device_id": "D1", "site_id": "01", "power_w": 1.0, "status": "OK"},
    )
    return raw.paths


GOLD = {
    (date(2025, 7, 31), "01"): (9.0, 1.0, 20.0, 100.0, 0),
    (date(2025, 8, 1), None): (5.0, 2.0, 20.0, 100.0, 0),
    (date(2025, 8, 1), "01"): (12.0, 90.0, 2.5, 66.66666666666666, 1),
    (date(2025, 8, 1), "02"): (9.0, "NaN", 80.0, 33.33333333333333, 1),
}


def figures(df):
    found = {}
    for r in df.collect():
        peak = "NaN" if math.isnan(r.peak_power_w) else r.peak_power_w
        found[r.event_date, r.site_id] = (
            r.energy_wh_total, peak, r.avg_temp_c, r.uptime_percent, r.anomaly_count
        )
    return found


def test_off_date_rows_overwrite(spark, hostile):
    quality = run_day(spark, hostile, DAY, RunOptions(off_date="overwrite")).collect()
    assert [tuple(r) for r in quality] == [(DAY, 13, 3, 2, 3)]
    assert figures(lake.read_gold(spark, hostile.gold)) == GOLD
    silver = lake.read_silver(spark, hostile.silver)
    assert silver.count() == 8
    assert {(r.device_id, r.capacity_kwh) for r in silver.collect()} == {
        ("D1", 200.0), ("D2", None), ("D4", None), ("D5", None)
    }


def test_off_date_rows_kept_apart(spark, hostile):
    run_day(spark, hostile, DAY)
    assert figures(lake.read_gold(spark, hostile.gold)) == {
        k: f for k, f in GOLD.items() if k[0] == date(2025, 8, 1)
    }
    assert lake.read_silver(spark, hostile.silver).count() == 7
    late = spark.read.parquet(hostile.late).collect()
    assert [(r.device_id, str(r.event_date), str(r.process_date)) for r in late] == [
        ("D4", "2025-07-31", DAY)
    ]
    assert [tuple(r) for r in lake.read_quality(spark, hostile.metrics).collect()] == [
        (DAY, 13, 3, 2, 3)
    ]


def test_record_rules(spark, hostile):
    raw_rows = read_raw_day(spark, hostile.raw, DAY)
    assert raw_rows.count() == 13
    assert raw_rows.where("coalesce(ts_utc, device_id, site_id, status) IS NULL").count() == 1
    quoted = raw_rows.where("energy_wh = 2.0").first()
    assert quoted.power_w is None and quoted.soc_percent == 100.0
    prepared = prepared_readings(raw_rows)
    by_key = {(r.device_id, str(r.ts)): r for r in prepared.collect()}
    assert len(by_key) == 10
    survivor = by_key["D1", "2025-08-01 00:00:00"]
    assert (survivor.power_w, survivor.copies) == (90.0, 2)
    assert by_key["D1", "None"].copies == 3
    edge = by_key["D1", "2025-08-01 00:01:00"]
    assert (edge.power_w, edge.temperature_c, edge.soc_percent) == (0.0, -20.0, 0.0)
    not_a_number = by_key["D2", "2025-08-01 00:01:00"]
    assert math.isnan(not_a_number.power_w)
    assert not_a_number.temperature_c is None and not_a_number.soc_percent is None


def test_numbers_and_objects_in_text_fields_keep_their_json_text(spark, raw):
    raw.lines(DAY, "S", "d", '{"ts_utc":7,"device_id":{"a":1},"power_w":true,"energy_wh":1.5}')
    row = read_raw_day(spark, raw.paths.raw, DAY).first()
    assert (row.ts_utc, row.device_id, row.power_w, row.energy_wh) == ("7", '{"a":1}', None, 1.5)
