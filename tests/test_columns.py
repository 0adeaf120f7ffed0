import math
from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings as limits
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattline.functions import readings as r
from wattline.functions import times as t

NAN, INF = float("nan"), float("inf")


def column(spark, values, kind, fn):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"i int, x {kind}")
    return [row.y for row in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


def same(found, wanted):
    return [repr(x) for x in found] == [repr(x) for x in wanted]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_parse_utc(spark, settings, zone):
    settings(spark__sql__session__timeZone=zone)
    texts = ["2025-03-09T02:30:00Z", "2025-03-09T03:30:00Z", "2025-03-09T03:30:00+00:00",
             "2025-03-09T03:30:00", "2025-03-09T03:30:00.5Z", "2025-02-30T00:00:00Z", "bad", "", "Z", None]
    seconds = column(spark, texts, "string", lambda c: F.unix_seconds(t.parse_utc(c)))
    assert seconds == [1741487400, 1741491000] + [None] * 8


PLAIN = ["2025-08-01T00:00:00Z", "0000-01-01T00:00:00Z", "9999-12-31T23:59:59Z", "2024-02-29T12:30:30Z", "1582-10-10T00:00:00Z"]
NONE = ["2023-02-29T00:00:00Z", "2024-01-01T24:00:00Z", "2024-01-01T23:59:60Z", "2024-13-01T00:00:00Z", " 2024-01-01T00:00:00Z",
        "2024-01-01T00:00:00Z\n", "2024-01-01 00:00:00Z", "2024-01-01T00:00Z", "12024-01-01T00:00:00Z", "+2024-01-01T00:00:00Z",
        "\u0662024-01-01T00:00:00Z", "2024-01-01T00:00:00\u017f", "bad 2024-01-01T00:00:00Z"]
OTHER = ["2024-01-01t00:00:00z", "+12024-01-01T00:00:00Z", "-2024-01-01T00:00:00Z"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_parse_utc_reads_what_the_pattern_reads(spark, settings, zone):
    settings(spark__sql__session__timeZone=zone)
    texts = PLAIN + NONE + OTHER
    by_pattern = column(spark, texts, "string", lambda c: F.unix_seconds(F.try_to_timestamp(c, F.lit(t._ISO_OFFSET))))
    assert column(spark, texts, "string", lambda c: F.unix_seconds(t.parse_utc(c))) == by_pattern
    assert [x is None for x in by_pattern] == [False] * len(PLAIN) + [True] * len(NONE) + [False] * len(OTHER)


def test_plain_times_need_no_pattern(spark, monkeypatch):
    seconds = lambda texts: column(spark, texts, "string", lambda c: F.unix_seconds(t.parse_utc(c)))
    wanted = seconds(PLAIN)
    monkeypatch.setattr(t, "_ISO_OFFSET", "'never'")
    assert seconds(PLAIN + OTHER) == wanted + [None] * len(OTHER)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_utc_date(spark, settings, zone):
    settings(spark__sql__session__timeZone=zone)
    texts = ["2025-08-01T00:00:00Z", "2025-07-31T23:59:59Z", "1969-12-31T23:59:59Z", "bad"]
    assert column(spark, texts, "string", lambda c: t.utc_date(t.parse_utc(c))) == [
        date(2025, 8, 1), date(2025, 7, 31), date(1969, 12, 31), None
    ]


def test_time_text(spark):
    at = [datetime(2025, 8, 1, 6, 0, 0, 999999), datetime(1969, 12, 31, 18, 0)]
    assert column(spark, at, "timestamp", t.iso_utc) == ["2025-08-01T06:00:00Z", "1969-12-31T18:00:00Z"]
    assert column(spark, at, "timestamp", lambda c: t.date_path(F.to_date(c))) == ["2025/08/01", "1969/12/31"]
    fractions = column(spark, at, "timestamp", t.day_fraction)
    assert fractions == [pytest.approx(0.25 + 0.999999 / 86400), 0.75]


def test_floor_at_zero(spark):
    found = column(spark, [None, NAN, -0.0, -INF, -5.0, 3.0], "double", r.floor_at_zero)
    assert same(found, [None, NAN, -0.0, 0.0, 0.0, 3.0])


def test_null_outside(spark):
    values = [None, NAN, INF, -INF, 0.0, -0.0, 100.0, 100.1, -0.1]
    found = column(spark, values, "double", lambda c: r.null_outside(c, r.SOC_RANGE))
    assert same(found, [None, None, None, None, 0.0, -0.0, 100.0, None, None])
    values = [-20.0, 80.0, -20.1, 80.1]
    found = column(spark, values, "double", lambda c: r.null_outside(c, r.TEMPERATURE_RANGE))
    assert found == [-20.0, 80.0, None, None]


def test_clamp(spark):
    found = column(spark, [None, 1.0, 400.0, 999.0], "double", lambda c: r.clamp(c, r.VOLTAGE_RANGE))
    assert found == [None, 360.0, 400.0, 440.0]


def test_ratio_or_zero(spark):
    ratio = lambda c: r.ratio_or_zero(F.lit(10.0), c)
    assert column(spark, [4.0, 0.0, -1.0, None], "double", ratio) == [2.5, 0.0, 0.0, 0.0]


def test_expected_curves(spark):
    fractions = [0.0, 0.25, 0.5, 0.75]
    approx = lambda xs: [pytest.approx(x, abs=1e-9) for x in xs]
    assert column(spark, fractions, "double", r.diurnal) == approx([0, 0, 1, 0])
    assert column(spark, fractions, "double", r.temperature_baseline) == approx([30, 35, 30, 25])
    power = lambda c: r.expected_power(c, F.lit(200.0))
    assert column(spark, fractions, "double", power) == approx([0, 0, 100000, 0])
    assert column(spark, [0.1, 2.0, None], "double", r.rated_peak) == [500.0, 1000.0, 500.0]
    energy = lambda c: r.interval_energy(c, 60.0)
    assert column(spark, [120.0, -1.0, None], "double", energy) == [2.0, 0.0, None]
    assert column(spark, [0.01, 0.0099, 1.0], "double", r.status_label) == ["OK", "FAULT", "OK"]


def test_json_keeps_null_fields(spark):
    df = spark.createDataFrame([("D1", None, 0.5)], "device_id string, status string, power_w double")
    text = df.select(r.as_json("device_id", "status", "power_w").alias("x")).first().x
    assert text == '{"device_id":"D1","status":null,"power_w":0.5}'


@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=20))
@limits(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
def test_fixed_decimals_is_close_to_the_value(spark, values):
    for x, y in zip(values, column(spark, values, "double", lambda c: r.fixed_decimals(c, 3))):
        assert math.isclose(x, y, rel_tol=1e-6, abs_tol=0.000500001)
