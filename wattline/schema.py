"""Declared schemas. Readers always pass one of these, so nothing is inferred from data or paths."""

from __future__ import annotations

# Field names, order and types of the stored records.
TELEMETRY = (
    "ts_utc string, device_id string, site_id string, power_w double, energy_wh double, "
    "voltage_v double, current_a double, temperature_c double, soc_percent double, status string"
)
SILVER = (
    "device_id string, ts_utc string, power_w double, energy_wh double, voltage_v double, "
    "current_a double, temperature_c double, soc_percent double, status string, ts timestamp, "
    "capacity_kwh double, event_date date, site_id string"
)
GOLD = (
    "energy_wh_total double, peak_power_w double, avg_temp_c double, uptime_percent double, "
    "anomaly_count bigint, event_date date, site_id string"
)
STATES = (
    "energy_wh double, peak_power_w double, temperature_sum double, temperature_rows bigint, "
    "healthy_rows bigint, anomaly_count bigint, all_rows bigint, site_id string, event_date date"
)
QUALITY = (
    "process_date string, rows_total bigint, duplicate_keys bigint, null_power bigint, null_soc bigint"
)

KEY = ("device_id", "ts")
SITE_DAY = ("event_date", "site_id")


def names(ddl: str) -> list[str]:
    """Column names of one of the flat schemas above."""
    return [field.split()[0] for field in ddl.split(", ")]
