"""Column functions for cleaning readings and deriving physical quantities.

All of them are built-in Spark expressions, so they stay inside generated code.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted ranges of a reading (both ends belong to the range).
SOC_RANGE = (0.0, 100.0)
TEMPERATURE_RANGE = (-20.0, 80.0)
VOLTAGE_RANGE = (360.0, 440.0)
# The noise-free daily curves.
MIN_PEAK_W = 500.0
PEAK_W_PER_KWH = 500.0
TEMPERATURE_MEAN_C = 30.0
TEMPERATURE_SWING_C = 5.0
FAULT_BELOW = 0.01


def floor_at_zero(x: Column) -> Column:
    """Negative readings become 0.0; NULL and NaN stay as they are (`greatest` would replace NULL)."""
    return F.when(x < 0, 0.0).otherwise(x)


def null_outside(x: Column, bounds: tuple[float, float]) -> Column:
    """NULL for a reading outside the closed range, NaN included (it sorts above every number)."""
    return F.when(x.between(*bounds), x)


def clamp(x: Column, bounds: tuple[float, float]) -> Column:
    """Nearest value inside the closed range; NULL stays NULL."""
    low, high = bounds
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Quotient where the denominator is positive, else 0.0."""
    return F.when(denominator > 0, numerator / denominator).otherwise(0.0)


def diurnal(fraction: Column) -> Column:
    """Half-sine over the day: 0 at night, 1 at noon."""
    return F.greatest(F.lit(0.0), F.sin(fraction * (2 * math.pi) - math.pi / 2))


def rated_peak(capacity_kwh: Column) -> Column:
    """Highest power in watts that a battery of this capacity is expected to give."""
    return F.greatest(F.lit(MIN_PEAK_W), capacity_kwh * PEAK_W_PER_KWH)


def expected_power(fraction: Column, capacity_kwh: Column) -> Column:
    """Power in watts expected at this time of day."""
    return F.greatest(F.lit(0.0), diurnal(fraction) * rated_peak(capacity_kwh))


def interval_energy(power_w: Column, seconds: float) -> Column:
    """Watt-hours of one sampling interval, never negative."""
    return floor_at_zero(power_w * (seconds / 3600.0))


def temperature_baseline(fraction: Column) -> Column:
    """Temperature expected at this time of day."""
    return F.sin(fraction * (2 * math.pi)) * TEMPERATURE_SWING_C + TEMPERATURE_MEAN_C


def status_label(health: Column) -> Column:
    """`OK` from the threshold upwards, else `FAULT`."""
    return F.when(health >= FAULT_BELOW, "OK").otherwise("FAULT")


def fixed_decimals(x: Column, digits: int) -> Column:
    """Half-to-even rounding."""
    return F.bround(x, digits)


def as_json(*columns: str) -> Column:
    """One JSON object per row; NULL fields are written, not left out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
