"""Column functions for time: none of them depends on the session's time zone unless it says so."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text form of a reading's time, whole seconds and a closing Z.
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss'Z'"
_ISO_OFFSET = "yyyy-MM-dd'T'HH:mm:ssXXX"
# The agreed form with four digits of the year, which a cast reads as the pattern does.
_PLAIN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z\z"
# All that the pattern can read, and more: letters in either case, signs and longer years.
_READABLE = r"^[+-]?[0-9]{4,}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}:[0-9]{2}[Zz]\z"
_DAY_SECONDS = 86_400


def parse_utc(text: Column) -> Column:
    """`2025-08-01T00:00:00Z` to an instant; any other text to NULL, never an error.

    The zone is read from the text, so two texts never become one instant in a session whose
    zone has a daylight-saving gap. Texts with a numeric offset are refused. The pattern is slow, and
    slower where it fails, so it sees only texts that a cast doesn't read and that it may.
    """
    text = text.cast("string")
    by_pattern = F.when(text.rlike(_READABLE), F.try_to_timestamp(text, F.lit(_ISO_OFFSET)))
    return F.when(text.rlike(_PLAIN), text.try_cast("timestamp")).otherwise(by_pattern)


def utc_date(ts: Column) -> Column:
    """UTC calendar date of an instant."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / _DAY_SECONDS).cast("int"))


def iso_utc(ts: Column) -> Column:
    """Text of an instant, fractions of a second cut off. Needs a UTC session."""
    return F.date_format(ts, ISO_UTC)


def date_path(day: Column) -> Column:
    """`2025/08/01`, the folder of a day."""
    return F.date_format(day, "yyyy/MM/dd")


def day_fraction(ts: Column) -> Column:
    """Share of the UTC day that has passed, in [0, 1)."""
    day_micros = F.lit(_DAY_SECONDS * 1_000_000)
    return F.pmod(F.unix_micros(ts), day_micros) / F.lit(_DAY_SECONDS * 1e6)
