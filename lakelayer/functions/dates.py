"""Date and time column functions.

Times are carried as ``timestamp_ntz`` (wall-clock time without a zone) so that
results do not depend on the session time zone; text forms are the warehouse's
``yyyy-MM-dd HH:mm:ss``. Epoch conversions take an explicit offset or
zone, never the machine's.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TIME_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}( [0-9]{2}:[0-9]{2}:[0-9]{2})?$"
_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_time(col) -> Column:
    """Text -> timestamp_ntz. Accepts date-time or date only; NULL for unreadable text.

    The text becomes a wall-clock time directly, never an instant, so hours that a session zone
    skips or repeats come out as written.
    """
    c = _c(col)
    return F.when(c.rlike(_TIME_TEXT), c.try_cast("timestamp_ntz"))


def time_text(col) -> Column:
    """Wall-clock time -> text, to the second. (``date_format`` would go through an instant.)"""
    return F.substring(_c(col).cast("timestamp_ntz").cast("string"), 1, 19)


def date_text(col) -> Column:
    """Date or wall-clock time -> ``yyyy-MM-dd``."""
    return _c(col).cast("date").cast("string")


def elapsed(a, b) -> Column:
    """Seconds (with fraction, as a decimal) from wall-clock time ``a`` to ``b``.

    A difference of two timestamp_ntz needs no zone; ``timestamp_diff`` would take instants.
    """
    return (_c(b) - _c(a)).cast("interval second").cast("decimal(20,6)")


def add_seconds(col, seconds) -> Column:
    s = F.lit(seconds) if isinstance(seconds, int) else _c(seconds)
    return F.timestamp_add("SECOND", s, _c(col))


def epoch_ms_of_wallclock(col, offset: str = "+00:00") -> Column:
    """Epoch milliseconds of a wall-clock time read at a fixed UTC offset.

    ``offset`` like ``+08:00``; the warehouse converts text times at +08:00.
    """
    c = _c(col)
    sign = -1 if offset.startswith("-") else 1
    hh, mm = offset.lstrip("+-").split(":")
    shift_ms = sign * (int(hh) * 3600 + int(mm) * 60) * 1000
    return F.floor(elapsed(F.expr(_EPOCH_NTZ), c) * 1000).cast("bigint") - F.lit(shift_ms)


def epoch_ms(col, offset: str = "+08:00") -> Column:
    """Text time -> epoch milliseconds at a fixed offset."""
    return epoch_ms_of_wallclock(parse_time(col), offset)


def wallclock_of_epoch_ms(col, zone: str = "UTC") -> Column:
    """Epoch milliseconds -> wall-clock timestamp_ntz in ``zone``."""
    utc_wall = F.timestamp_add("MILLISECOND", _c(col), F.expr(_EPOCH_NTZ))
    if zone in ("UTC", "Z", "+00:00", "Etc/UTC"):
        return utc_wall
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall)


def seconds_between(a, b) -> Column:
    """Whole seconds from text time ``a`` to text time ``b``."""
    return elapsed(parse_time(a), parse_time(b)).cast("bigint")


def stamp(at=None) -> Column:
    """'Now' as text (B16); pass ``at`` where results must repeat."""
    if at is None:
        base = F.localtimestamp()  # the session zone's wall clock
    elif isinstance(at, str):
        base = parse_time(F.lit(at))
    else:
        base = at
    return time_text(base)


def is_blank(col) -> Column:
    """NULL or empty text."""
    c = _c(col)
    return c.isNull() | (c == F.lit(""))


def calendar_columns(ts_col, date_name: str = "create_date", hour_name: str = "create_hour"):
    """(date text, hour text without padding) of a timestamp."""
    c = _c(ts_col)
    return [
        date_text(c).alias(date_name),
        F.hour(c).cast("string").alias(hour_name),
    ]


def event_time(col) -> Column:
    """Wall-clock timestamp_ntz (read as UTC) -> instant, for watermarks and event-time windows.

    Streaming watermarks need a TIMESTAMP (instant); going through epoch
    microseconds keeps the result independent of the session time zone.
    """
    return F.timestamp_micros((elapsed(F.expr(_EPOCH_NTZ), col) * 1000000).cast("bigint"))


def utc_wallclock(col) -> Column:
    """Instant -> its UTC wall-clock time as timestamp_ntz (inverse of ``event_time``)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(col)), F.expr(_EPOCH_NTZ))
