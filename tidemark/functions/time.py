"""Time parsing and formatting as Column expressions (JVM side, no UDFs).

Two clocks exist in the data model:

* ``instant`` — the zoned text is parsed with its offset and the result is the
  UTC instant (speed layer);
* ``wall`` — only the first 19 characters are parsed and the offset is
  dropped, i.e. the writer's wall clock read as UTC (batch layer).

Unparseable text gives NULL in both (``try_to_timestamp``), never an error,
whatever ``spark.sql.ansi.enabled`` says.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: text formats ---------------------------------------------
ZONED_PATTERN = "yyyy-MM-dd HH:mm:ss Z"       # e.g. 2015-02-24 11:35:52 -0800
WALL_PATTERN = "yyyy-MM-dd HH:mm:ss"          # first 19 characters of the above
ISO_INSTANT_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'Z'"  # e.g. 2015-02-24T19:35:00Z
# ----------------------------------------------------------------------------

TIME_MODES = ("wall", "instant")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_instant(c) -> Column:
    """Zoned text → TIMESTAMP (UTC instant); NULL when unparseable."""
    return F.try_to_timestamp(_c(c), F.lit(ZONED_PATTERN))


def parse_wall(c) -> Column:
    """First 19 characters → TIMESTAMP of the wall clock (offset ignored)."""
    return F.try_to_timestamp(F.substring(_c(c), 1, 19), F.lit(WALL_PATTERN))


def parse_time(c, mode: str) -> Column:
    if mode == "instant":
        return parse_instant(c)
    if mode == "wall":
        return parse_wall(c)
    raise ValueError(f"time mode must be one of {TIME_MODES}, got {mode!r}")


def iso_instant(c) -> Column:
    """TIMESTAMP → ``yyyy-MM-ddTHH:mm:ssZ`` text (session zone is UTC)."""
    return F.date_format(_c(c), ISO_INSTANT_PATTERN)


def from_iso_instant(c) -> Column:
    """``…T…Z`` text → TIMESTAMP_NTZ in UTC, NULL when unparseable."""
    return F.try_to_timestamp(_c(c), F.lit(ISO_INSTANT_PATTERN)).cast("timestamp_ntz")


def time_text(t) -> str:
    """``yyyy-MM-dd HH:mm:ss[.ffffff]`` of a naive datetime (or of such text).

    A datetime handed to ``lit`` passes through the Python process's time zone;
    its text does not."""
    return t.isoformat(sep=" ") if hasattr(t, "isoformat") else str(t)


def ntz_lit(t) -> Column:
    """A wall-clock datetime or text as a TIMESTAMP_NTZ literal."""
    return F.lit(time_text(t)).cast("timestamp_ntz")


def ltz_lit(t) -> Column:
    """A datetime or text as a TIMESTAMP literal: read in the session's zone, or,
    for a datetime with a zone, that instant."""
    return F.lit(time_text(t)).cast("timestamp")


def to_ntz(c) -> Column:
    """TIMESTAMP → TIMESTAMP_NTZ holding the UTC wall clock (table edge type)."""
    return _c(c).cast("timestamp_ntz")


def to_ltz(c) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) → TIMESTAMP, e.g. before a watermark."""
    return _c(c).cast("timestamp")
