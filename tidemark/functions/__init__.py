from .time import (ISO_INSTANT_PATTERN, WALL_PATTERN, ZONED_PATTERN, from_iso_instant, iso_instant,
                   parse_instant, parse_time, parse_wall, to_ltz, to_ntz)
from .values import int_or_zero

__all__ = ["ZONED_PATTERN", "WALL_PATTERN", "ISO_INSTANT_PATTERN", "parse_instant", "parse_wall",
           "parse_time", "iso_instant", "from_iso_instant", "to_ntz", "to_ltz", "int_or_zero"]
