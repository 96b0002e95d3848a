"""Value normalisation expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_or_zero(c) -> tuple[Column, Column]:
    """Text → INT with "missing means zero" semantics.

    NULL or the empty string give 0; surrounding blanks are ignored; anything
    else that is not an integer gives NULL and sets the returned ``bad`` flag
    (instead of failing the job or silently becoming 0).
    """
    c = F.col(c) if isinstance(c, str) else c
    parsed = F.trim(c).try_cast("int")
    empty = c.isNull() | (c == F.lit(""))
    value = F.when(empty, F.lit(0)).otherwise(parsed)
    bad = ~empty & parsed.isNull()
    return value, bad
