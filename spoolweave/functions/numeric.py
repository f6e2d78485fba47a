"""Time text, clamping and proportional time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(c: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), c))


def parse_time(c: Column) -> Column:
    """Seconds of HH:MM:SS,mmm (a comma or a dot before the milliseconds)."""
    p = F.split(F.replace(c, F.lit(","), F.lit(".")), ":")
    return p[0].cast("int") * 3600 + p[1].cast("int") * 60 + p[2].cast("double")


def format_time(c: Column) -> Column:
    """HH:MM:SS,mmm, milliseconds rounded half to even; below zero counts as zero."""
    sec = F.greatest(c, F.lit(0.0))
    whole = F.floor(sec).cast("bigint")
    ms = whole * 1000 + F.bround((sec - whole) * 1000).cast("bigint")
    part = lambda div, mod: F.floor(ms / div).cast("bigint") % mod
    return F.format_string("%02d:%02d:%02d,%03d", part(3_600_000, 1 << 40), part(60_000, 60), part(1000, 60), ms % 1000)


def proportional_time(start: Column, end: Column, first: Column, last: Column, total: Column) -> Column:
    """Struct of start and end of characters [first, last) of a text spread evenly over an interval."""
    duration = F.greatest(end - start, F.lit(0.01))
    a = F.when(total <= 0, start).otherwise(start + duration * (first / total))
    b = F.when(total <= 0, end).otherwise(F.greatest(start + duration * (last / total), a + 0.01))
    return F.struct(a.alias("start_sec"), b.alias("end_sec"))
