"""Column expressions for what people read, and bounds of times and texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Lengths to which errors and log ends are cut.
ERROR_LENGTH, LOG_LENGTH = 2000, 2000


def gigabytes(c: Column, unit: float = 1e9) -> Column:
    """Bytes as decimal gigabytes, two places; ``unit`` is 1024**3 for binary ones."""
    return F.round(c / F.lit(unit), 2)


def size_text(c: Column) -> Column:
    """Bytes in the largest unit that they reach, one place from kilobytes on."""
    mb, kb = c / F.lit(1024.0 * 1024), c / F.lit(1024.0)
    return F.when(c >= 1024 * 1024, F.format_string("%.1f MB", mb)).when(c >= 1024, F.format_string("%.1f KB", kb)).otherwise(F.format_string("%d B", c.cast("bigint")))


def duration_text(seconds: Column) -> Column:
    """Seconds as hours and minutes, minutes and seconds, or seconds."""
    s = seconds.cast("bigint")
    h, m = F.floor(s / 3600), F.floor(s % 3600 / 60)
    return F.when(s >= 3600, F.format_string("%dh %dm", h, m)).when(s >= 60, F.format_string("%dm %ds", m, s % 60)).otherwise(F.format_string("%ds", s))


def percent(done: Column, total: Column) -> Column:
    """Whole per cent, 0 where nothing is to be done, within 0 and 100."""
    return F.when(total > 0, F.least(F.lit(100), F.greatest(F.lit(0), F.floor(100.0 * done / total + 0.5)))).otherwise(0).cast("bigint")


def html_safe(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def extent(box: Column) -> tuple[Column, Column]:
    """Width and height of a box, never below 0."""
    return F.greatest(F.lit(0.0), box[2] - box[0]), F.greatest(F.lit(0.0), box[3] - box[1])


def backoff(base: Column, attempts: Column, jitter: Column) -> Column:
    """Seconds until the next attempt: ``base``, doubled with each attempt after the first, and ``jitter``."""
    return base * F.pow(F.lit(2.0), attempts - 1) + jitter


def cut(c: Column, length: int = ERROR_LENGTH) -> Column:
    return F.left(c, F.lit(length))


def cut_log(c: Column, length: int = LOG_LENGTH) -> Column:
    """The end of a log."""
    return F.right(c, F.lit(length))


def inside(path: Column) -> Column:
    """Whether a path is relative and never leads out of its folder."""
    return ~path.startswith("/") & ~F.array_contains(F.split(path, "/"), "..")
