"""Access-log column expressions.

The line pattern is written from the definition of the common log format: host, identity,
user, bracketed time, quoted request, status and size, one space between them.  It is
anchored at the line's start and each part may be missing with all that follow, so a line
that breaks off keeps the fields before the break.  It is matched once per line.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LINE_RE = r'^(\S+) (?:\S+ \S+(?: \[([^\]]*)\](?: "(.*)"(?: (\S+)(?: (\S+))?)?)?)?)?.*$'
_SEP = "\x1f"
CLF_TIME_SHAPE = r"^\d\d/[A-Za-z]{3}/\d{4}:\d\d:\d\d:\d\d"

# English month abbreviations of the log format, in calendar order.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def line_parts(line: Column) -> Column:
    """Array of host, time, request, status, size as text; '' where missing; one element if nothing matches."""
    return F.split(F.regexp_replace(line, LINE_RE, _SEP.join(f"${i}" for i in range(1, 6))), _SEP)


def part(parts: Column, n: int) -> Column:
    """Field ``n`` (from 1) of ``line_parts``, null when missing."""
    return F.when(F.size(parts) == 5, F.nullif(F.element_at(parts, n), F.lit("")))


def request_path(request: Column) -> Column:
    """The path of a request of three words: method, path, protocol (HTTP...)."""
    words = F.split(request, " ")
    return F.when((F.size(words) == 3) & F.try_element_at(words, F.lit(3)).startswith("HTTP"),
                  F.nullif(F.try_element_at(words, F.lit(2)), F.lit("")))


def clf_time(text: Column) -> Column:
    """X9: 'dd/MMM/yyyy:HH:mm:ss' to a wall-clock timestamp (timestamp_ntz).

    The zone offset is ignored, as in the reference.  Parts are assembled with
    ``try_make_timestamp_ntz``, so an impossible date or time, or an unknown
    month, gives null, and the result does not depend on the session time zone.
    """
    t = F.substring(text, 1, 20)
    part = lambda start, n: F.substring(t, start, n).try_cast("int")
    month = F.nullif(F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.substring(t, 4, 3)), F.lit(0))
    ts = F.try_make_timestamp_ntz(part(8, 4), month.cast("int"), part(1, 2), part(13, 2), part(16, 2), part(19, 2))
    return F.when(t.rlike(CLF_TIME_SHAPE), ts)
