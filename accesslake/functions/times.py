"""The two clocks of a log record.

``log_instant`` is the moment in time, used for ordering, min/max and watermarks. ``log_wall_clock``
is the time as written, used for calendar dates and years. Neither depends on the session time zone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the time format of both log formats, after clean-up.
LOG_TIME_FORMAT = "d/MMM/yyyy HH:mm:ss Z"


def clean_log_date(c: Column) -> Column:
    """``08/Apr/2018:01:02:03 +0200] junk`` -> ``08/Apr/2018 01:02:03 +0200``."""
    colon = F.locate(":", c)
    spaced = F.when(colon > 0, F.overlay(c, F.lit(" "), colon, F.lit(1))).otherwise(c)
    return F.when(F.locate("]", c) > 1, F.substring_index(spaced, "]", 1)).otherwise(spaced)


def with_offset(cleaned: Column) -> Column:
    """A cleaned date with its offset; UTC where it has none."""
    signed = F.substring(cleaned, -5, 1).isin("+", "-")
    return F.when(signed, cleaned).otherwise(F.concat(cleaned, F.lit(" +0000")))


def log_instant(zoned: Column) -> Column:
    """Instant of a date that ends in an offset; NULL when it is no date."""
    return F.try_to_timestamp(zoned, F.lit(LOG_TIME_FORMAT))


def log_wall_clock(zoned: Column, instant: Column) -> Column:
    """Zone-less time as written: the instant, moved by the offset the date ends in."""
    sign = F.when(F.substring(zoned, -5, 1) == "-", F.lit(-60)).otherwise(F.lit(60))
    minutes = F.substring(zoned, -4, 2).try_cast("int") * 60 + F.substring(zoned, -2, 2).try_cast("int")
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", F.unix_seconds(instant) + sign * minutes, epoch)


# Month names, and the shapes of dates that are read besides that of the logs.
MONTH_NAMES = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_MONTH = f"({'|'.join(MONTH_NAMES)})[a-z]*"
_DAY, _YEAR = r"(\d{1,2})(?:st|nd|rd|th)?", r"(\d{4}|\d{2})"
_WEEKDAY = r"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+)?"
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,6})\d*)?)?\s*([ap]m)?"
_ZONE = r"\s*(z|utc|gmt|[+-]\d{2}(?::?\d{2})?)?"
_TAIL = rf"(?:(?:t|,?\s+(?:at\s+)?|:){_CLOCK}{_ZONE})?"
_PARTS = ("year", "month", "day", "hour", "minute", "second", "fraction", "half", "zone")
_CLOCK_PARTS = ("hour", "minute", "second", "fraction", "half")
#: Anchored patterns with the order of their groups; the first that fits decides.
DATE_SHAPES = (
    (rf"{_WEEKDAY}{_DAY}[\s/.-]*{_MONTH}[\s/.,-]*{_YEAR}{_TAIL}", ("day", "month", "year", *_CLOCK_PARTS, "zone")),
    (rf"{_WEEKDAY}{_MONTH}\.?\s+{_DAY},?\s+{_CLOCK}\s+(\d{{4}}){_ZONE}", ("month", "day", *_CLOCK_PARTS, "year", "zone")),
    (rf"{_WEEKDAY}{_MONTH}\.?\s+{_DAY},?\s+(\d{{4}}){_TAIL}", ("month", "day", "year", *_CLOCK_PARTS, "zone")),
    (rf"(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}}){_TAIL}", ("year", "month", "day", *_CLOCK_PARTS, "zone")),
    (rf"(\d{{4}})[-/.]?{_MONTH}[-/.]?(\d{{1,2}}){_TAIL}", ("year", "month", "day", *_CLOCK_PARTS, "zone")),
    (rf"(\d{{4}})(\d{{2}})(\d{{2}})(?:t?\s*(\d{{2}})(\d{{2}})(\d{{2}})?{_ZONE})?", ("year", "month", "day", "hour", "minute", "second", "zone")),
    (rf"(\d{{1,2}})[-/.](\d{{1,2}})[-/.]{_YEAR}{_TAIL}", ("month", "day", "year", *_CLOCK_PARTS, "zone")),
)


def lenient_parts(date: Column) -> Column:
    """Struct of the parts of a date of any of the shapes, as text; NULL where none fits."""
    bare = F.lower(F.trim(date))
    out = F.lit(None)
    for pattern, order in reversed(DATE_SHAPES):
        whole = rf"^{pattern}$"
        assert re.compile(whole).groups == len(order)
        groups = {name: F.regexp_extract(bare, whole, i + 1) for i, name in enumerate(order)}
        out = F.when(bare.rlike(whole), F.struct(*[groups.get(p, F.lit("")).alias(p) for p in _PARTS])).otherwise(out)
    return out


def _number(text: Column, default: int) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")).try_cast("int"), F.lit(default))


def lenient_wall_clock(parts: Column) -> Column:
    """Zone-less time of the parts of a date; NULL where they name no day or time.

    Years of two digits are 1969 to 2068. Of two numbers for day and month the first is the month, unless only the
    second can be. A time that is not given is midnight.
    """
    year = _number(parts["year"], 0)
    year = F.when(F.length(parts["year"]) == 2, F.when(year < 69, year + 2000).otherwise(year + 1900)).otherwise(year)
    names = F.array_position(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.substring(parts["month"], 1, 3)).cast("int")
    month, day = F.when(names > 0, names).otherwise(_number(parts["month"], 0)), _number(parts["day"], 0)
    swapped = (month > 12) & (day <= 12)
    hour, half = _number(parts["hour"], 0), parts["half"]
    hour = F.when((half != "") & ~hour.between(1, 12), F.lit(None)).when(half == "pm", hour % 12 + 12).when(half == "am", hour % 12).otherwise(hour)
    second = F.concat(F.lpad(F.when(parts["second"] == "", "0").otherwise(parts["second"]), 2, "0"), F.lit("."), F.rpad(parts["fraction"], 6, "0"))
    return F.try_make_timestamp_ntz(
        year, F.when(swapped, day).otherwise(month), F.when(swapped, month).otherwise(day), hour, _number(parts["minute"], 0), second.try_cast("decimal(8,6)")
    )


def lenient_instant(parts: Column, wall: Column) -> Column:
    """Instant of a date of ``lenient_parts`` with that wall clock; UTC where it names no zone."""
    zone = parts["zone"]
    digits = F.rpad(F.replace(F.substring(zone, 2, 6), F.lit(":"), F.lit("")), 4, "0")
    minutes = digits.substr(1, 2).try_cast("int") * 60 + digits.substr(3, 2).try_cast("int")
    offset = F.when(F.substring(zone, 1, 1) == "-", -minutes).when(F.substring(zone, 1, 1) == "+", minutes).otherwise(F.lit(0))
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, wall)
    return F.timestamp_micros(micros - offset.cast("bigint") * 60_000_000)
