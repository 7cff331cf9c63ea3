"""Date and time strings to structs, and the labels of the flight structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.fixed_values import (
    DATE_LABEL_FORMAT, DATE_PART_SEPARATOR as _NON_DIGITS, DATE_TIME_SEPARATOR, WEEKDAYS,
)
from tessera.functions.strings import as_col, java_split


def _ints(parts: Column, n: int) -> list[Column]:
    return [F.get(parts, i).try_cast("int") for i in range(n)]


def _all_ok(vals) -> Column:
    ok = F.lit(True)
    for v in vals:
        ok = ok & v.isNotNull()
    return ok


def parse_ymd(c) -> Column:
    """``MM/DD/YYYY`` (any non-digit delimiter) -> struct(year, month, day), else null."""
    parts = java_split(as_col(c), _NON_DIGITS)
    m, d, y = _ints(parts, 3)
    return F.when((F.size(parts) == 3) & _all_ok([m, d, y]),
                  F.struct(y.alias("year"), m.alias("month"), d.alias("day")))


def parse_hms(c) -> Column:
    """``HH:MM[:SS]`` -> struct(hour, minute, second); seconds default to 0."""
    parts = java_split(as_col(c), _NON_DIGITS)
    h, mi, s = _ints(parts, 3)
    n = F.size(parts)
    sec = F.when(n == 3, s).otherwise(F.lit(0))
    ok = ((n == 3) & _all_ok([h, mi, s])) | ((n == 2) & _all_ok([h, mi]))
    return F.when(ok, F.struct(h.alias("hour"), mi.alias("minute"), sec.alias("second")))


def parse_date_time(c) -> Column:
    """``<ymd> <hms>`` split on whitespace -> struct(ymd, hms), else null."""
    parts = java_split(as_col(c), DATE_TIME_SEPARATOR)
    ymd = parse_ymd(F.get(parts, 0))
    hms = parse_hms(F.get(parts, 1))
    return F.when((F.size(parts) == 2) & ymd.isNotNull() & hms.isNotNull(),
                  F.struct(ymd.alias("ymd"), hms.alias("hms")))


def date_label(year, month, day, day_of_week) -> Column:
    """``YYYY-MM-DD (Weekday)`` with Monday = 1."""
    names = F.array(*[F.lit(w) for w in WEEKDAYS])
    return F.format_string(DATE_LABEL_FORMAT, as_col(year), as_col(month), as_col(day),
                           F.element_at(names, as_col(day_of_week)))


def times_label(times_struct) -> Column:
    """The 11 time fields as a tuple string ``(a,b,...)``."""
    t = as_col(times_struct)
    fields = ["depTime", "crsDepTime", "arrTime", "crsArrTime", "actualElapsedTime",
              "crsElapsedTime", "airTime", "arrDelay", "depDelay", "taxiIn", "taxiOut"]
    return F.concat(F.lit("("), F.concat_ws(",", *[t[f].cast("string") for f in fields]), F.lit(")"))


def order_by_date(df, date_struct: str = "date"):
    """Sort by year, month, day of month; the weekday is not compared (DAT-4)."""
    d = date_struct
    return df.orderBy(f"{d}.year", f"{d}.month", f"{d}.dayOfMonth")


def order_by_times(df, times_struct: str = "times"):
    """Sort by the four clock fields only, not all eleven (DAT-5)."""
    t = times_struct
    return df.orderBy(f"{t}.depTime", f"{t}.crsDepTime", f"{t}.arrTime", f"{t}.crsArrTime")
