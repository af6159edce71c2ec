"""Date/time column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICROS_PER_DAY = 86_400_000_000


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def hour_of_day(col) -> Column:
    """hour 0-23."""
    return F.hour(_c(col))


def weekday_monday0(col) -> Column:
    """day of week with Monday = 0 ... Sunday = 6 (not ``dayofweek``)."""
    return F.weekday(_c(col))


def days_between(later, earlier) -> Column:
    """floor of (later - earlier) in days; -5 hours -> -1.

    ``timestampdiff(MICROSECOND, ...)`` works on timestamp_ntz (``unix_micros``
    does not) and flooring keeps the sign rule of a timedelta's day count.
    """
    micros = F.timestamp_diff("MICROSECOND", _c(earlier), _c(later))
    return F.floor(micros / F.lit(float(_MICROS_PER_DAY))).cast("int")


def month_start(col) -> Column:
    """month period as its first instant."""
    return F.date_trunc("month", _c(col))


def month_label(col) -> Column:
    """month period label ``yyyy-MM``."""
    return F.date_format(_c(col), "yyyy-MM")


def day_group(col) -> Column:
    """10-day bin of the day of month: ``1-10``, ``11-20``, ``21-30``;
    day 31 joins ``21-30``."""
    d = F.dayofmonth(_c(col))
    lo = F.least(F.floor((d - 1) / 10), F.lit(2)).cast("int") * 10 + 1
    hi = lo + 9
    return F.concat(lo.cast("string"), F.lit("-"), hi.cast("string"))


def window_end(start, months: int = 1) -> Column:
    """last day of the month before (start + n months)."""
    return F.date_sub(F.trunc(F.add_months(_c(start), months), "MM"), 1)


def parse_dmy(col) -> Column:
    """``dd-MM-yyyy`` -> date (NULL when invalid)."""
    return F.try_to_date(_c(col), "d-M-yyyy")


def format_dmy(col, sep: str = "-") -> Column:
    """date -> ``dd-MM-yyyy`` (or ``dd_MM_yyyy`` for folder names)."""
    return F.date_format(_c(col), f"dd{sep}MM{sep}yyyy")


def dim_id(n, prefix: str = "AL", width: int = 3) -> Column:
    """``AL`` + zero-padded number, never cut when it has more digits."""
    s = _c(n).cast("string")
    return F.concat(F.lit(prefix), F.lpad(s, F.greatest(F.lit(width), F.length(s)), "0"))
