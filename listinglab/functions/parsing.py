"""Column expressions that parse raw listing text.

Every function maps Column -> Column with native Spark expressions (no
Python UDF), so parsing stays inside whole-stage codegen. ANSI mode is on
by default in Spark 4, so every cast is a ``try_`` cast: a bad value gives
NULL, and :func:`listinglab.operators.cleaning.partition_rejects` routes
such rows to a reject table instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Markers and placeholders of the source site's text. They must
# equal the source text byte for byte.
TICKET_FLIGHT_MARKER = "Chuyến bay:"
TICKET_FARE_MARKER = "Hạng vé :"
CURRENCY_MARKER = "VNĐ"
AIRCRAFT_PREFIX = "Máy bay:"
AIRCRAFT_LARGE = "(máy bay lớn)"
HOURS_MARKER = "giờ"
MINUTES_MARKER = "phút"
CHECKED_PLACEHOLDER = "Vui lòng chọn ở bước tiếp theo"
MULTI_PIECE_CARRY_ON_KG = 18
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _lit(s: str) -> Column:
    return F.lit(s)


def _after_first(c: Column, marker: str) -> Column:
    """Text after the first ``marker`` up to the next one (byte-level
    ``substring_index``; no regex, no char-offset arithmetic)."""
    return F.substring_index(F.substring_index(c, marker, 2), marker, -1)


def ticket_parts(col) -> tuple[Column, Column, Column, Column]:
    """Split ``<airline> Chuyến bay: <code> Hạng vé : <fare>``.

    Returns (airline, flight_code, fare_class, ok). When either marker is
    missing (or the text is NULL) all three parts are NULL. Only the text up
    to a second occurrence of a marker is used. (As a DataFrame operator,
    :func:`listinglab.operators.cleaning.split_ticket` materialises the
    middle part once instead of per output column.)
    """
    c = _c(col)
    return ticket_parts_from(c, _after_first(c, TICKET_FLIGHT_MARKER))


def ticket_parts_from(c: Column, after_flight: Column) -> tuple[Column, Column, Column, Column]:
    ok = (F.instr(c, TICKET_FLIGHT_MARKER) > 0) & (F.instr(after_flight, TICKET_FARE_MARKER) > 0)
    airline = F.trim(F.substring_index(c, TICKET_FLIGHT_MARKER, 1))
    code = F.trim(F.substring_index(after_flight, TICKET_FARE_MARKER, 1))
    fare = F.trim(_after_first(after_flight, TICKET_FARE_MARKER))
    return (F.when(ok, airline), F.when(ok, code), F.when(ok, fare), ok)


def currency(col) -> Column:
    """``1,249,000 VNĐ`` -> 1249000 (bigint); NULL stays NULL, bad -> NULL."""
    c = _c(col)
    digits = F.trim(F.translate(F.substring_index(c, CURRENCY_MARKER, 1), ",", ""))
    return digits.try_cast("bigint")


def spaced(c: Column) -> Column:
    """One blank between words, no commas."""
    return F.trim(F.regexp_replace(c, r"[\s,]+", " "))


def date_and_clock(v: Column) -> tuple[Column, Column]:
    """The date and the clock text of ``clock date`` or ``date clock``."""
    first, last = F.substring_index(v, " ", 1), F.substring_index(v, " ", -1)
    leads = F.instr(first, "/") > 0
    rest = F.when(leads, F.substr(v, F.length(first) + 2)).otherwise(F.left(v, F.length(v) - F.length(last) - 1))
    return F.try_to_date(F.when(leads, first).otherwise(last), "d/M/yyyy").cast("timestamp_ntz"), rest


def clock_parts(t: Column) -> tuple[Column, Column, Column, Column]:
    """(hour, minute, second, half) of ``H:mm``, ``H:mm:ss``, either with AM
    or PM; NULL parts where the text has another form."""
    clock, half = F.substring_index(t, " ", 1), F.upper(F.substr(t, F.length(F.substring_index(t, " ", 1)) + 2))
    colons = F.length(clock) - F.length(F.replace(clock, F.lit(":"), F.lit("")))
    second = F.when(colons == 2, F.substring_index(clock, ":", -1).try_cast("int")).when(colons == 1, F.lit(0))
    return (F.substring_index(clock, ":", 1).try_cast("int"),
            F.substring_index(F.substring_index(clock, ":", 2), ":", -1).try_cast("int"), second, half)


def day_and_time(day: Column, hour: Column, minute: Column, second: Column, half: Column) -> Column:
    """The timestamp, NULL where a part is missing or out of range. The time is
    added to the date, so the session time zone plays no part."""
    twelve = half.isin("AM", "PM")
    ok = minute.between(0, 59) & second.between(0, 59) & ((half == "") & hour.between(0, 23) | twelve & hour.between(1, 12))
    of_day = F.when(twelve, hour % 12 + F.when(half == "PM", 12).otherwise(0)).otherwise(hour)
    return F.when(ok, F.timestamp_add("SECOND", of_day * 3600 + minute * 60 + second, day))


#: The source site's own form; the year 0000 is no date.
_CLOCK_AND_DATE = r"^\d{2}:\d{2} \d{2}/\d{2}/(?!0000)\d{4}\z"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once, however often it is referenced."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def dayfirst_timestamp(col) -> Column:
    """A day-first date and a time of day -> timestamp_ntz; invalid -> NULL.

    Date and time come in either order, the time with or without seconds and
    AM or PM, with or without a comma between: ``07:05 01/02/2025``,
    ``07:05:59, 01/02/2025``, ``01/02/2025 08:30 PM``. The first form, the
    source site's own, is cut by position and cast; only other texts are taken
    apart."""
    c = _c(col)
    own = F.concat(F.substr(c, F.lit(13), F.lit(4)), F.lit("-"), F.substr(c, F.lit(10), F.lit(2)), F.lit("-"), F.substr(c, F.lit(7), F.lit(2)),
                   F.lit(" "), F.left(c, F.lit(5))).try_cast("timestamp_ntz")

    def apart(v: Column) -> Column:
        day, clock = date_and_clock(v)
        return _let(clock, lambda t: day_and_time(day, *clock_parts(t)))

    return F.when(c.rlike(_CLOCK_AND_DATE), own).when(c.isNotNull(), _let(spaced(c), apart))


def iso_timestamp(col) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` -> timestamp_ntz; unparsable -> NULL."""
    return _c(col).try_cast("timestamp_ntz")


def aircraft(col) -> Column:
    """Drop ``Máy bay:`` and ``(máy bay lớn)``, trim."""
    c = _c(col)
    return F.trim(F.replace(F.replace(c, _lit(AIRCRAFT_PREFIX), _lit("")), _lit(AIRCRAFT_LARGE), _lit("")))


def duration_hours(col) -> Column:
    """``H giờ M phút`` -> round(H + M/60, 2); no hour marker -> NULL."""
    c = _c(col)
    hours = F.trim(F.substring_index(c, HOURS_MARKER, 1)).try_cast("double")
    rest = _after_first(c, HOURS_MARKER)
    mins = F.trim(F.replace(rest, _lit(MINUTES_MARKER), _lit(""))).try_cast("double")
    ok = F.instr(c, HOURS_MARKER) > 0
    return F.when(ok, F.round(hours + mins / F.lit(60.0), 2))


def carry_on_kg(col) -> Column:
    """NULL -> NULL; text holding ``x`` (several pieces) -> 18; else kg as int."""
    c = _c(col)
    kg = F.trim(F.replace(c, _lit("kg"), _lit(""))).try_cast("int")
    return F.when(c.isNull(), F.lit(None).cast("int")).when(F.instr(c, "x") > 0, F.lit(MULTI_PIECE_CARRY_ON_KG)).otherwise(kg)


def checked_kg(col) -> Column:
    """NULL or the 'choose at next step' placeholder -> NULL; else kg as int."""
    c = _c(col)
    kg = F.trim(F.replace(c, _lit("kg"), _lit(""))).try_cast("int")
    return F.when(c.isNull() | (c == _lit(CHECKED_PLACEHOLDER)), F.lit(None).cast("int")).otherwise(kg)


# One quoted item of a Python list literal ('...' or "...", backslash escapes). Plain text is taken in runs that are never
# given back: a choice for each character costs a stack frame for each, and a long item ends in a StackOverflowError.
_ITEM = r"""(?:'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+")"""
# An item of a list that holds neither backslashes nor double quotes.
_PLAIN_ITEM = r"'([^']*+)'"
_LIST = rf"^\s*\[\s*(?:{_ITEM}\s*(?:,\s*{_ITEM}\s*)*,?\s*)?\]\s*$"


_NAMED = {"n": "\n", "t": "\t", "r": "\r", "a": "\a", "b": "\b", "f": "\f", "v": "\v", "0": "\0"}


def _unescaped(x: Column) -> Column:
    """Backslash escapes of a Python string. The marks U+0001..3 stand for a
    backslash, and around the hexadecimal digits of a character."""
    x = F.replace(x, F.lit("\\\\"), F.lit("\u0001"))
    for name, char in _NAMED.items():
        x = F.replace(x, F.lit(f"\\{name}"), F.lit(char))
    x = F.regexp_replace(x, r"\\(?:x([0-9A-Fa-f]{2})|u([0-9A-Fa-f]{4}))", "\u0002$1$2\u0003")
    pieces = F.transform(F.split(x, "\u0002"), lambda p: F.when(
        F.instr(p, "\u0003") > 0, F.concat(
            F.decode(F.unhex(F.lpad(F.substring_index(p, "\u0003", 1), 4, "0")), "UTF-16BE"), F.substring_index(p, "\u0003", -1))).otherwise(p))
    x = F.array_join(pieces, "")
    return F.replace(F.regexp_replace(x, r"\\(['\"])", "$1"), F.lit("\u0001"), F.lit("\\"))


def policy_list(col) -> Column:
    """P10: Python-literal list of strings -> array<string>; NULL or a text
    that is not such a literal -> [].

    The items are what the item pattern finds, each without its own quotes and
    with its escapes read; a quote of the other kind, a comma or a bracket
    inside an item is text."""
    c = _c(col)
    items = F.transform(F.regexp_extract_all(c, F.lit(f"({_ITEM})"), F.lit(1)), lambda x: F.substr(x, F.lit(2), F.length(x) - 2))
    plain = F.instr(c, "\\") == 0
    simple = F.regexp_extract_all(c, F.lit(_PLAIN_ITEM), F.lit(1))
    empty = F.array().cast("array<string>")
    return F.when(c.isNull() | ~c.rlike(_LIST), empty).when(plain & (F.instr(c, '"') == 0), simple) \
        .when(plain, items).otherwise(F.transform(items, _unescaped))


def policy_labels(col) -> Column:
    """Strip every ``"- "`` from each policy item."""
    return F.transform(_c(col), lambda x: F.replace(x, F.lit("- "), F.lit("")))


def location_name(col) -> Column:
    """``Name (CODE)`` -> ``Name``."""
    return F.trim(F.substring_index(_c(col), "(", 1))


def location_code(col) -> Column:
    """``Name (CODE)`` -> ``CODE``; no ``(`` -> NULL (a reject)."""
    c = _c(col)
    code = F.trim(F.replace(_after_first(c, "("), _lit(")"), _lit("")))
    return F.when(F.instr(c, "(") > 0, code)
