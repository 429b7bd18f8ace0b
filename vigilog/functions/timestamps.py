"""Log-time parsing. Every function yields NULL, never an error, for bad input.

All results are TIMESTAMP_NTZ and are built by string casts, so they do not
depend on the session time zone; zone offsets in the text are dropped.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigilog.functions.text import S, is_recast, recast

# Month abbreviations, in calendar order.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

_OFFSET_HOUR = r"(?:[01]\d|2[0-3])"
_CLF = (
    r"(\d{1,2})/(\w+)/(\d{4}):(\d{1,2}:\d{1,2}:\d{1,2})" + S + r"+(?:Z|[+-]"
    + _OFFSET_HOUR + r"(?:[0-5]\d(?:[0-5]\d(?:\.\d{1,6})?)?|:[0-5]\d(?::[0-5]\d(?:\.\d{1,6})?)?))\z"
)
_ISO = (
    r"(\d{4})(-?)(\d{2})\2(\d{2})"
    r"(?:.(\d{2})(?:(:?)(\d{2})(?:\6(\d{2})(?:[.,](\d+))?)?)?"
    r"(?:Z|[+-]" + _OFFSET_HOUR + r"(?::?[0-5]\d(?::?[0-5]\d(?:[.,]\d+)?)?)?)?)?\z"
)


def _month_number(name: Column) -> Column:
    pairs = [F.lit(x) for i, m in enumerate(MONTHS, start=1) for x in (m, str(i))]
    return F.try_element_at(F.create_map(*pairs), F.lower(name))


def _wall_clock(year: Column, month: Column, day: Column, time: Column) -> Column:
    return F.concat(year, F.lit("-"), month, F.lit("-"), day, F.lit(" "), time).try_cast("timestamp_ntz")


def parse_syslog_ts(month: Column, day: Column, time: Column, year: Column) -> Column:
    """``May 21`` + ``10:23:45`` in the given year."""
    three_parts = F.translate(time, "0123456789", "") == "::"
    return F.when(three_parts, _wall_clock(year.cast("string"), _month_number(month), day, time))


def recast_clf(text: Column) -> Column:
    """``21/May/2026:10:23:45 +0000`` rewritten for ``clf_ts``; the offset must be valid and is dropped."""
    return F.when(~is_recast(text), recast(text, _CLF, (1, 2, 3, 4), anchored=True))


def clf_ts(part: Callable[[int], Column]) -> Column:
    return _wall_clock(part(3), _month_number(part(2)), part(1), part(4))


def recast_iso(text: Column) -> Column:
    """ISO-8601 date with optional time, fraction and offset, rewritten for ``iso_ts``; the offset is dropped."""
    return F.when(~is_recast(text), recast(text, _ISO, (1, 3, 4, 5, 7, 8, 9), anchored=True))


def iso_ts(part: Callable[[int], Column]) -> Column:
    def or_zero(digits: Column) -> Column:
        return F.when(digits == "", "00").otherwise(digits)

    time = F.concat(or_zero(part(4)), F.lit(":"), or_zero(part(5)), F.lit(":"), or_zero(part(6)), F.lit("."))
    return _wall_clock(part(1), part(2), part(3), F.concat(time, F.substring(or_zero(part(7)), 1, 6)))


def format_iso(ts: Column) -> Column:
    """ISO text; the fraction is written only when it is not zero."""
    return F.when(
        F.date_format(ts, "SSSSSS") == "000000", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    ).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def format_plain(ts: Column) -> Column:
    return F.translate(format_iso(ts), "T", " ")


def wall_clock(value: datetime) -> Column:
    """A naive datetime as a TIMESTAMP_NTZ value; a plain literal would be zoned."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def epoch_micros(ts: str) -> Column:
    """Microseconds since 1970 of a TIMESTAMP_NTZ column, independent of the session zone."""
    seconds = f"CAST(CAST(`{ts}` - TIMESTAMP_NTZ'1970-01-01 00:00:00' AS INTERVAL SECOND) AS DECIMAL(18, 6))"
    return F.expr(f"CAST({seconds} * 1000000 AS BIGINT)")


def bucket_start(ts: Column, seconds: int) -> Column:
    """Start of the tumbling bucket of ``seconds`` that holds ``ts``."""
    return F.window(ts, f"{seconds} seconds")["start"]
