"""Typed parsing of workbook text cells (B1, B2, B5) as Column expressions.

Everything here is a built-in expression (codegen, no Python per row).
Malformed input becomes null; callers route nulls to a quarantine frame.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date + time layouts, tried in order (ISO first).
DATE_TIME_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd HH:mm",
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy HH:mm",
    "dd-MM-yyyy HH:mm:ss",
    "dd-MM-yyyy HH:mm",
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _may_fit(text: Column, fmt: str) -> Column | None:
    """What every text of a format of digits and separators fulfils: a text that can't fit
    costs no failed parse. None for other formats. (A year may have a sign.)"""
    if not re.fullmatch(r"(yyyy|dd)([-/])MM\2(yyyy|dd) HH:mm(:ss)?", fmt):
        return None
    marks = F.translate(F.ltrim(text, F.lit("+-")), "0123456789", "") == re.sub("[A-Za-z]", "", fmt)
    third = F.substring(text, 3, 1)
    return marks & (third == fmt[2] if fmt.startswith("dd") else third != fmt[4])


def merge_date_time(date, time, formats: Sequence[str] = DATE_TIME_FORMATS) -> Column:
    """B1: date text + time text -> one naive timestamp (null when no format fits), in any session time zone."""
    text = F.concat_ws(" ", F.trim(_c(date)), F.trim(_c(time)))
    # Read as UTC instants and counted from the epoch: the session zone's gaps and folds play no part.
    zoned = F.concat(text, F.lit(" Z"))
    tries = []
    for f in formats:
        read, fits = F.try_to_timestamp(zoned, F.lit(f"{f} X")), _may_fit(text, f)
        tries.append(read if fits is None else F.when(fits, read))
    parsed = F.coalesce(*tries)
    none = F.lit(0)
    since = F.make_dt_interval(none, none, none, (F.unix_micros(parsed) / 1_000_000).cast("decimal(18,6)"))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since


def parse_number(text, thousands: str = ",", decimal: str = ".") -> Column:
    """B2: number text with a thousands separator -> DOUBLE (null when malformed)."""
    s = F.trim(_c(text).cast("string"))
    if thousands:
        s = F.replace(s, F.lit(thousands), F.lit(""))
    if decimal != ".":
        s = F.replace(s, F.lit(decimal), F.lit("."))
    return s.try_cast("double")


def localize_utc(ts, zone: str | None = None) -> Column:
    """Naive wall time -> instant.

    Default labels the naive time as UTC without shifting it (the session zone
    must be UTC, see ``session.ensure_utc``). With ``zone`` the wall time is
    read in that zone and converted to UTC.
    """
    t = _c(ts).cast("timestamp")
    if zone and zone.upper() != "UTC":
        t = F.to_utc_timestamp(t, zone)
    return t


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01T00:00Z of an instant."""
    return F.unix_micros(_c(ts).cast("timestamp"))
