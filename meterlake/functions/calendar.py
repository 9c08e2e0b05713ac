"""Calendar periods and month mappings (C3-C5 bounds, H2, H3, H4).

``as_of`` is always a parameter (a date or a Column), never the clock, so a
rerun gives the same answer.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Portuguese month abbreviations, January to December.
PT_MONTHS = ("jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez")

WORKFLOWS = ("current", "previous", "select")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _as_date(v) -> dt.date:
    if isinstance(v, dt.datetime):
        return v.date()
    if isinstance(v, dt.date):
        return v
    return dt.date.fromisoformat(str(v)[:10])


def month_start(year: int, month: int) -> dt.datetime:
    """First instant of a month; month 0 / 13 roll into the adjacent year."""
    y, m = divmod((year * 12 + (month - 1)), 12)
    return dt.datetime(y, m + 1, 1)


def period_bounds(workflow: str, as_of=None, year: int | None = None,
                  month: int | None = None) -> tuple[dt.datetime, dt.datetime]:
    """Half-open ``[start, end)`` of the month a workflow asks for.

    ``previous`` in January is December of the year before (the reference
    would ask for month 0).
    """
    if workflow == "select":
        if year is None or month is None:
            raise ValueError("the select workflow needs both month and year")
        if not 1 <= int(month) <= 12:
            raise ValueError(f"month must be 1-12, got {month}")
        start = month_start(int(year), int(month))
    elif workflow in ("current", "previous"):
        if as_of is None:
            raise ValueError(f"the {workflow} workflow needs as_of")
        d = _as_date(as_of)
        start = month_start(d.year, d.month - (1 if workflow == "previous" else 0))
    else:
        raise ValueError(f"unsupported workflow {workflow!r}; expected one of {WORKFLOWS}")
    return start, month_start(start.year, start.month + 1)


def month_start_col(year, month) -> Column:
    """Per-row first day of (year, month) as a naive timestamp (null when there is no such month)."""
    return F.try_make_timestamp_ntz(_c(year), _c(month), F.lit(1), F.lit(0), F.lit(0), F.lit(0))


def month_grid(d) -> tuple[Column, Column]:
    """H2: (row, column) of a month in a 4 x 3 grid (rows are quarters)."""
    m = F.month(_c(d))
    return F.quarter(_c(d)), ((m - 1) % 3) + 1


def month_name_pt(d, dot: bool = True) -> Column:
    """H3: Portuguese month abbreviation (``mai.``), the same form for every month."""
    name = F.element_at(F.array(*[F.lit(x) for x in PT_MONTHS]), F.month(_c(d)))
    return F.concat(name, F.lit(".")) if dot else name


def years_back(d, as_of) -> Column:
    """H4: year steps back from ``as_of`` (negative for a later year)."""
    ref = F.lit(_as_date(as_of).year) if not isinstance(as_of, Column) else F.year(as_of)
    return ref - F.year(_c(d))
