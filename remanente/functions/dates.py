"""Date arithmetic as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from remanente.vocabulary import NIVELES_DETALLE


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def yyyymm(date_col: Column | str) -> Column:
    """Month as an integer such as 202502."""
    d = as_col(date_col)
    return F.year(d) * 100 + F.month(d)


def previous_month(month_id: Column | str) -> Column:
    """Month id before ``month_id``; January steps back to December of the year before."""
    m = as_col(month_id)
    return F.when(m % 100 == 1, m - 89).otherwise(m - 1)


def months_apart(start: Column | str, end: Column | str) -> Column:
    """Calendar months between two dates, ignoring the day."""
    s, e = as_col(start), as_col(end)
    return (F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)


def days_between(end: Column | str, start: Column | str, inclusive: bool = True) -> Column:
    """Days from ``start`` to ``end``; both ends count unless ``inclusive`` is off."""
    days = F.datediff(as_col(end), as_col(start))
    return days + 1 if inclusive else days


def is_month_end(date_col: Column | str) -> Column:
    d = as_col(date_col)
    return d == F.last_day(d)


def month_start(date_col: Column | str) -> Column:
    return F.trunc(as_col(date_col), "MM")


def month_end_after(date_col: Column | str, months: Column | int) -> Column:
    """Last day of the month that lies ``months`` after the date."""
    return F.last_day(F.add_months(as_col(date_col), months))


def level_date(
    prefix: str,
    level_col: str = "nivel_detalle",
    levels: Sequence[str] = tuple(NIVELES_DETALLE),
) -> Column:
    """Value of ``{prefix}_{level}`` for the level named in the row; null for other levels."""
    picked = None
    for level in levels:
        here = F.col(level_col) == level
        value = F.col(f"{prefix}_{level}")
        picked = F.when(here, value) if picked is None else picked.when(here, value)
    return picked
