"""Column functions for dates.  "Now" is always an argument."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _as_of(as_of: Column | str) -> Column:
    """A date argument: ISO text is a literal, a Column is itself."""
    return F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of


def parse_date(c: Column | str, formats: Sequence[str], min_year: int | None = None) -> Column:
    """First format that fits, else null; years up to ``min_year`` become null."""
    c = _col(c)
    out = F.coalesce(*[F.to_date(F.try_to_timestamp(c, F.lit(f))) for f in formats])
    return out if min_year is None else F.when(F.year(out) > min_year, out)


def days_between(end: Column | str, start: Column | str) -> Column:
    return F.datediff(_col(end), _col(start))


def days_open(closed: Column | str, opened: Column | str, as_of: Column | str) -> Column:
    """Days from opening to closing, or to ``as_of`` while still open."""
    return F.datediff(F.coalesce(F.to_date(_col(closed)), _as_of(as_of)), _col(opened))


def report_month(d: Column | str, cutoff_day: int = 21) -> Column:
    """Month start; before the cut-off day it is the previous month's."""
    d = F.to_date(_col(d))
    return F.trunc(F.when(F.dayofmonth(d) < cutoff_day, F.add_months(d, -1)).otherwise(d), "month")


def quarter_label(c: Column | str) -> Column:
    """``Q3-21`` to ``2021-Q03``."""
    c = _col(c)
    return F.concat(F.lit("20"), F.right(c, F.lit(2)), F.lit("-Q0"), F.substring(c, 2, 1))


def month_label_date(c: Column | str) -> Column:
    """``Jan 21`` to the first day of that month."""
    return F.to_date(F.try_to_timestamp(_col(c), F.lit("MMM yy")))


def in_effect(start: Column | str, end: Column | str, as_of: Column | str) -> Column:
    """True where start <= as-of date < end."""
    return (_col(start) <= _as_of(as_of)) & (_as_of(as_of) < _col(end))


def expired_flag(updated: Column | str, as_of: Column | str, days: int = 90) -> Column:
    """``n`` once ``days`` have passed since the update, else ``y``."""
    return F.when(_as_of(as_of) >= F.date_add(_col(updated), days), "n").otherwise("y")


def to_utc(c: Column | str, zone: str) -> Column:
    """A wall-clock time in ``zone`` as UTC."""
    return F.to_utc_timestamp(_col(c), zone)
