"""Column functions for numbers: parsing, rounding, banding, units."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """Double, or null where the text is no number."""
    return _col(c).try_cast("double")


def digits_to_number(c: Column | str) -> Column:
    """Strip everything but digits and points, then parse; null if nothing is left."""
    return F.regexp_replace(_col(c), r"[^0-9.]", "").try_cast("double")


def week_number(c: Column | str) -> Column:
    """First listed value, digits only, at most four characters, as a number."""
    first = F.split(_col(c), ",")[0]
    return F.substring(F.regexp_replace(first, r"[^0-9.]", ""), 1, 4).try_cast("double")


def leading_quantity(c: Column | str) -> Column:
    """Quantity before a bracketed remark: ``"1 (1 ST of 1)"`` gives 1."""
    return digits_to_number(F.split(_col(c), r"\(")[0])


def money(c: Column | str) -> Column:
    """Number after removing ``$`` and ``,``; null where none remains."""
    return F.trim(F.translate(_col(c), "$,", "")).try_cast("double")


def id_text(c: Column | str) -> Column:
    """A numeric id as digits, without exponent or decimals."""
    c = _col(c)
    return F.when(c.isNotNull(), F.format_string("%.0f", c.cast("double")))


def nan_to_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def half_even(c: Column | str, digits: int = 0) -> Column:
    """Round half to even."""
    return F.bround(_col(c), digits)


def ratio(num: Column | str, den: Column | str) -> Column:
    """Quotient, null where the divisor is zero."""
    return F.try_divide(_col(num), _col(den))


def positive_part(c: Column | str) -> Column:
    return F.greatest(_col(c), F.lit(0))


def band(c: Column | str, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the half-open band ``[bounds[i-1], bounds[i])`` holding the value."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("need one label more than bounds")
    c = _col(c)
    out = F.when(c < bounds[0], labels[0])
    for bound, label in zip(bounds[1:], labels[1:-1]):
        out = out.when(c < bound, label)
    return out.when(c >= bounds[-1], labels[-1])


# Gigabytes per unit; upper-case B is byte, lower-case b is bit.
GIGABYTES_PER_UNIT = (
    ("GB", 1.0),
    ("Gb", 1.0 / 8.0),
    ("MB", 1.0 / 1000.0),
    ("Mb", 1.0 / 8000.0),
    ("KB", 1.0 / 1000000.0),
)


def density_gigabytes(c: Column | str) -> Column:
    """Leading size with unit, as gigabytes; null for other units."""
    c = _col(c)
    out = None
    for unit, factor in GIGABYTES_PER_UNIT:
        size = F.trim(F.split(c, unit)[0]).try_cast("double") * F.lit(factor)
        out = F.when(c.contains(unit), size) if out is None else out.when(c.contains(unit), size)
    return out


def box_cox(c: Column | str, lam: float) -> Column:
    """Box-Cox transform of a positive value."""
    c = _col(c)
    return F.log(c) if lam == 0 else (F.pow(c, F.lit(lam)) - 1) / F.lit(lam)
