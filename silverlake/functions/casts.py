"""Casts that turn a bad value into NULL instead of failing the job.

Bronze columns arrive with loose types, and ANSI mode (the default since Spark 4)
makes a plain cast raise on the first bad value, so every cast here is a ``try_`` cast.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_PATTERN = "yyyy-MM-dd"


def to_text(name: str) -> Column:
    return F.col(name).cast("string")


def to_double(name: str) -> Column:
    return F.col(name).try_cast("double")


def to_float(name: str) -> Column:
    return F.col(name).try_cast("float")


def to_int(name: str) -> Column:
    """Through double, so that ``'2.5'`` becomes 2; a value out of range becomes NULL."""
    return F.col(name).try_cast("double").try_cast("int")


def to_day(name: str) -> Column:
    return F.try_to_date(F.col(name), DATE_PATTERN)


# Target type -> cast. ``string`` also serves the columns that pass through unchanged.
CASTS: dict[str, Callable[[str], Column]] = {
    "string": to_text,
    "double": to_double,
    "float": to_float,
    "int": to_int,
    "date": to_day,
}


def convert(name: str, target: str) -> Column:
    """Column ``name`` as type ``target``; NULL where the value does not convert."""
    try:
        return CASTS[target](name)
    except KeyError:
        raise ValueError(f"no safe cast to {target!r}; known: {sorted(CASTS)}") from None


def was_lost(name: str, target: str) -> Column:
    """True where a value is present but does not convert."""
    return F.col(name).isNotNull() & convert(name, target).isNull()
