"""Type coercion (F5, F7-F9), truthiness (F10) and the two computed measures
(F12 allocated amount, F13 percent complete).

ANSI mode is on in Spark 4: every parse uses ``try_cast`` so bad input becomes
null instead of failing the job, which is what the source load does.
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F


# A date, alone or with a time of day and zone; a decimal number.
_DATE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?( ?(Z|UTC|[+-]\d{2}:?\d{2}))?)?$"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c) -> Column:
    """Date as written, or null.

    Accepts ``YYYY-MM-DD``, alone or before a time of day (and zone); anything
    else after the date makes the value null.  The date part is cast on its
    own (never through a timestamp) so ``2026-12-31T23:30:00Z`` is 2026-12-31
    in every session time zone.
    """
    text = F.trim(_col(c))
    return F.when(text.rlike(_DATE), F.substring(text, 1, 10).try_cast("date"))


def parse_int_number(c) -> Column:
    """Numeric string into an INT column: parsed as a number (``'1.5'`` is
    1.5, junk is null, and so are the JVM's own forms such as ``'3d'``) and
    rounded half away from zero on the way into INT."""
    text = F.trim(_col(c).cast("string"))
    return F.when(text.rlike(_NUMBER), F.round(text.try_cast("double"), 0).try_cast("int"))


def parse_decimal(c, precision: int = 20, scale: int = 2) -> Column:
    """String into DECIMAL(p,s): rounds half-up to the scale, junk is null."""
    return _col(c).try_cast(f"decimal({precision},{scale})")


def parse_int_id(c) -> Column:
    """Identifier string into INT (null when not an integer)."""
    return _col(c).try_cast("int")


def truthy(c) -> Column:
    """Python truthiness of an optional string: not null and not empty."""
    c = _col(c)
    return c.isNotNull() & (c != F.lit(""))


def allocated_amount(totalamt, sector_percent) -> Column:
    """``totalamt * sector_percent / 100`` kept exact as DECIMAL(30,8)."""
    amt = _col(totalamt).cast("decimal(20,2)")
    pct = _col(sector_percent).cast("decimal(5,2)")
    return (amt * pct * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(30,8)")


def percent_complete(landed, total) -> Column:
    """``round(landed / total * 100, 1)``, ties to the even tenth (49 of 400 is
    12.2); null (the source prints '?') when total is 0."""
    ratio = _col(landed).cast("double") / F.nullif(_col(total), F.lit(0)).cast("double")
    return F.bround(ratio * 100, 1)
