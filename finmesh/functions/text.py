"""Delimited-text functions.

Two different splitting rules exist in the source data:

* plain comma (``split_plain``): borrower and implementing-agency lists;
  names containing a comma are cut.
* comma **not followed by a space** (``split_comma_nospace``): themes,
  sub-sectors and countries of documents, so ``"Governance, School-Based
  Management"`` stays whole.  Java regex supports the look-ahead.

``strip_ws`` strips exactly the characters Python's ``str.strip()`` treats as
white space (plain ``trim`` only removes the space character).
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F

# The white-space set of Python's str.isspace(), as a regex class
# understood by both Java and RE2.
WS_CLASS = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
_STRIP_RE = f"^{WS_CLASS}+|{WS_CLASS}+$"

PLAIN_COMMA = ","
COMMA_NOT_SPACE = ",(?! )"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python-style ``str.strip()``."""
    return F.regexp_replace(_col(c), _STRIP_RE, "")


def split_plain(c) -> Column:
    """``s.split(',')``: every comma is a delimiter; keeps empty pieces."""
    return F.split(_col(c), PLAIN_COMMA, -1)


def split_comma_nospace(c) -> Column:
    """``re.split(r',(?! )', s)``: a comma followed by a space is not a delimiter."""
    return F.split(_col(c), COMMA_NOT_SPACE, -1)


def clean_items(arr) -> Column:
    """Strip every piece and drop the empty ones (``t.strip()`` then ``if t``)."""
    stripped = F.transform(_col(arr), strip_ws)
    return F.filter(stripped, lambda x: F.length(x) > 0)


def lower_items(arr) -> Column:
    return F.transform(_col(arr), F.lower)
