"""Nested JSON values.

Some document fields arrive as ``{"0": {"docna": "..."}}``: the first value
of the map under key ``"0"`` is the value we keep.  Anything else (a plain
string, a map without ``"0"``) passes through unchanged as its raw JSON text.
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F

_MAP = "map<string,string>"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_field(raw, name: str) -> Column:
    """Field ``name`` of a JSON object held as text (null when absent)."""
    return F.try_element_at(F.from_json(_col(raw), _MAP), F.lit(name))


NESTED = "map<string,map<string,string>>"


def first_of_nested(nested, raw) -> Column:
    """``{'0': {k: v, ...}}`` -> ``v`` (first entry); otherwise ``raw``.

    Of several entries under ``'0'`` the first as they stand in the text (in records that come from a page: by name).
    ``nested`` is the value parsed as a map of maps (null where it is none),
    ``raw`` the same value as text.  A JSON *string* that looks like a map is
    no map, which the text alone would not show."""
    return F.coalesce(F.try_element_at(F.map_values(F.try_element_at(_col(nested), F.lit("0"))), F.lit(1)), _col(raw))


def first_nested_value(record, name: str) -> Column:
    """Field ``name`` of a JSON record held as text, by the rule above."""
    nested = F.from_json(_col(record), f"`{name}` {NESTED}").getField(name)
    return first_of_nested(nested, json_field(record, name))
