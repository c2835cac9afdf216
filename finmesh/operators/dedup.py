"""Deduplication.

"First"/"last" need an order: the source keeps the *positional* first row
per key (its other columns may be null) and the *last written* record per key.
Both are expressed as aggregates, ``min_by``/``max_by`` over a struct of the
ordering columns, so Spark combines partially on the map side before the
shuffle: a key holding a third of all rows is reduced per task, never
gathered whole into one task (a ``row_number`` window would sort and buffer
the whole group in one task).  The ordering columns must form a total order
within each key (e.g. page offset + position in the page).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

_ROW = "__row"


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def _by_key(df: DataFrame, keys: Sequence[str], order: Sequence, pick) -> DataFrame:
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.select(*keys).distinct()
    ordering = F.struct(*_cols(order))
    row = F.struct(*[F.col(c) for c in payload])
    out = df.groupBy(*keys).agg(pick(row, ordering).alias(_ROW))
    return out.select(*keys, *[F.col(f"{_ROW}.{c}").alias(c) for c in payload])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key: the row with the smallest ``order`` (pandas
    ``drop_duplicates(subset=keys)`` over rows in ``order``)."""
    return _by_key(df, keys, order, F.min_by)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key: the row with the largest ``order`` (last write wins)."""
    return _by_key(df, keys, order, F.max_by)


def last_write_wins(df: DataFrame, keys: Sequence[str], order: Sequence,
                    first_seen_as: str | None = None) -> DataFrame:
    """Like ``dict.update`` page after page: the value of the newest record per
    key; optionally also the ordering struct of the key's *first* appearance
    (a dict keeps a key at its first insertion position)."""
    if first_seen_as is None:
        return keep_last(df, keys, order)
    payload = [c for c in df.columns if c not in keys]
    ordering = F.struct(*_cols(order))
    out = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in payload]), ordering).alias(_ROW),
        F.min(ordering).alias(first_seen_as))
    return out.select(*keys, first_seen_as, *[F.col(f"{_ROW}.{c}").alias(c) for c in payload])


def distinct_values(df: DataFrame, cols: Sequence, names: Sequence[str] | None = None) -> DataFrame:
    """``select(cols).distinct()`` (A5), with optional output names."""
    cs = _cols(cols)
    if names:
        cs = [c.alias(n) for c, n in zip(cs, names)]
    return df.select(*cs).distinct()
