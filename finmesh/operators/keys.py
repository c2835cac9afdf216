"""Surrogate keys (K1) and parent-key resolution.

``with_surrogate_key`` numbers rows 1..n in a total order without a global
single-partition window: store the rows (their count and the sample for the ranges
come from the stored table, so the input is evaluated once), range-partition and sort on the order, number rows
inside each partition, write the numbered rows as a parquet table in the
shared checkpoint folder (cuts lineage, so a lost executor does not renumber
anything), then add the prefix sum of the per-partition counts.  Only the counts frame, one row per
partition, sees a global window; it is broadcast because its size is bounded
by the partition count, which is at most ``MAX_PARTITIONS``: beyond that partitions grow with the input.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from finmesh.session import scratch_path, shuffles_freed

_PID, _LOCAL, _OFFSET, _PAGE = "__pid", "__local", "__offset", "__page"


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


ROWS_PER_PARTITION = 250_000
MAX_PARTITIONS = 20_000


def partitions_for(rows: int) -> int:
    """Range partitions for so many rows; the offsets frame has one row per partition."""
    return max(1, min(MAX_PARTITIONS, -(-rows // ROWS_PER_PARTITION)))


def _stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written into the shared scratch folder and read back."""
    path = scratch_path(frame.sparkSession, name)
    with shuffles_freed(frame.sparkSession):
        frame.write.parquet(path, compression="zstd")
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def with_surrogate_key(df: DataFrame, order: Sequence, name: str, start: int | Column = 1,
                       num_partitions: int | None = None) -> DataFrame:
    """Append ``name`` = dense row number (from ``start``) in ``order``.

    Equal to ``row_number() OVER (ORDER BY order) + start - 1`` whenever the
    order is total; ties get consecutive numbers in an unspecified order.
    ``start`` may be a Column, e.g. a scalar subquery over an already loaded
    table (see ``append_with_keys``).  ``num_partitions`` follows the row count
    unless given.
    """
    rows = _stored(df, "key-rows")
    n = num_partitions or partitions_for(rows.count())
    order_cols = _cols(order)
    in_order = rows.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    return _numbered(in_order, name, start)


def _numbered(in_order: DataFrame, name: str, start: int | Column) -> DataFrame:
    """Rows of range partitions, sorted, with their dense number ``name``."""
    numbered = (in_order.withColumn(_PID, F.spark_partition_id())
                        .withColumn(_LOCAL, F.monotonically_increasing_id()
                                    - F.shiftleft(F.col(_PID).cast("long"), 33)))
    # Cut lineage with a table written to the shared checkpoint folder (columnar,
    # compressed); numbering is then fixed even if an executor is lost later.
    numbered = _stored(numbered, "surrogate-key")
    counts = numbered.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        _PID,
        (F.sum("__n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)))
        .alias(_OFFSET))
    out = numbered.join(F.broadcast(offsets), _PID, "left")   # one row per partition
    first = start if isinstance(start, Column) else F.lit(start)
    key = (F.coalesce(F.col(_OFFSET), F.lit(0)) + F.col(_LOCAL) + first).cast("long").alias(name)
    return out.select(*[F.col(c) for c in in_order.columns], key)


def with_item_numbers(rows: DataFrame, order: Sequence[str], items: str, name: str, item: str, keep: Sequence[str]) -> DataFrame:
    """``keep..., item, name``: the items of the array column ``items``, one row each, numbered 1..n in the order of the rows
    and of the items within.  Rows are sorted as they are and exploded after that; an item is never sorted nor joined back.
    ``rows`` is read several times, so it should be stored."""
    order_cols = _cols(order)
    in_order = rows.select(*dict.fromkeys([*order, *keep, items])).repartitionByRange(partitions_for(rows.count()), *order_cols)
    return _numbered(in_order.sortWithinPartitions(*order_cols).select(*keep, F.explode(items).alias(item)), name, 1)


def with_list_offsets(df: DataFrame, order: Sequence[str], lists: Sequence[str], row: str | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """``df`` with ``<list>_before`` for each array column of ``lists``: how many
    items of that list come in rows before this one.  A bridge table then
    numbers its rows by ``<list>_before + position + 1`` while it explodes the
    list: one numbering of the records serves all their bridges, and no
    exploded row is ever sorted.

    Only row numbers, order and list sizes are range-partitioned and summed.  ``row`` names a column that tells
    the rows of ``df`` apart and stays the same whenever it is read; without one the frame is stored first.  ``sizes``: ``row``,
    ``order`` and, by the names of the lists, their sizes, where those are known: of rows that are not there nothing comes.
    """
    rows = df.withColumnRenamed(row, "__row") if row else _stored(df.withColumn("__row", F.monotonically_increasing_id()), "list-rows")
    known = rows.select("__row", *order, *[F.size(c).alias(c) for c in lists]) if sizes is None else sizes.withColumnRenamed(row, "__row")
    known = known.select("__row", *order, *[F.coalesce(c, F.lit(0)).cast("long").alias(f"{c}_before") for c in lists])
    placed = _stored(known.repartitionByRange(partitions_for(rows.count()), *order).withColumn(_PID, F.spark_partition_id()), "list-sizes")
    names = [f"{c}_before" for c in lists]
    earlier = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)       # one row per partition
    starts = placed.groupBy(_PID).agg(*[F.sum(c).alias(c) for c in names]).select(
        _PID, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"__{c}") for c in names])
    within = Window.partitionBy(_PID).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = placed.select("__row", _PID, *[F.coalesce(F.sum(c).over(within), F.lit(0)).alias(c) for c in names])
    offsets = _stored(running.join(starts, _PID).select("__row", *[(F.col(c) + F.col(f"__{c}")).alias(c) for c in names]), "list-offsets")
    return rows.join(offsets, "__row").drop("__row")


def with_list_offsets_by_page(df: DataFrame, page: Sequence[str], order: Sequence[str], lists: Sequence[str]) -> DataFrame:
    """As ``with_list_offsets``, for rows that come in pages: ``page`` are the columns that lead the order (nulls first), ``order``
    those that follow, which must tell a page's rows apart whenever ``df`` is read.

    A page is bounded, so its rows meet in one task with their lists: each row is shuffled once, and none is joined by
    itself.  Of each page only the sums are added up across pages."""
    names = [f"{c}_before" for c in lists]
    sizes = [F.coalesce(F.size(c), F.lit(0)).cast("long") for c in lists]
    # as one struct, whose nulls are equal, for the join
    rows = df.withColumn(_PAGE, F.struct(*page))
    sums = rows.select(_PAGE, *[n.alias(c) for n, c in zip(sizes, names)]).groupBy(_PAGE).agg(*[F.sum(c).alias(c) for c in names])
    placed = _stored(sums.repartitionByRange(_PAGE).withColumn(_PID, F.spark_partition_id()), "list-sizes")
    starts = _summed_before(placed, [_PAGE], names).select(_PAGE, *[F.col(f"{c}_before").alias(f"__{c}") for c in names])
    within = Window.partitionBy(_PAGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = rows.select("*", *[F.coalesce(F.sum(n).over(within), F.lit(0)).alias(c) for n, c in zip(sizes, names)])
    return running.join(starts, _PAGE).select(*df.columns, *[(F.col(c) + F.col(f"__{c}")).alias(c) for c in names])


def with_totals_before(df: DataFrame, order: Sequence[str], values: Sequence[str]) -> tuple[DataFrame, int]:
    """``df`` with ``<value>_before`` for each of ``values``, its sum over the rows before this one in ``order`` (total, no
    nulls); and the sum of the first of them over all rows."""
    rows = _stored(df, "total-rows")
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(values[0]), F.lit(0))).first()
    placed = _stored(rows.repartitionByRange(partitions_for(n), *order).withColumn(_PID, F.spark_partition_id()), "totals-placed")
    return _stored(_summed_before(placed, order, values).select(*df.columns, *[f"{c}_before" for c in values]), "totals"), total


def _summed_before(placed: DataFrame, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Stored range partitions with ``<value>_before`` for each of ``values``: its sum over the rows before this one in ``order``."""
    earlier = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)       # one row per partition
    starts = placed.groupBy(_PID).agg(*[F.sum(c).alias(c) for c in values]).select(
        _PID, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"__{c}") for c in values])
    within = Window.partitionBy(_PID).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = placed.select("*", *[F.coalesce(F.sum(c).over(within), F.lit(0)).alias(f"{c}_before") for c in values])
    out = running.join(F.broadcast(starts), _PID)                                   # one row per partition
    return out.select(*placed.columns, *[(F.col(f"{c}_before") + F.col(f"__{c}")).alias(f"{c}_before") for c in values])


class Blocks:
    """Consecutive ranges of a whole-number key, numbered from 0: ``keys`` are the first of each but the first, ``befores`` the
    rows before them.  Few enough to be constants of a plan."""

    def __init__(self, keys: Sequence[int], befores: Sequence[int]):
        self._keys, self._befores = list(keys), [0, *befores]

    def __len__(self) -> int:
        return len(self._befores)

    @staticmethod
    def _numbers(values: Sequence[int]) -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")

    def of(self, key: Column) -> Column:
        """The block of ``key`` (a null is in the first), by binary search."""
        if not self._keys:
            return F.lit(0)
        steps = [1 << i for i in reversed(range(len(self._keys).bit_length()))]
        keys = self._numbers(self._keys)
        return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(
            F.coalesce(F.get(keys, at + step - 1) <= key, F.lit(False)), at + step).otherwise(at))

    def before(self, block: Column) -> Column:
        """The rows before a block."""
        return F.get(self._numbers(self._befores), block)


def blocks_of(totals: DataFrame, key: str, before: str, page: int, rows: int) -> Blocks:
    """Ranges of ``key`` that hold whole pages of ``page`` rows, about ``rows`` rows each: they begin at keys whose rows begin a
    page.  ``totals`` has one row per key with the rows ``before`` it (``with_totals_before``).  One row per block is collected."""
    begins = totals.where((F.col(before) > 0) & (F.col(before) % page == 0) & F.col(key).isNotNull())
    first = begins.groupBy(F.floor(F.col(before) / rows)).agg(F.min(F.struct(before, key)).alias("b")).select(f"b.{key}", f"b.{before}")
    found = sorted((b, k) for k, b in first.collect() if b >= rows)     # the first block begins at 0
    return Blocks([k for _, k in found], [b for b, _ in found])


def resolve_parent_key(children: DataFrame, parents: DataFrame, keys: Sequence[str],
                       id_col: str) -> DataFrame:
    """Attach the parent's surrogate ``id_col`` to each child by natural ``keys``
    (left join: children without a parent keep a null id).

    Parents are first reduced to one id per key (the first inserted, i.e. the
    smallest id), so the result has exactly one row per child.  The source's
    many-to-many merge emits the product of the group sizes per key;
    ``fanout_report`` gives that number without emitting a pair.
    """
    p = parents.groupBy(*keys).agg(F.min(id_col).alias(id_col))
    return children.join(p, list(keys), "left")


def fanout_report(children: DataFrame, parents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows a many-to-many merge would yield, computed from per-key
    counts (pre-aggregated on both sides) without emitting any pair."""
    c = children.groupBy(*keys).agg(F.count(F.lit(1)).alias("__c"))
    p = parents.groupBy(*keys).agg(F.count(F.lit(1)).alias("__p"))
    j = c.join(p, list(keys), "left")
    return j.agg(
        F.sum("__c").cast("long").alias("child_rows"),
        F.sum(F.col("__c") * F.coalesce(F.col("__p"), F.lit(1))).cast("long").alias("all_mode_rows"),
        F.sum(F.when(F.col("__p") > 1, F.col("__c")).otherwise(0)).cast("long").alias("children_with_repeated_parent"),
        F.count(F.when(F.col("__p") > 1, F.lit(1))).cast("long").alias("repeated_parent_keys"),
    )


def append_with_keys(loaded: DataFrame, new_rows: DataFrame, order: Sequence, name: str) -> DataFrame:
    """Rows to append with surrogate keys continuing after ``max(name)`` of the
    loaded table, as an auto-increment column does (K1, append).  The offset
    is a scalar subquery: nothing is collected to the driver."""
    after = loaded.agg(F.coalesce(F.max(name), F.lit(0)).cast("long") + F.lit(1)).scalar()
    return with_surrogate_key(new_rows, order, name, start=after)
