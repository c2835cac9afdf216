"""Generators: nested payloads and delimited text into rows.

All of them are ``explode``/``posexplode`` over built-in expressions, so they
run inside whole-stage code generation next to the scan; nothing is grouped.
Positions are kept so "first"/insertion order stays deterministic.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from finmesh.functions.nested import json_field
from finmesh.functions.text import (
    clean_items, lower_items, split_comma_nospace, split_plain, strip_ws,
)
from finmesh.schemas import MAJOR_SECTORS

_SPLITTERS = {"plain": split_plain, "comma_nospace": split_comma_nospace}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def explode_delimited(df: DataFrame, col, out: str, rule: str = "comma_nospace",
                      keep: Sequence[str] = (), pos: str | None = None,
                      lower: bool = False) -> DataFrame:
    """One row per non-empty, stripped piece of a delimited string (G4 with
    F1/F2 + F3, optional F4).  Null or empty strings yield no rows (P14);
    duplicate pieces are kept."""
    items = clean_items(_SPLITTERS[rule](_col(col)))
    if lower:
        items = lower_items(items)
    pos = pos or "__pos"
    out_df = df.select(*keep, F.posexplode(items).alias(pos, out))
    return out_df if pos != "__pos" else out_df.drop("__pos")


def parse_major_sectors(raw) -> Column:
    """The ``major_sectors`` list, or null unless the raw value is a JSON list
    (P13: a string or an object is not used).  A column that is already
    parsed passes through."""
    raw = _col(raw)
    return F.when(F.ltrim(raw).startswith("["), F.from_json(raw, MAJOR_SECTORS))


def _sector_list(df: DataFrame, raw) -> Column:
    if isinstance(raw, str) and dict(df.dtypes).get(raw, "string") != "string":
        return F.col(raw)
    return parse_major_sectors(raw)


def explode_major_sectors(df: DataFrame, raw, keep: Sequence[str] = ()) -> DataFrame:
    """Project x major sector (G1): ``ms_pos, major_sector_code, major_sector_name``."""
    # Not by posexplode of the column: Spark would put filters on the list below it, and each would parse the list again.
    entries = F.transform(_sector_list(df, raw), lambda m, i: F.struct(i.alias("ms_pos"), m["major_sector"].alias("__major")))
    x = df.select(*keep, F.inline(entries)).filter(F.col("__major").isNotNull())
    return x.select(*keep, "ms_pos",
                    F.col("__major.major_sector_code").alias("major_sector_code"),
                    F.col("__major.major_sector_name").alias("major_sector_name"))


def explode_sectors(df: DataFrame, raw, keep: Sequence[str] = ()) -> DataFrame:
    """Project x sector, parent code carried down (G2); a major sector without
    ``sectors`` yields nothing (F10).  Sector names are kept as given.

    The two levels are flattened with higher-order functions into one array
    of ``(ms_pos, major_sector_code, s_pos, sector)`` and exploded once, so no
    intermediate row carries the nested list."""
    x = df.select(*keep, F.inline(sector_items(df, raw)))
    return x.select(*keep, "ms_pos", "major_sector_code", "s_pos", "sector_code", "sector_name",
                    "sector_percent")


def sector_items(df: DataFrame, raw) -> Column:
    """The rows of ``explode_sectors`` as one array.  Positions count every
    entry of the list, as in explode_major_sectors; an entry without a major
    sector contributes no sectors."""
    per_major = F.transform(_sector_list(df, raw), lambda m, i: F.transform(
        F.coalesce(m["major_sector"]["sectors"], F.array()),
        lambda sec, j: F.struct(i.alias("ms_pos"),
                                m["major_sector"]["major_sector_code"].alias("major_sector_code"),
                                j.alias("s_pos"),
                                sec["sector_code"].alias("sector_code"),
                                sec["sector_name"].alias("sector_name"),
                                sec["sector_percent"].alias("sector_percent"))))
    return F.flatten(per_major)


def _map_values(raw) -> Column:
    """The values of a JSON object held as text, null for anything else: numbered keys ("0", "1", ..., "10") in the
    order of their numbers, others after them as they stand (objects have no order of their own)."""
    raw = _col(raw)
    entries = F.when(F.ltrim(raw).startswith("{"), F.map_entries(F.from_json(raw, "map<string,string>")))
    numbered = F.transform(entries, lambda e, i: F.struct(F.coalesce(e["key"].try_cast("long"), F.lit(2 ** 62)).alias("n"), i.alias("i"), e["value"].alias("v")))
    return F.transform(F.array_sort(numbered), lambda e: e["v"])


def explode_map_field(df: DataFrame, raw, field: str, out: str,
                      keep: Sequence[str] = (), pos: str = "entry_pos") -> DataFrame:
    """Values of a ``{"0": {field: v}, "1": {...}}`` map into rows (G3):
    ``v`` stripped, blanks dropped.  Only used when the raw value is a map."""
    x = df.select(*keep, F.posexplode(_map_values(raw)).alias(pos, "__entry"))
    x = x.select(*keep, pos, strip_ws(F.coalesce(json_field("__entry", field), F.lit(""))).alias(out))
    return x.filter(F.length(out) > 0)


def map_items(raw, field: str) -> Column:
    """The kept values of ``explode_map_field`` as one array."""
    names = F.transform(_map_values(raw), lambda e: strip_ws(F.coalesce(json_field(e, field), F.lit(""))))
    return F.filter(names, lambda x: F.length(x) > 0)


def major_sector_items(df: DataFrame, raw) -> Column:
    """The entries of ``explode_major_sectors`` as one array."""
    kept = F.filter(_sector_list(df, raw), lambda m: m["major_sector"].isNotNull())
    return F.transform(kept, lambda m: F.struct(m["major_sector"]["major_sector_code"].alias("major_sector_code"),
                                                m["major_sector"]["major_sector_name"].alias("major_sector_name")))


def is_object(value) -> Column:
    """Whether a VARIANT holds a JSON object."""
    return F.try_variant_get(_col(value), "$", "struct<>").isNotNull()


def keyed_entries(df: DataFrame, body, held: Mapping[str, Column], keep: Sequence[str] = (), extra: Sequence[tuple] = ()) -> DataFrame:
    """``{field: {key: value, ...}, <extra>}`` -> ``keep..., <extra>, pos, entry_key, entry, unread``: one row per
    entry, in page order, its value a VARIANT (G5).

    The body is parsed once, whatever fields of it are taken (``held``: field -> condition under which the
    rows of ``df`` hold it).  Values stand by themselves, so one that is no record costs its neighbours nothing.
    A body that cannot be read, or without the field, gives one row without an entry and with its text in ``unread``."""
    schema = T.StructType([T.StructField(field, T.MapType(T.StringType(), T.VariantType())) for field in held]
                          + [T.StructField(n, t) for n, t in extra])
    parsed = df.select(*keep, _col(body).alias("__body"), F.from_json(_col(body), schema).alias("__b"),
                       F.coalesce(*[F.when(cond, F.lit(field)) for field, cond in held.items()]).alias("__field"))
    entries = F.coalesce(*[F.when(F.col("__field") == field, F.col(f"__b.{field}")) for field in held])
    x = parsed.select(*keep, *[F.col(f"__b.{n}").alias(n) for n, _ in extra], entries.alias("__m"),
                      F.when(entries.isNull(), F.coalesce("__body", F.lit(""))).alias("unread"))
    return x.select(*keep, *[n for n, _ in extra], "unread", F.posexplode_outer(F.map_entries("__m")).alias("pos", "__e")).select(
        *keep, *[n for n, _ in extra], "pos", F.col("__e.key").alias("entry_key"), F.col("__e.value").alias("entry"), "unread")


def explode_keyed_records(df: DataFrame, body, field: str, value_type: T.DataType,
                          keep: Sequence[str] = (), extra: Sequence[tuple] = ()) -> DataFrame:
    """``{field: {key: record, ...}, <extra>}`` into ``pos, record_key, record`` rows (G5), in page order.

    ``value_type`` is the record type; entries that are no objects are left out (``keyed_entries`` has them)."""
    rows = keyed_entries(df, body, {field: F.lit(True)}, keep, extra).where(is_object("entry"))
    return rows.select(*keep, *[n for n, _ in extra], "pos", F.col("entry_key").alias("record_key"),
                       F.try_variant_get("entry", "$", value_type.simpleString()).alias("record"))
