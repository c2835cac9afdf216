"""Sinks (S4, S5, S6, S8, S10) and the load ledger.

Writes go to directories of part files, written in parallel by the tasks;
nothing is funnelled into one forced file.  Load order matters only for
readers: parents are written before children.

A stored set of tables is a folder::

    base/_current                        {"version": "<folder>"}: the version that readers see (after a full refresh)
    base/<version>/<table>/<load>/       part files of one load
    base/<version>/_ledger/<batch>.json  committed loads: folders (below the base) and row counts of their tables

Without a refresh the base itself is the only version, ``<version>/`` is absent.  A load's files count once its ledger entry is there,
a refresh once the pointer names its version; either is one rename (``commit``).
"""
from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from finmesh.session import delete_folder, shuffles_freed
from finmesh.sources import commit
from finmesh.sources.files import read_table

# Parents before children (foreign keys point up).
LOAD_ORDER = [
    "country", "projects", "major_sector_lookup", "proj_sector_lookup",
    "project_major_sectors", "project_sectors", "impagency", "borrower",
    "documents", "doc_sector_lookup", "doc_theme_lookup", "doc_sub_sector_lookup",
    "doc_sector", "doc_theme", "doc_sub_sector", "doc_country",
]


def write_raw_dump(records: DataFrame, path: str) -> None:
    """Kept records as JSON lines, before any cleaning."""
    out = records.select(
        "record_key", F.col("landing_seq").alias("seq"), F.col("page_year").alias("year"), F.col("page_offset").alias("offset"),
        "pos", "record", "nested")
    out.write.mode("overwrite").json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None) -> None:
    """Parquet layer, e.g. flattened uncleaned documents."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# Rows of a CSV part file: a value may hold line breaks, so a file is read by one task.
CSV_ROWS_PER_FILE = 200_000
# A null in CSV; an empty value is the empty string.
CSV_NULL = "\\N"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int = CSV_ROWS_PER_FILE) -> None:
    """CSV export with header, no index (S8).  Every value comes back as it
    was: quotes are doubled, line breaks stay inside quotes, spaces are kept,
    null is ``\\N``.  Part files are bounded in rows, as each is one unit of reading."""
    (df.write.mode(mode).option("header", True).option("encoding", "UTF-8")
       .option("escape", '"').option("nullValue", CSV_NULL)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .option("maxRecordsPerFile", rows_per_file).csv(path))


POINTER, LEDGER = "_current", "_ledger"


def _version(spark: SparkSession, base: str) -> str:
    """The folder of the version that readers see, below ``base``: empty or ending in a slash."""
    pointer = commit.read_json(spark, f"{base}/{POINTER}")
    return f"{pointer['version']}/" if pointer else ""


def _entry(spark: SparkSession, base: str, batch: str) -> str:
    return f"{base}/{_version(spark, base)}{LEDGER}/{quote(batch, safe='')}.json"


def _load(tables: Mapping[str, DataFrame], base: str, version: str) -> dict:
    """Write the tables as one load of a version; their folders and rows, counted while they are written."""
    parts, load = {}, f"load-{uuid.uuid4().hex}"
    for name in [t for t in LOAD_ORDER if t in tables] + [t for t in tables if t not in LOAD_ORDER]:
        rows, folder = Observation(), f"{version}{name}/{load}"
        table = tables[name]
        with shuffles_freed(table.sparkSession):
            table.observe(rows, F.count(F.lit(1)).alias("rows")).write.parquet(f"{base}/{folder}", compression="zstd")
        parts[name] = {"folders": [folder], "rows": rows.get["rows"]}
    return parts


def append_load(tables: Mapping[str, DataFrame], base: str, batch: str | None = None) -> bool:
    """Append every table to the stored ones, in load order, as one load (S6); whether it was carried out.

    A ``batch`` that is already in the ledger is not loaded again, so a run may be repeated; without a
    name each call is a batch of its own.  A run that fails leaves no rows that a reader sees."""
    if not tables:
        return False
    spark = next(iter(tables.values())).sparkSession
    entry = _entry(spark, base, batch or uuid.uuid4().hex)
    if commit.exists(spark, entry):
        return False
    parts = _load(tables, base, _version(spark, base))
    commit.commit_json(spark, entry, {"batch": batch, "tables": parts}, replace=False)
    return True


def full_refresh(tables: Mapping[str, DataFrame], base: str) -> None:
    """Replace the given tables (S10): children and parents rebuilt from one input, so a rerun never duplicates bridge rows.

    All are written as a new version beside the old one, which readers see until the pointer is moved at the
    end: a failed run leaves every old table as it was, none is ever missing, and a table may be
    refreshed from what it now holds.  Tables that are not given keep their files.  Files of older versions stay
    for readers that have begun; ``remove_replaced`` deletes them."""
    if not tables:
        return
    spark = next(iter(tables.values())).sparkSession
    version = f"version-{uuid.uuid4().hex}"
    kept: dict = {}
    for entry in _ledger(spark, base):
        for name, part in entry["tables"].items():
            if name not in tables:
                had = kept.setdefault(name, {"folders": [], "rows": 0})
                kept[name] = {"folders": had["folders"] + part["folders"], "rows": had["rows"] + part["rows"]}
    parts = _load(tables, base, f"{version}/")
    commit.commit_json(spark, f"{base}/{version}/{LEDGER}/refresh.json", {"batch": "refresh", "tables": {**kept, **parts}}, replace=False)
    commit.commit_json(spark, f"{base}/{POINTER}", {"version": version}, replace=True)


def _ledger(spark: SparkSession, base: str) -> list[dict]:
    """The committed loads of the current version."""
    folder = f"{base}/{_version(spark, base)}{LEDGER}"
    return [commit.read_json(spark, f"{folder}/{n}") for n in commit.names(spark, folder) if n.endswith(".json")]


def load_ledger(spark: SparkSession, base: str) -> DataFrame:
    """``batch, table_name, row_count`` of every committed load (S12), as counted while it was written: no table is scanned."""
    rows = [(e["batch"], t, part["rows"]) for e in _ledger(spark, base) for t, part in e["tables"].items()]
    return spark.createDataFrame(rows, "batch string, table_name string, row_count long")


def remove_replaced(spark: SparkSession, base: str) -> int:
    """Delete the load folders that no committed load of the current version names; how many.  For a time when
    no load is under way and no reader of an older version is left."""
    live = {f for e in _ledger(spark, base) for part in e["tables"].values() for f in part["folders"]}
    tables = [t for t in commit.names(spark, base) if not t.startswith(("_", "version-"))]
    tables += [f"{v}/{t}" for v in commit.names(spark, base) if v.startswith("version-") for t in commit.names(spark, f"{base}/{v}")]
    gone = [f"{t}/{load}" for t in tables for load in commit.names(spark, f"{base}/{t}") if load.startswith("load-") and f"{t}/{load}" not in live]
    for folder in gone:
        delete_folder(spark, f"{base}/{folder}")
    return len(gone)


def read_back(spark: SparkSession, base: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A loaded table, optionally a few columns (S7, S11): the files of its committed loads."""
    folders = [f"{base}/{f}" for e in _ledger(spark, base) if name in e["tables"] for f in e["tables"][name]["folders"]]
    df = spark.read.parquet(*folders) if folders else read_table(spark, f"{base}/{name}")
    return df.select(*columns) if columns else df
