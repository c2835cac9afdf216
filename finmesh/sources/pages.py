"""Landed API pages.

Landing format: JSON lines, one fetched page per line::

    {"source": "documents", "seq": 7, "year": 2003, "offset": 2000, "body": {...API response...}}

``seq`` counts fetches: of a page fetched twice the greater one is the newer
(absent: 0, pages in order of year and offset).

Line-delimited JSON is splittable, so a directory of pages is read in
parallel; ``body`` is declared as a string, so Spark keeps its raw text, and
parsed once into a map of VARIANTs: each record stands by itself, one that is
no object is quarantined (``rejected_records``) and its neighbours stay.
Fields of a record come out as text; objects among them with their keys in order.  A directory of pages *is* the
accumulated collection (U1); batches loaded apart are combined with
``unionByName(allowMissingColumns=True)``.

The raw document dump (S3/S4) is JSON lines of single records::

    {"record_key": "D123", "seq": 7, "year": 2003, "offset": 2000, "pos": 5, "record": {...}}

and yields the same record frame as the pages, so one code path builds the
tables from either.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from finmesh.operators.generators import is_object, keyed_entries
from finmesh.schemas import BROKEN_LINE, DOCUMENT_RECORD, NESTED_RECORD, NOT_RECORDS, PAGE_ENVELOPE, PROJECT_RECORD

# Record frame: ordering columns + key + raw record text.
ORDER = ["landing_seq", "page_year", "page_offset", "pos"]

RAW_DUMP = T.StructType([
    T.StructField("record_key", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("record", DOCUMENT_RECORD),
    T.StructField("nested", NESTED_RECORD),
])


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """All landed pages under ``path`` (explicit schema, no inference); a line that is no envelope is kept in ``broken_line``."""
    return spark.read.schema(PAGE_ENVELOPE).option("columnNameOfCorruptRecord", BROKEN_LINE).json(path)


_PAGE = ["source", "landing_seq", "page_year", "page_offset"]
_KINDS = {"projects": PROJECT_RECORD, "documents": DOCUMENT_RECORD}


def page_entries(pages: DataFrame) -> DataFrame:
    """``source, landing_seq, page_year, page_offset, total, pos, entry_key, entry, unread, reason``: one row per entry
    of every landed page of either kind, each body parsed once (see ``generators.keyed_entries``).  ``reason``
    says why the row is no record (see ``rejected_records``), null where it is one or stands for nothing."""
    line = F.col("source").isNull() & F.col(BROKEN_LINE).isNotNull()
    p = pages.select("source", F.coalesce("seq", F.lit(0)).alias("landing_seq"), F.col("year").alias("page_year"),
                     F.col("offset").alias("page_offset"), F.when(line, F.col(BROKEN_LINE)).otherwise(F.col("body")).alias("body"), line.alias("line"))
    held = {kind: F.col("source") == F.lit(kind) for kind in _KINDS}
    e = keyed_entries(p, "body", held, keep=[*_PAGE, "line"], extra=[("total", T.StringType())])
    whole = F.when(F.col("line"), F.lit("broken line")).when(F.col("source").isin(*_KINDS), F.lit("broken body")).otherwise(F.lit("unknown source"))
    reason = F.when(F.col("unread").isNotNull(), whole).when(
        F.col("pos").isNotNull() & ~is_object("entry") & ~F.col("entry_key").isin(NOT_RECORDS), F.lit("not an object"))
    return e.select(*_PAGE, "total", "pos", "entry_key", "entry", "unread", reason.alias("reason"))


def record_of(schema: T.StructType):
    """An entry's fields as ``schema`` has them."""
    return F.try_variant_get("entry", "$", schema.simpleString())


def _entries_of(pages: DataFrame, kind: str) -> DataFrame:
    return page_entries(pages.filter(F.col("source") == F.lit(kind))).where(is_object("entry"))


def project_records(pages: DataFrame) -> DataFrame:
    """``landing_seq, page_year, page_offset, pos, record_key, record`` for project pages (S1);
    ``record`` is a struct of strings, each got by itself: what is not used is not got.  An entry that is no record is left
    to ``rejected_records``."""
    record = F.struct(*[F.try_variant_get("entry", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in PROJECT_RECORD])
    return _entries_of(pages, "projects").select(*ORDER, F.col("entry_key").alias("record_key"), record.alias("record"))


def project_entries(pages: DataFrame) -> DataFrame:
    """As ``project_records``, with the VARIANT ``entry`` in place of ``record``: for readers of a few fields.  Of a struct from which
    more than one field is taken Spark gets all."""
    return _entries_of(pages, "projects").select(*ORDER, F.col("entry_key").alias("record_key"), "entry")


def document_records(pages: DataFrame) -> DataFrame:
    """Same for document pages, plus the year's ``total`` (S2) and ``nested``: the fields that may hold nested
    maps, null where the value is of another kind (a VARIANT tells a map from a string that looks like one)."""
    parsed = F.struct(record_of(DOCUMENT_RECORD).alias("record"), record_of(NESTED_RECORD).alias("nested"))
    # By a generator: a projection would be merged with those above it, and every field that they take parse the entry again.
    return _entries_of(pages, "documents").select("*", F.inline(F.array(parsed))).select(
        *ORDER, F.col("entry_key").alias("record_key"), "record", "nested", F.col("total").try_cast("long").alias("total"))


def rejected_records(pages: DataFrame) -> DataFrame:
    """The quarantine (P13): ``source, landing_seq, page_year, page_offset, pos, record_key, reason, raw`` of all that landed
    and became no record.

    ``not an object``: an entry of a page (``pos``, ``record_key``), its JSON text; ``broken body``: a page
    whose body cannot be read or lacks the map of records; ``unknown source``: a page of neither
    kind; ``broken line``: a line that is no page."""
    return page_entries(pages).where("reason is not null").select(
        *_PAGE, "pos", F.col("entry_key").alias("record_key"), "reason", F.coalesce("unread", F.to_json("entry")).alias("raw"))


def read_raw_dump(spark: SparkSession, path: str) -> DataFrame:
    """Replay the raw document dump (S3) as a record frame."""
    d = spark.read.schema(RAW_DUMP).json(path)
    return d.select(F.coalesce("seq", F.lit(0)).alias("landing_seq"), F.col("year").alias("page_year"), F.col("offset").alias("page_offset"),
                    "pos", "record_key", "record", "nested", F.lit(None).cast("long").alias("total"))


def page_inventory(pages: DataFrame) -> DataFrame:
    """One row per landed page that can be read: ``source, year, offset, records, total, rejected`` (input of S14).
    ``records`` counts the entries that become records, ``rejected`` those that do not; a page that
    cannot be read has not landed."""
    maps = F.coalesce("__b.documents", "__b.projects")
    x = pages.select("source", "year", "offset", F.from_json("body", "total string, documents map<string,variant>, projects map<string,variant>").alias("__b"))
    x = x.where(maps.isNotNull()).select("source", "year", "offset", F.col("__b.total").try_cast("long").alias("total"),
                                         F.map_values(F.map_filter(maps, lambda k, _: ~k.isin(NOT_RECORDS))).alias("entries"))
    x = x.withColumn("records", F.size(F.filter("entries", is_object)).cast("long"))
    return x.select("source", "year", "offset", "records", "total", (F.size("entries") - F.col("records")).cast("long").alias("rejected"))


def latest_pages(inventory: DataFrame) -> DataFrame:
    """Of pages fetched again one row (the one with most records)."""
    page = ["source", "year", "offset"]
    return inventory.groupBy(*page).agg(F.max(F.struct("records", "total", "rejected")).alias("r")).select(*page, "r.*")
