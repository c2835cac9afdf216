"""The 16 normalised tables (R10) from landed record frames.

Project side (from project records, duplicates across pages kept, as the
source keeps them when exploding children):

    country, projects, major_sector_lookup, proj_sector_lookup,
    project_major_sectors, project_sectors, impagency, borrower

Document side (records with a truthy ``projectid``, last write wins per key):

    documents, doc_sector_lookup, doc_sector, doc_theme_lookup, doc_theme,
    doc_sub_sector_lookup, doc_sub_sector, doc_country

Tables are built when asked for.  The documents are parsed once: the kept records are stored when the
first table asks for them, and every table reads the stored frame; so are the flat project records where the tables are
built together.  The other eager steps are the numberings that surrogate ids need (one for all document bridges, and
one for all project bridges where they are built together).
Surrogate ids follow insertion order: page order, position in the page,
position inside the nested list.
"""
from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from finmesh.functions.coerce import (
    parse_date, parse_decimal, parse_int_id, parse_int_number, truthy,
)
from finmesh.functions.nested import first_of_nested
from finmesh.functions.text import clean_items, lower_items, split_comma_nospace, split_plain
from finmesh.operators.dedup import keep_first, last_write_wins
from finmesh.operators.generators import (
    explode_delimited, explode_major_sectors, explode_sectors, major_sector_items, map_items,
    parse_major_sectors, sector_items,
)
from finmesh.operators.joins import keep_known
from finmesh.operators.merge import merge_by_key, read_merged
from finmesh.operators.keys import resolve_parent_key, with_item_numbers, with_list_offsets, with_list_offsets_by_page, with_surrogate_key, with_totals_before
from finmesh.schemas import (
    DOCUMENT_DATE_COLUMNS, DOCUMENT_FIELD_MAP, DOCUMENT_RECORD, MONEY_FIELDS, NESTED_RECORD,
    PROJECT_DATE_FIELDS, PROJECT_FIELDS, PROJECT_RECORD,
)
from finmesh.session import scratch_path, shuffles_freed
from finmesh.sources.pages import ORDER
from finmesh.sources.sinks import append_load, read_back

_PROJECT_EXTRA = ["regionname", "major_sectors", "borrower", "impagency"]


def _field(m: str, name: str):
    return F.col(f"{m}.{name}")


def as_records(records: DataFrame, schema) -> DataFrame:
    """Accept record frames whose ``record`` is raw JSON text (parsed here) or
    already a struct (parsed with its page)."""
    if dict(records.dtypes)["record"] == "string":
        # by a generator, so that it is parsed once and not again for every field that is taken
        return records.select(*[c for c in records.columns if c != "record"], F.explode(F.array(F.from_json("record", schema))).alias("record"))
    return records


# ------------------------------------------------------------------ projects
def flatten_projects(records: DataFrame) -> DataFrame:
    """Record frame -> one row per landed project record, raw string fields.  Of a frame of entries (``pages.project_entries``)
    only the fields that are used are got."""
    if "entry" in records.columns:
        m, got = records, {f.name: F.try_variant_get("entry", f"$.{f.name}", f.dataType.simpleString()) for f in PROJECT_RECORD}
    else:
        m, got = as_records(records, PROJECT_RECORD), {f.name: _field("record", f.name) for f in PROJECT_RECORD}
    flat = m.select(*ORDER, *[got[f].alias(f) for f in PROJECT_FIELDS + _PROJECT_EXTRA])
    # parse the nested sector list once (null unless it is a JSON list)
    return flat.withColumn("major_sectors", parse_major_sectors("major_sectors"))


def build_country(flat: DataFrame) -> DataFrame:
    """Region nulled where equal to the country (P5), positional first row per
    country (P6), null country dropped (P7)."""
    c = flat.select(*ORDER, "countryshortname",
                    F.nullif(F.col("regionname"), F.col("countryshortname")).alias("regionname"))
    c = c.filter(F.col("countryshortname").isNotNull())
    return keep_first(c, ["countryshortname"], ORDER).select("countryshortname", "regionname")


def build_projects(flat: DataFrame) -> DataFrame:
    """Fixed columns, ``id -> project_id``, first row per id, coerced types."""
    p = flat.select(*ORDER, *[F.col(f) for f in PROJECT_FIELDS]).withColumnRenamed("id", "project_id")
    p = p.filter(F.col("project_id").isNotNull())
    p = keep_first(p, ["project_id"], ORDER)
    cols = []
    for f in PROJECT_FIELDS:
        name = "project_id" if f == "id" else f
        c = F.col(name)
        if f in MONEY_FIELDS:
            c = parse_decimal(c, 20, 2)
        elif f in PROJECT_DATE_FIELDS:
            c = parse_date(c)
        cols.append(c.alias(name))
    return p.select(*cols)


def major_sector_rows(flat: DataFrame) -> DataFrame:
    return explode_major_sectors(flat, "major_sectors", keep=[*ORDER, "id"])


def sector_rows(flat: DataFrame) -> DataFrame:
    return explode_sectors(flat, "major_sectors", keep=[*ORDER, "id"])


def build_major_sector_lookup(ms_rows: DataFrame) -> DataFrame:
    """First name seen per code."""
    r = ms_rows.filter(F.col("major_sector_code").isNotNull())
    first = keep_first(r.select(*ORDER, "ms_pos", "major_sector_code", "major_sector_name"),
                       ["major_sector_code"], [*ORDER, "ms_pos"])
    return first.select("major_sector_code", "major_sector_name")


def build_proj_sector_lookup(s_rows: DataFrame) -> DataFrame:
    r = s_rows.filter(F.col("sector_code").isNotNull())
    first = keep_first(r.select(*ORDER, "ms_pos", "s_pos", "sector_code", "sector_name"),
                       ["sector_code"], [*ORDER, "ms_pos", "s_pos"])
    return first.select("sector_code", "sector_name")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored in the shared scratch folder and read back."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.parquet(path)


class _Lazy(Mapping):
    """Tables by name; each is built when first asked for."""

    names: tuple[str, ...] = ()

    def __init__(self):
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.names:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = getattr(self, f"_{name}")()
        return self._built[name]

    def __iter__(self):
        return iter(self.names)

    def __len__(self):
        return len(self.names)


class ProjectTables(_Lazy):
    """The project side.  ``shared``: most of the tables will be asked for, so the flat records are stored and all four
    bridges numbered at once by their list sizes; otherwise each table parses the fields that it needs and numbers its items."""

    names = ("country", "projects", "major_sector_lookup", "proj_sector_lookup",
             "project_major_sectors", "project_sectors", "impagency", "borrower")

    def __init__(self, records: DataFrame, shared: bool = True):
        super().__init__()
        self.records, self.shared = records, shared

    @cached_property
    def flat(self) -> DataFrame:
        """One row per landed record; where shared stored, with ``row_no`` to tell the rows apart."""
        flat = flatten_projects(self.records)
        return _stored(flat.withColumn("row_no", F.monotonically_increasing_id()), "project-flat") if self.shared else flat

    @cached_property
    def _parents(self) -> DataFrame:
        """Order, id, country and region of every record, stored: tables that look records up in them parse no page again."""
        return _stored(self.flat.select(*ORDER, "id", "countryshortname", "regionname"), "project-parents")

    @cached_property
    def known_ids(self) -> DataFrame:
        """The ids of ``projects`` for semi joins; where not shared stored, each once."""
        if self.shared:
            return self.flat.select(F.col("id").alias("project_id"))
        return _stored(self._parents.select(F.col("id").alias("project_id")).distinct(), "project-ids")

    def _listed(self, *lists: str) -> DataFrame:
        """Order, id and the lists of every record."""
        flat = self.flat
        if "sectors" in lists:      # by a generator: the list is parsed once, not for each of those taken from it
            others = [c for c in flat.columns if c != "major_sectors"]
            flat = flat.select(*others, F.explode(F.array("major_sectors")).alias("major_sectors"))
        items = {"borrowers": lambda: clean_items(split_plain("borrower")), "agencies": lambda: clean_items(split_plain("impagency")),
                 "majors": lambda: F.transform(major_sector_items(flat, "major_sectors"), lambda m: m["major_sector_code"]),
                 "sectors": lambda: F.transform(sector_items(flat, "major_sectors"), lambda s: F.struct(
                     *[s[f].alias(f) for f in ("major_sector_code", "sector_code", "sector_percent")]))}
        row = [c for c in ("row_no",) if c in flat.columns]
        return flat.select(*row, *ORDER, "id", *[items[name]().alias(name) for name in lists])

    @cached_property
    def lists(self) -> DataFrame:
        """Ids and the four lists of every record and, for each list, the items before it; stored, for all bridges."""
        names, (*page, pos) = ["borrowers", "agencies", "majors", "sectors"], ORDER
        rows = with_list_offsets_by_page(self._listed(*names), page, [pos, "row_no"], names)
        return _stored(rows.drop("row_no", *ORDER), "list-offsets")

    @cached_property
    def _sector_lists(self) -> DataFrame:
        return _stored(self._listed("majors", "sectors"), "project-lists")

    def _bridge(self, items: str, id_name: str, out: str) -> DataFrame:
        """``id, <id_name>, <out>``: the items of a list, numbered."""
        if self.shared:
            x = self.lists.select("id", f"{items}_before", F.posexplode(items).alias("at", out))
            return x.select("id", (F.col(f"{items}_before") + F.col("at") + 1).alias(id_name), out)
        both = items == "sectors" or items == "majors" and "_sector_lists" in vars(self)
        rows = self._sector_lists if both else _stored(self._listed(items), "project-lists")
        return with_item_numbers(rows, ORDER, items, id_name, out, ["id"])

    def _names(self, items: str, id_name: str, out: str) -> DataFrame:
        return self._bridge(items, id_name, out).select(id_name, out, F.col("id").alias("project_id"))

    def _country(self):
        return build_country(self._parents if "_parents" in vars(self) else self.flat)

    def _projects(self):
        return build_projects(self.flat)

    def _major_sector_lookup(self):
        return build_major_sector_lookup(major_sector_rows(self.flat))

    def _proj_sector_lookup(self):
        return build_proj_sector_lookup(sector_rows(self.flat))

    def _borrower(self):
        """Plain comma split (F1), stripped, empties dropped."""
        return self._names("borrowers", "borrower_id", "borrower_name")

    def _impagency(self):
        return self._names("agencies", "impagency_id", "impagency_name")

    def _project_major_sectors(self):
        """One row per project x major sector entry, surrogate id in insertion order."""
        x = self._bridge("majors", "project_major_sector_id", "major_sector_code")
        return x.select("project_major_sector_id", F.col("id").alias("project_id"), "major_sector_code")

    def _project_sectors(self):
        """Sector bridge with the parent's surrogate id resolved by
        (project_id, major_sector_code) to one parent (J5)."""
        x = self._bridge("sectors", "project_sector_id", "s")
        children = x.select("project_sector_id", F.col("id").alias("project_id"), F.col("s.major_sector_code").alias("major_sector_code"),
                            F.col("s.sector_code").alias("sector_code"), parse_decimal("s.sector_percent", 5, 2).alias("sector_percent"))
        r = resolve_parent_key(children, self["project_major_sectors"], ["project_id", "major_sector_code"], "project_major_sector_id")
        return r.select("project_sector_id", "project_id", "project_major_sector_id", "sector_code", "sector_percent")


def build_project_tables(records: DataFrame, shared: bool = True) -> ProjectTables:
    return ProjectTables(records, shared)


# ------------------------------------------------------------------ documents
def kept_documents(records: DataFrame, taken: Mapping[str, Column] | None = None) -> DataFrame:
    """Records with a truthy ``projectid`` (P3), newest value per record key
    (A7) at the key's first-seen position: ``first_seen, record_key, record, nested``.

    ``taken``: columns of ``record`` and ``nested`` to come instead of them, so that nothing else is shuffled.  Of records that
    landed at the same place the same one is then kept, whatever is taken."""
    m = as_records(records, DOCUMENT_RECORD)
    if dict(m.dtypes).get("nested") == "string":
        m = m.withColumn("nested", F.from_json("nested", NESTED_RECORD))
    m = m.select(*ORDER, "record_key", "record", "nested").filter(truthy(_field("record", "projectid")))
    if taken is None:
        return last_write_wins(m, ["record_key"], ORDER, first_seen_as="first_seen").select(
            "first_seen", "record_key", "record", "nested")
    m = m.select(*ORDER, F.xxhash64("record").alias("same_place"), "record_key", *[c.alias(name) for name, c in taken.items()])
    kept = last_write_wins(m, ["record_key"], [*ORDER, "same_place"], first_seen_as="first_seen")
    return kept.select(F.struct(*[f"first_seen.{c}" for c in ORDER]).alias("first_seen"), "record_key", *taken)


def merge_documents(records: DataFrame, path: str) -> int:
    """Merge newly landed document records into the kept ones stored at ``path``: only the buckets
    of their keys are written.  ``merged_documents`` then equals ``kept_documents`` of all records so far."""
    m = as_records(records, DOCUMENT_RECORD).select(*ORDER, "record_key", "record", "nested").filter(truthy(_field("record", "projectid")))
    return merge_by_key(m, path, ["record_key"], ORDER)


def merged_documents(spark: SparkSession, path: str) -> DataFrame:
    return read_merged(spark, path).select("first_seen", "record_key", "record", "nested")


def flatten_documents(kept: DataFrame) -> DataFrame:
    """25 documented columns, uncleaned (the bronze layer, S5), beside
    ``first_seen`` and ``record_key``."""
    cols = []
    for field, name, nested in DOCUMENT_FIELD_MAP:
        raw = _field("record", field)
        cols.append((first_of_nested(_field("nested", field), raw) if nested else raw).alias(name))
    return kept.select("first_seen", "record_key", *cols)


def clean_documents(flat_docs: DataFrame) -> DataFrame:
    """Dates (F5), volume number (F7), integer id."""
    typed = {**{c: parse_date(c) for c in DOCUMENT_DATE_COLUMNS},
             "volnb": parse_int_number("volnb"), "document_id": parse_int_id("document_id")}
    return flat_docs.withColumns(typed)


def build_documents(flat_docs: DataFrame, projects: DataFrame) -> DataFrame:
    """Cleaned documents that have an id and whose project exists."""
    cleaned = clean_documents(flat_docs.filter(truthy("document_id")))
    kept = keep_known(cleaned, projects, ["project_id"])
    return kept.drop("first_seen", "record_key")


class DocumentTables(_Lazy):
    """The document side.  Children belong to records with a truthy id (P4) whose
    project exists.  ``shared``: most of the tables will be asked for, so the kept records are stored and all three bridges
    numbered at once by their list sizes; otherwise each table takes the fields that it needs from the records."""

    names = ("documents", "doc_sector_lookup", "doc_sector", "doc_theme_lookup", "doc_theme",
             "doc_sub_sector_lookup", "doc_sub_sector", "doc_country")
    # The lists of a record: the field that holds each, and its items.
    _LISTS = {"sectors": ("sectr", lambda c: map_items(c, "sector")), "themes": ("theme", lambda c: clean_items(split_comma_nospace(c))),
              "sub_sectors": ("subsc", lambda c: lower_items(clean_items(split_comma_nospace(c))))}

    def __init__(self, records: DataFrame, projects: DataFrame, country: DataFrame, shared: bool = True):
        super().__init__()
        self.records, self.projects, self.country, self.shared = records, projects, country, shared

    @cached_property
    def kept(self) -> DataFrame:
        """The newest record of each key, parsed once and stored, with ``row_no`` to tell the rows apart."""
        return _stored(kept_documents(self.records).withColumn("row_no", F.monotonically_increasing_id()), "document-kept")

    def _with_id(self, **taken) -> DataFrame:
        """Kept records with an id: their order, key and ids and the columns ``taken`` from them."""
        taken = {"raw_id": _field("record", "id"), "project_id": _field("record", "projectid")} | taken
        if self.shared:
            rows = self.kept.select("row_no", "first_seen", "record_key", *[c.alias(name) for name, c in taken.items()])
        else:
            rows = kept_documents(self.records, taken)
        return rows.select("first_seen.*", *[c for c in rows.columns if c != "first_seen"]).filter(truthy("raw_id"))

    @cached_property
    def lists(self) -> DataFrame:
        """The three lists of every inserted record and, for each, the items before it; stored, for all that is made of them.  Only
        sizes are joined to the projects and summed."""
        lists = {name: items(_field("record", field)) for name, (field, items) in self._LISTS.items()}
        sizes = keep_known(self._with_id(**{name: F.size(c) for name, c in lists.items()}), self.projects, ["project_id"])
        rows = self._with_id(count=_field("record", "count"), **lists).select("row_no", *ORDER, "raw_id", "count", *lists)
        return _stored(with_list_offsets(rows, ORDER, list(lists), row="row_no", sizes=sizes), "document-lists")

    def _numbered_list(self, name: str) -> DataFrame:
        """``raw_id``, one list of every record and the items before it.  Only sizes are joined to the projects and summed."""
        field, items = self._LISTS[name]
        items = items(_field("record", field))
        if name == "themes":        # whole texts: parsed again where they are joined to their numbers, rather than stored and shuffled once more
            lists, sizes = self._with_id(**{name: items}), self._with_id(size=F.size(items))
        else:
            lists = _stored(self._with_id(**{name: items}), "document-list")
            sizes = lists.withColumn("size", F.size(name))
        sizes = sizes.withColumn("size", F.greatest(F.coalesce("size", F.lit(0)), F.lit(0)).cast("long"))
        inserted = keep_known(sizes, self.projects, ["project_id"]).select(*ORDER, "record_key", "size")
        before, _ = with_totals_before(inserted, [*ORDER, "record_key"], ["size"])
        numbered = lists.select("record_key", "raw_id", name).join(before.select("record_key", "size_before"), "record_key")
        return numbered.withColumnRenamed("size_before", f"{name}_before")

    def _bridge(self, items: str, id_name: str, out: str) -> DataFrame:
        lists = self.lists if self.shared else self._numbered_list(items)
        x = lists.select("raw_id", f"{items}_before", F.posexplode(items).alias("at", out))
        return x.select((F.col(f"{items}_before") + F.col("at") + 1).alias(id_name), out, parse_int_id("raw_id").alias("document_id"))

    def _documents(self):
        if self.shared:
            return build_documents(flatten_documents(self.kept), self.projects)
        record = F.struct(*[_field("record", field).alias(field) for field, _, _ in DOCUMENT_FIELD_MAP])
        return build_documents(flatten_documents(kept_documents(self.records, {"record": record, "nested": F.col("nested")})), self.projects)

    def _doc_sector(self):
        return self._bridge("sectors", "doc_sector_id", "sector_name")

    def _doc_theme(self):
        return self._bridge("themes", "doc_theme_id", "theme_name")

    def _doc_sub_sector(self):
        return self._bridge("sub_sectors", "doc_sub_sector_id", "sub_sector_name")

    def _doc_sector_lookup(self):
        return self["doc_sector"].select("sector_name").distinct()

    def _doc_theme_lookup(self):
        return self["doc_theme"].select("theme_name").distinct()

    def _doc_sub_sector_lookup(self):
        """Spans all documents with an id, not only inserted ones."""
        return explode_delimited(self._with_id(subsc=_field("record", "subsc")), "subsc", "sub_sector_name", lower=True).distinct()

    def _doc_country(self):
        """Inserted documents only, and only countries already known."""
        inserted = self.lists if self.shared else keep_known(self._with_id(count=_field("record", "count")), self.projects, ["project_id"])
        named = explode_delimited(inserted, "count", "countryshortname", keep=[*ORDER, "raw_id"], pos="entry_pos")
        known = with_surrogate_key(keep_known(named, self.country, ["countryshortname"]), [*ORDER, "entry_pos"], "doc_country_id")
        return known.select("doc_country_id", "countryshortname", parse_int_id("raw_id").alias("document_id"))


def build_document_tables(records: DataFrame, projects: DataFrame, country: DataFrame, shared: bool = True) -> DocumentTables:
    return DocumentTables(records, projects, country, shared)


def build_all(project_recs: DataFrame, document_recs: DataFrame) -> Mapping[str, DataFrame]:
    """All 16 tables, each built when asked for."""
    p = build_project_tables(project_recs)
    return ChainMap(p, build_document_tables(document_recs, p["projects"], p["country"]))


def store_all(project_recs: DataFrame, document_recs: DataFrame, base: str, batch: str = "all") -> dict[str, DataFrame]:
    """All 16 tables stored once below ``base`` and read back: what comes after (audits, counts, marts) reads the stored
    tables.  A ``batch`` that is stored already is not stored again."""
    spark = project_recs.sparkSession
    p = build_project_tables(project_recs)
    append_load(p, base, f"{batch}-projects")
    out = {name: read_back(spark, base, name) for name in p}
    d = build_document_tables(document_recs, out["projects"], out["country"])
    append_load(d, base, f"{batch}-documents")
    return out | {name: read_back(spark, base, name) for name in d}
