"""Payload and table schemas.  Explicit everywhere: never infer."""
from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- landing
# One landed page per line: the fetch envelope plus the raw API body.
# ``body`` is declared as a string so Spark keeps the raw JSON text of the
# object, which is then parsed by the source-specific reader.
PAGE_ENVELOPE = T.StructType([
    T.StructField("source", T.StringType()),   # 'projects' | 'documents'
    T.StructField("year", T.IntegerType()),    # document pages are fetched per year
    T.StructField("offset", T.LongType()),     # page offset within its year
    T.StructField("seq", T.LongType()),        # landing sequence: a page fetched again has a greater one
    T.StructField("body", T.StringType()),     # raw API response object
    T.StructField("broken_line", T.StringType()),   # the whole line where it is no such envelope
])
BROKEN_LINE = "broken_line"
# Fixed value: a key beside the records of a page.
NOT_RECORDS = ["facets"]


# Nested sector payload of a project record (guarded: only parsed when the
# raw value is a JSON list).
MAJOR_SECTORS = T.ArrayType(T.StructType([
    T.StructField("major_sector", T.StructType([
        T.StructField("major_sector_code", T.StringType()),
        T.StructField("major_sector_name", T.StringType()),
        T.StructField("sectors", T.ArrayType(T.StructType([
            T.StructField("sector_code", T.StringType()),
            T.StructField("sector_name", T.StringType()),
            T.StructField("sector_percent", T.StringType()),
        ]))),
    ])),
]))

# ---------------------------------------------------------------- fixed values
# Fixed values that must equal the source system's field names for right
# results: project record fields kept by the project load, in their order.
PROJECT_FIELDS = [
    "id", "project_name", "countryshortname", "curr_ibrd_commitment",
    "idacommamt", "totalamt", "grantamt", "lendprojectcost",
    "boardapprovaldate", "closingdate", "envassesmentcategorycode",
]
MONEY_FIELDS = ["curr_ibrd_commitment", "idacommamt", "totalamt", "grantamt", "lendprojectcost"]
PROJECT_DATE_FIELDS = ["boardapprovaldate", "closingdate"]

# Document payload field -> documents table column, in table order.
# Fields marked nested hold {'0': {name: value}} maps and go through first_nested_value.
DOCUMENT_FIELD_MAP = [
    ("id", "document_id", False),
    ("docna", "document_name", True),
    ("docty", "document_type", False),
    ("prdln", "prdln", False),
    ("lndinstr", "lndinstr", True),
    ("docdt", "docdt", False),
    ("datestored", "datestored", False),
    ("disclosure_date", "disclosure_date", False),
    ("last_modified_date", "last_modified_date", False),
    ("pdfurl", "pdfurl", False),
    ("txturl", "txturl", False),
    ("url", "url", False),
    ("majdocty", "maj_document_type", False),
    ("disclstat", "disclstat", False),
    ("versiontyp", "versiontype", False),
    ("authors", "author", True),
    ("seccl", "security_class", False),
    ("lang", "lang", False),
    ("repnb", "repnb", False),
    ("volnb", "volnb", False),
    ("display_title", "display_title", False),
    ("chronical_docm_id", "chronical_docm_id", False),
    ("guid", "guid", False),
    ("owner", "owner", False),
    ("projectid", "project_id", False),
]
DOCUMENT_DATE_COLUMNS = ["docdt", "datestored", "disclosure_date", "last_modified_date"]

# Declared text widths of the relational schema (for the length audit).
# Columns not listed are unbounded text.
TEXT_WIDTHS = {
    "country": {"countryshortname": 255, "regionname": 255},
    "projects": {"project_id": 255, "project_name": 255, "countryshortname": 255,
                 "envassesmentcategorycode": 1},
    "major_sector_lookup": {"major_sector_code": 3, "major_sector_name": 255},
    "proj_sector_lookup": {"sector_code": 3, "sector_name": 255},
    "doc_theme_lookup": {"theme_name": 255},
    "doc_sector_lookup": {"sector_name": 255},
    "doc_sub_sector_lookup": {"sub_sector_name": 255},
    "project_major_sectors": {"project_id": 255, "major_sector_code": 3},
    "project_sectors": {"project_id": 255, "sector_code": 3},
    "impagency": {"project_id": 255},
    "borrower": {"project_id": 255},
    "documents": {c: 255 for c in [
        "document_name", "document_type", "prdln", "lndinstr", "pdfurl", "txturl", "url",
        "maj_document_type", "disclstat", "versiontype", "author", "security_class", "lang",
        "repnb", "display_title", "chronical_docm_id", "guid", "owner", "project_id"]},
    "doc_country": {"countryshortname": 255},
    "doc_theme": {"theme_name": 255},
    "doc_sector": {"sector_name": 255},
    "doc_sub_sector": {"sub_sector_name": 255},
}

# Primary keys of the 16 tables.
PRIMARY_KEYS = {
    "country": ["countryshortname"],
    "projects": ["project_id"],
    "major_sector_lookup": ["major_sector_code"],
    "proj_sector_lookup": ["sector_code"],
    "doc_theme_lookup": ["theme_name"],
    "doc_sector_lookup": ["sector_name"],
    "doc_sub_sector_lookup": ["sub_sector_name"],
    "project_major_sectors": ["project_major_sector_id"],
    "project_sectors": ["project_sector_id"],
    "impagency": ["impagency_id"],
    "borrower": ["borrower_id"],
    "documents": ["document_id"],
    "doc_country": ["doc_country_id"],
    "doc_theme": ["doc_theme_id"],
    "doc_sector": ["doc_sector_id"],
    "doc_sub_sector": ["doc_sub_sector_id"],
}

# The 16 foreign keys: (child table, child columns, parent table, parent columns).
FOREIGN_KEYS = [
    ("project_major_sectors", ["project_id"], "projects", ["project_id"]),
    ("project_major_sectors", ["major_sector_code"], "major_sector_lookup", ["major_sector_code"]),
    ("project_sectors", ["project_id"], "projects", ["project_id"]),
    ("project_sectors", ["project_major_sector_id"], "project_major_sectors", ["project_major_sector_id"]),
    ("project_sectors", ["sector_code"], "proj_sector_lookup", ["sector_code"]),
    ("impagency", ["project_id"], "projects", ["project_id"]),
    ("borrower", ["project_id"], "projects", ["project_id"]),
    ("documents", ["project_id"], "projects", ["project_id"]),
    ("doc_country", ["document_id"], "documents", ["document_id"]),
    ("doc_country", ["countryshortname"], "country", ["countryshortname"]),
    ("doc_theme", ["document_id"], "documents", ["document_id"]),
    ("doc_theme", ["theme_name"], "doc_theme_lookup", ["theme_name"]),
    ("doc_sector", ["document_id"], "documents", ["document_id"]),
    ("doc_sector", ["sector_name"], "doc_sector_lookup", ["sector_name"]),
    ("doc_sub_sector", ["document_id"], "documents", ["document_id"]),
    ("doc_sub_sector", ["sub_sector_name"], "doc_sub_sector_lookup", ["sub_sector_name"]),
]

# NOT NULL columns (besides the primary keys).
NOT_NULL = {
    "project_major_sectors": ["project_id", "major_sector_code"],
    "project_sectors": ["project_id", "project_major_sector_id", "sector_code"],
}

# The sector mart read by the chart (typed CSV scan).
SECTOR_MART = T.StructType([
    T.StructField("project_id", T.StringType()),
    T.StructField("countryshortname", T.StringType()),
    T.StructField("totalamt", T.DecimalType(20, 2)),
    T.StructField("major_sector_code", T.StringType()),
    T.StructField("major_sector_name", T.StringType()),
    T.StructField("sector_code", T.StringType()),
    T.StructField("sector_name", T.StringType()),
    T.StructField("sector_percent", T.DecimalType(5, 2)),
    T.StructField("allocated_amount", T.DecimalType(30, 8)),
])


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Records parsed once, every field as a string: any JSON value fits a string
# field (objects and lists keep their raw JSON text), so a mistyped field never
# nulls its siblings.  Unknown fields are ignored.
PROJECT_RECORD = _strings(PROJECT_FIELDS + ["regionname", "major_sectors", "borrower", "impagency"])
DOCUMENT_RECORD = _strings([f for f, _, _ in DOCUMENT_FIELD_MAP] + ["sectr", "theme", "subsc", "count"])

# The fields that may hold {'0': {name: value}}, parsed as such: null where the
# value is of another kind, e.g. a string that looks like a map.
NESTED_RECORD = T.StructType([
    T.StructField(f, T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType())))
    for f, _, nested in DOCUMENT_FIELD_MAP if nested])
