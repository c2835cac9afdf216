"""Registered queries on the driver tables, each with an independent SQL oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the library operators on
the whole driver tables (through the stand-in model of ``standins``);
``ORACLE[name]`` is ANSI SQL (DuckDB dialect) over the same tables that must
give the same rows.  Column names and types are aligned on both sides.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from finmesh.functions.coerce import (
    parse_date, parse_decimal, parse_int_id, parse_int_number,
)
from finmesh.functions.nested import first_nested_value, json_field
from finmesh.operators import audit
from finmesh.operators.dedup import distinct_values, keep_first, keep_last
from finmesh.operators.generators import (
    explode_delimited, explode_major_sectors, explode_map_field, explode_sectors,
)
from finmesh.operators.filters import exclude_members
from finmesh.operators.joins import keep_known
from finmesh.operators.merge import merge_by_key, read_merged
from finmesh.operators.keys import fanout_report, resolve_parent_key, with_surrogate_key
from finmesh.plans import marts, normalize, pageplan
from finmesh.plans.landed import write_document_pages
from finmesh.plans import standins as S
from finmesh.plans.standins import DriverTables, percent_of_discount
from finmesh.session import scratch, scratch_path
from finmesh.sources import pages as P
from finmesh.sources import sinks
from finmesh.sources.files import read_table, read_typed_csv

# The country of the flagship chart and the sector names hand-excluded
# from it (driver-table stand-ins for the chart's country filter and exclusion list).
FLAGSHIP_COUNTRY = "NATION_7"
EXCLUDED_SECTORS = [
    "blue anvil", "blue bolt", "blue gear", "blue gizmo", "blue plate", "blue ring",
    "blue rod", "blue widget", "red anvil", "red bolt", "red gear", "red gizmo",
    "red plate", "red ring", "red rod", "red widget",
]
TOP_K = 10
# Page geometry for the page-plan stand-in (events per day instead of documents per year).
PAGE_SIZE, SERVED = 100, 1_000
# Declared text width for the length audit (VARCHAR(255)).
TEXT_WIDTH = 255

# White space by Python's str.isspace(), written out for the oracle on its own.
_WS = "[" + "".join(chr(c) for c in range(0x110000) if chr(c).isspace()) + "]"
_STRIP = f"^{_WS}+|{_WS}+$"


def _sql_list(xs):
    return ", ".join("'" + x.replace("'", "''") + "'" for x in xs)


def _strip_sql(expr: str) -> str:
    return f"regexp_replace({expr}, '{_STRIP}', '', 'g')"


# ------------------------------------------------------------------ SQL stand-ins
CTE_PROJECTS = """projects_m AS (
  SELECT o.o_orderkey AS project_id, n.n_name AS countryshortname,
         CAST(o.o_totalprice AS DECIMAL(20,2)) AS totalamt,
         CAST(o.o_orderdate AS DATE) AS boardapprovaldate
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""
PCT = "CAST(CAST({c} AS DECIMAL(4,2)) * 100 AS DECIMAL(5,2))"
CTE_PS = f"""ps_m AS (
  SELECT l.l_orderkey AS project_id,
         CAST(l.l_orderkey AS VARCHAR) || '|' || p.p_type AS project_major_sector_id,
         l.l_partkey AS sector_code, {PCT.format(c='l.l_discount')} AS sector_percent
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""
CTE_PS_LEAN = f"""psl_lean AS (
  SELECT l_orderkey AS project_id, l_partkey AS sector_code,
         {PCT.format(c='l_discount')} AS sector_percent FROM lineitem)"""
CTE_PMS = """pms_m AS (
  SELECT DISTINCT CAST(l.l_orderkey AS VARCHAR) || '|' || p.p_type AS project_major_sector_id,
         l.l_orderkey AS project_id, p.p_type AS major_sector_code
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""
CTE_PSL = "sl_m AS (SELECT p_partkey AS sector_code, p_name AS sector_name FROM part)"
CTE_MSL = ("msl_m AS (SELECT DISTINCT p_type AS major_sector_code, "
           "lower(p_type) AS major_sector_name FROM part)")
CTE_DOCS = """doc_m AS (
  SELECT l_orderkey * 100 + l_linenumber AS document_id, l_orderkey AS project_id,
         CAST(l_shipdate AS DATE) AS docdt, l_returnflag AS document_type FROM lineitem)"""
ALLOC = "CAST(p.totalamt * ps.sector_percent * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(30,8))"
CTE_MART = f"""mart AS (
  SELECT p.project_id, p.countryshortname, p.totalamt, msl.major_sector_code,
         msl.major_sector_name, sl.sector_code, sl.sector_name, ps.sector_percent,
         {ALLOC} AS allocated_amount
  FROM projects_m p
  JOIN pms_m pms ON p.project_id = pms.project_id
  JOIN msl_m msl ON pms.major_sector_code = msl.major_sector_code
  JOIN ps_m ps ON pms.project_major_sector_id = ps.project_major_sector_id
  JOIN sl_m sl ON ps.sector_code = sl.sector_code)"""
CTE_ALLOC = f"""alloc AS (
  SELECT p.countryshortname, sl.sector_name, {ALLOC} AS allocated_amount
  FROM projects_m p JOIN psl_lean ps ON p.project_id = ps.project_id
  JOIN sl_m sl ON ps.sector_code = sl.sector_code)"""
CTE_COUNTRY_ROWS = """country_rows AS (
  SELECT o.o_orderkey AS pos, CASE WHEN c.c_custkey % 97 = 0 THEN 'Other' ELSE n.n_name END AS countryshortname,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN CASE WHEN c.c_custkey % 97 = 0 THEN 'Other' ELSE n.n_name END
              WHEN '2-HIGH' THEN 'Other' WHEN '3-MEDIUM' THEN NULL ELSE r.r_name END AS regionname
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""
CTE_COUNTRY = """country_m AS (
  SELECT countryshortname, regionname FROM (
    SELECT countryshortname, NULLIF(regionname, countryshortname) AS regionname,
           row_number() OVER (PARTITION BY countryshortname ORDER BY pos) AS rn
    FROM country_rows WHERE countryshortname IS NOT NULL) WHERE rn = 1)"""
CTE_F2 = """f2 AS (
  SELECT doc_id, replace(piece, chr(57344), ', ') AS piece FROM (
    SELECT doc_id, unnest(string_split(replace(text, ', ', chr(57344)), ',')) AS piece
    FROM documents))"""
CTE_SECTOR_JOIN = """j AS (
  SELECT l.*, p.p_name, p.p_type FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE: dict[str, str] = {}
QUERIES: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ================================================================== marts R1-R8
@query("top_sectors_for_country", _with(CTE_PROJECTS, CTE_PS_LEAN, CTE_PSL, CTE_ALLOC) + f"""
SELECT sector_name, CAST(SUM(allocated_amount) AS DECIMAL(38,8)) AS allocated_amount
FROM alloc WHERE countryshortname = '{FLAGSHIP_COUNTRY}'
GROUP BY sector_name ORDER BY allocated_amount DESC, sector_name LIMIT {TOP_K}""")
def q_top_sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R8 (flagship): top sectors of one country by allocated amount."""
    t = DriverTables(spark, sf_dir)
    return marts.top_sectors_preaggregated(S.projects(t), S.project_sectors_lean(t),
                                           S.proj_sector_lookup(t), FLAGSHIP_COUNTRY, TOP_K)


@query("top_sectors_excluding", _with(CTE_PROJECTS, CTE_PS_LEAN, CTE_PSL, CTE_ALLOC) + f"""
SELECT sector_name, CAST(SUM(allocated_amount) AS DECIMAL(38,8)) AS allocated_amount
FROM alloc WHERE countryshortname = '{FLAGSHIP_COUNTRY}'
  AND (sector_name IS NULL OR sector_name NOT IN ({_sql_list(EXCLUDED_SECTORS)}))
GROUP BY sector_name ORDER BY allocated_amount DESC, sector_name LIMIT {TOP_K}""")
def q_top_sectors_excluding(spark, sf_dir):
    """R8 with the hand-made exclusion list."""
    t = DriverTables(spark, sf_dir)
    return marts.top_sectors_preaggregated(S.projects(t), S.project_sectors_lean(t),
                                           S.proj_sector_lookup(t), FLAGSHIP_COUNTRY, TOP_K,
                                           exclude=EXCLUDED_SECTORS)


@query("top_sectors_from_mart", _with(CTE_PROJECTS, CTE_PS, CTE_PMS, CTE_PSL, CTE_MSL, CTE_MART) + f"""
SELECT sector_name, CAST(SUM(allocated_amount) AS DECIMAL(38,8)) AS allocated_amount
FROM mart WHERE countryshortname = '{FLAGSHIP_COUNTRY}'
GROUP BY sector_name ORDER BY allocated_amount DESC, sector_name LIMIT {TOP_K}""")
def q_top_sectors_from_mart(spark, sf_dir):
    """R8 exactly as the chart reads it: over the 9-column mart."""
    t = DriverTables(spark, sf_dir)
    m = S.model(t)
    mart = marts.sector_mart(m["projects"], m["project_major_sectors"], m["major_sector_lookup"],
                             m["project_sectors"], m["proj_sector_lookup"])
    return marts.top_sectors(mart, FLAGSHIP_COUNTRY, TOP_K)


@query("project_document_dates", _with(CTE_PROJECTS, CTE_DOCS) + """
SELECT p.project_id, p.countryshortname, p.boardapprovaldate, d.docdt, d.document_type, d.document_id
FROM projects_m p JOIN doc_m d ON p.project_id = d.project_id""")
def q_project_document_dates(spark, sf_dir):
    t = DriverTables(spark, sf_dir)
    return marts.project_document_dates(S.projects(t), S.documents(t))


@query("project_sector_percent", _with(CTE_PROJECTS, CTE_PS_LEAN, CTE_PSL) + """
SELECT p.project_id, sl.sector_name, ps.sector_percent
FROM projects_m p JOIN psl_lean ps ON ps.project_id = p.project_id
JOIN sl_m sl ON sl.sector_code = ps.sector_code""")
def q_project_sector_percent(spark, sf_dir):
    t = DriverTables(spark, sf_dir)
    return marts.project_sector_percent(S.project_ids(t), S.project_sectors_lean(t), S.proj_sector_lookup(t))


@query("project_major_sector", _with(CTE_PROJECTS, CTE_PMS, CTE_MSL) + """
SELECT p.project_id, msl.major_sector_name
FROM projects_m p JOIN pms_m pms ON pms.project_id = p.project_id
JOIN msl_m msl ON msl.major_sector_code = pms.major_sector_code""")
def q_project_major_sector(spark, sf_dir):
    t = DriverTables(spark, sf_dir)
    return marts.project_major_sector(S.project_ids(t), S.project_major_sectors(t), S.major_sector_lookup(t))


@query("project_sector_detail", f"""
SELECT l_orderkey AS project_id, p_type AS major_sector_code, lower(p_type) AS major_sector_name,
       l_partkey AS sector_code, p_name AS sector_name, {PCT.format(c='l_discount')} AS sector_percent
FROM part, lineitem WHERE p_partkey = l_partkey AND l_orderkey IN (SELECT o_orderkey FROM orders)""")
def q_project_sector_detail(spark, sf_dir):
    t = DriverTables(spark, sf_dir)
    m = S.model(t)
    return marts.project_sector_detail(S.project_ids(t), m["project_major_sectors"],
                                       m["major_sector_lookup"], m["project_sectors"],
                                       m["proj_sector_lookup"])


@query("sector_mart", _with(CTE_PROJECTS, CTE_PS, CTE_PMS, CTE_PSL, CTE_MSL, CTE_MART)
       + "SELECT * FROM mart")
def q_sector_mart(spark, sf_dir):
    """The 9-column mart with the allocated amount."""
    t = DriverTables(spark, sf_dir)
    m = S.model(t)
    return marts.sector_mart(m["projects"], m["project_major_sectors"], m["major_sector_lookup"],
                             m["project_sectors"], m["proj_sector_lookup"])


@query("sector_coverage", """
WITH flags AS (SELECT l_orderkey, bool_or(round(l_discount * 100, 2) <> 0) AS nonzero, bool_or(round(l_discount * 100, 2) = 0) AS zero
               FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey)
SELECT count(*) AS projects_with_sector_data,
       count(*) FILTER (WHERE nonzero) AS projects_with_nonzero_percent,
       count(*) FILTER (WHERE zero) AS projects_with_zero_percent FROM flags""")
def q_sector_coverage(spark, sf_dir):
    return marts.sector_coverage(S.project_sectors_lean(DriverTables(spark, sf_dir)))


@query("sector_coverage_total", """
WITH flags AS (SELECT l_orderkey, bool_or(round(l_discount * 100, 2) <> 0) AS nonzero, bool_or(round(l_discount * 100, 2) = 0) AS zero
               FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey)
SELECT (SELECT count(*) FROM orders) AS total_projects, count(*) AS projects_with_sector_data,
       count(*) FILTER (WHERE nonzero) AS projects_with_nonzero_percent,
       count(*) FILTER (WHERE zero) AS projects_with_zero_percent FROM flags""")
def q_sector_coverage_total(spark, sf_dir):
    t = DriverTables(spark, sf_dir)
    return marts.sector_coverage_total(S.project_ids(t), S.project_sectors_lean(t))


# ================================================================== dedup and keys
@query("keep_first", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders) WHERE rn = 1""")
def q_keep_first(spark, sf_dir):
    """Positional first row per key."""
    o = DriverTables(spark, sf_dir)("orders", "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return keep_first(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("last_write_wins", """
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def q_last_write_wins(spark, sf_dir):
    """Newest record per key."""
    e = DriverTables(spark, sf_dir)("events", "user_id", "event_id", "ts", "event_type", "value")
    return keep_last(e, ["user_id"], ["ts", "event_id"])


@query("distinct_lookup", "SELECT DISTINCT lower(c_mktsegment) AS segment FROM customer")
def q_distinct_lookup(spark, sf_dir):
    """Distinct lower-cased names."""
    c = DriverTables(spark, sf_dir)("customer", "c_mktsegment")
    return distinct_values(c, [F.lower("c_mktsegment")], ["segment"])


@query("sub_sector_lookup", _with(CTE_F2) + f"""
SELECT DISTINCT lower({_strip_sql('piece')}) AS sub_sector_name FROM f2
WHERE length({_strip_sql('piece')}) > 0""")
def q_sub_sector_lookup(spark, sf_dir):
    """Sub-sector lookup rule over whole texts: comma-not-space split, strip,
    lower, distinct (F2, F3, F4, A5)."""
    d = DriverTables(spark, sf_dir)("documents", "doc_id", "text")
    items = explode_delimited(d, "text", "sub_sector_name", rule="comma_nospace", lower=True)
    return items.select("sub_sector_name").distinct()


@query("surrogate_key", """
SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS key_id
FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""")
def q_surrogate_key(spark, sf_dir):
    """K1: dense 1..n key in a total order, without a single-partition window."""
    li = DriverTables(spark, sf_dir)("lineitem", "l_orderkey", "l_linenumber").distinct()
    return with_surrogate_key(li, ["l_orderkey", "l_linenumber"], "key_id")


_PARENTS_SQL = """p AS (
  SELECT l_orderkey, l_linenumber,
         row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS pid
  FROM lineitem)"""


def _parents_children(spark, sf_dir):
    t = DriverTables(spark, sf_dir)
    cols = [F.col("l_orderkey").alias("project_id"), F.col("l_linenumber").alias("major_sector_code")]
    parents = with_surrogate_key(t("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
                                 ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
                                 "project_major_sector_id")
    parents = parents.select(*cols, "project_major_sector_id")
    children = t("lineitem", "l_orderkey", "l_linenumber", "l_partkey").select(
        *cols, F.col("l_partkey").alias("sector_code"))
    return parents, children


@query("resolve_parent_key", _with(_PARENTS_SQL) + """
, pu AS (SELECT l_orderkey, l_linenumber, min(pid) AS pid FROM p GROUP BY 1, 2)
SELECT c.l_orderkey AS project_id, c.l_linenumber AS major_sector_code, c.l_partkey AS sector_code,
       pu.pid AS project_major_sector_id
FROM lineitem c LEFT JOIN pu ON c.l_orderkey = pu.l_orderkey AND c.l_linenumber = pu.l_linenumber""")
def q_resolve_parent_key(spark, sf_dir):
    """One parent id per child, parents deduplicated first."""
    parents, children = _parents_children(spark, sf_dir)
    return resolve_parent_key(children, parents, ["project_id", "major_sector_code"],
                              "project_major_sector_id")


@query("parent_key_fanout", """
WITH c AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT CAST(sum(n) AS BIGINT) AS child_rows,
       CAST(sum(n * n) AS BIGINT) AS all_mode_rows,
       CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS children_with_repeated_parent,
       count(*) FILTER (WHERE n > 1) AS repeated_parent_keys
FROM c""")
def q_parent_key_fanout(spark, sf_dir):
    """The size of a many-to-many merge, without emitting its pairs."""
    t = DriverTables(spark, sf_dir)
    keys = [F.col("l_orderkey").alias("project_id"), F.col("l_linenumber").alias("major_sector_code")]
    parents = t("lineitem", "l_orderkey", "l_linenumber").select(*keys)   # ids are not needed to count
    children = t("lineitem", "l_orderkey", "l_linenumber").select(*keys)
    return fanout_report(children, parents, ["project_id", "major_sector_code"])


@query("semi_known_parents", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'F')""")
def q_semi_known_parents(spark, sf_dir):
    """Children of kept parents only (left semi join)."""
    t = DriverTables(spark, sf_dir)
    kept = t("orders", "o_orderkey", "o_orderstatus").filter(F.col("o_orderstatus") == "F")
    return keep_known(t("lineitem", "l_orderkey", "l_linenumber", "l_partkey"), kept,
                      ["l_orderkey"], ["o_orderkey"])


@query("semi_known_countries", """
SELECT c_custkey, c_name FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier)""")
def q_semi_known_countries(spark, sf_dir):
    """Customers of the countries that have a supplier."""
    t = DriverTables(spark, sf_dir)
    return keep_known(t("customer", "c_custkey", "c_name", "c_nationkey"), t("supplier", "s_nationkey"),
                      ["c_nationkey"], ["s_nationkey"]).drop("c_nationkey")


@query("exclude_known_members", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_partkey IS NULL OR l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type LIKE '%A%' AND p_partkey IS NOT NULL)""")
def q_exclude_known_members(spark, sf_dir):
    """P9 with the members as a table: an anti join that keeps nulls."""
    t = DriverTables(spark, sf_dir)
    members = t("part", "p_partkey", "p_type").where(F.col("p_type").contains("A")).select("p_partkey")
    return exclude_members(t("lineitem", "l_orderkey", "l_linenumber", "l_partkey"), "l_partkey", members)


# ================================================================== audits K2-K6
_FKS = [
    ("lineitem.l_orderkey->orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem.l_partkey->part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem.l_suppkey->supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders.o_custkey->customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("customer.c_nationkey->nation", "customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier.s_nationkey->nation", "supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation.n_regionkey->region", "nation", "n_regionkey", "region", "r_regionkey"),
    ("orders.o_orderkey->lineitem", "orders", "o_orderkey", "lineitem", "l_orderkey"),
]


@query("fk_audit", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS fk_name, CAST(c.{cc} AS BIGINT) AS orphan_key FROM {ct} c "
    f"WHERE c.{cc} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {pt} p WHERE p.{pc} = c.{cc})"
    for name, ct, cc, pt, pc in _FKS))
def q_fk_audit(spark, sf_dir):
    """Orphans per relation (null child keys pass); the last relation
    lists parents without any child (orders without lines)."""
    t = DriverTables(spark, sf_dir)
    out = None
    for name, ct, cc, pt, pc in _FKS:
        orphans = audit.fk_audit(t(ct, cc), t(pt, pc), [cc], [pc]).select(
            F.lit(name).alias("fk_name"), F.col(cc).cast("long").alias("orphan_key"))
        out = orphans if out is None else out.unionByName(orphans)
    return out


@query("pk_audit", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""")
def q_pk_audit(spark, sf_dir):
    """K2: repeated or null primary keys."""
    li = DriverTables(spark, sf_dir)("lineitem", "l_orderkey", "l_linenumber")
    return audit.pk_audit(li, ["l_orderkey", "l_linenumber"])


@query("null_audit", _with(CTE_COUNTRY_ROWS) + """
, x AS (SELECT countryshortname, NULLIF(regionname, countryshortname) AS regionname FROM country_rows)
SELECT 'countryshortname' AS column_name, count(*) FILTER (WHERE countryshortname IS NULL) AS null_count,
       count(*) AS row_count FROM x
UNION ALL
SELECT 'regionname', count(*) FILTER (WHERE regionname IS NULL), count(*) FROM x""")
def q_null_audit(spark, sf_dir):
    """K4 (+P5): null count per column after nulling regions equal to the country."""
    rows = S.country_rows(DriverTables(spark, sf_dir)).select(
        "countryshortname", F.nullif("regionname", "countryshortname").alias("regionname"))
    return audit.null_audit(rows)


@query("length_audit", "\nUNION ALL\n".join(
    f"SELECT doc_id, '{c}' AS column_name, {TEXT_WIDTH} AS width, CAST(length({c}) AS BIGINT) AS value_length "
    f"FROM documents WHERE length({c}) > {TEXT_WIDTH}" for c in ["text", "lang", "source"]))
def q_length_audit(spark, sf_dir):
    """K5: values over their declared width (whole texts)."""
    d = DriverTables(spark, sf_dir)("documents", "doc_id", "text", "lang", "source")
    return audit.length_audit(d, {"text": TEXT_WIDTH, "lang": TEXT_WIDTH, "source": TEXT_WIDTH},
                              ["doc_id"])


@query("max_length", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(max(length({c})) AS BIGINT) AS max_length FROM documents"
    for c in ["text", "lang", "source"]))
def q_max_length(spark, sf_dir):
    """K5 companion: the width each column would need."""
    d = DriverTables(spark, sf_dir)("documents", "text", "lang", "source")
    return audit.max_length(d, ["text", "lang", "source"])


@query("case_variants", """
WITH tok AS (SELECT unnest(regexp_split_to_array(text, '[^\\p{L}]+')) AS token FROM documents),
sp AS (SELECT token, count(*) AS n FROM tok WHERE token <> '' GROUP BY token)
SELECT lower(token) AS name_key, count(*) AS n_variants, CAST(sum(n) AS BIGINT) AS n_rows
FROM sp GROUP BY 1 HAVING count(*) > 1""")
def q_case_variants(spark, sf_dir):
    """K6: words of the whole texts that differ only by case."""
    d = DriverTables(spark, sf_dir)("documents", "text")
    tokens = d.select(F.explode(F.split("text", r"[^\p{L}]+", -1)).alias("token")).filter(
        F.col("token") != "")
    return audit.case_variant_audit(tokens, "token")


# ================================================================== audits under a collation that ignores case
_NAMES_SQL = """names AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN p_name
  ELSE upper(substr(p_name, 1, 1)) || substr(p_name, 2) END AS name, p_size FROM part)"""


def _named_parts(spark, sf_dir) -> DataFrame:
    """Parts with their names in three spellings: the rows of a lookup keyed by name."""
    at, name = F.pmod("p_partkey", F.lit(3)), F.col("p_name")
    spelt = F.when(at == 0, F.upper(name)).when(at == 1, name).otherwise(F.concat(F.upper(name.substr(1, 1)), F.expr("substr(p_name, 2)")))
    return DriverTables(spark, sf_dir)("part", "p_partkey", "p_name", "p_size").select("p_partkey", spelt.alias("name"), "p_size")


@query("pk_audit_collated", _with(_NAMES_SQL) + """
, lookup AS (SELECT DISTINCT name FROM names)
SELECT min(name) AS name, count(*) AS n, count(*) AS n_spellings FROM lookup GROUP BY lower(name) HAVING count(*) > 1""")
def q_pk_audit_collated(spark, sf_dir):
    """K2 as a database with a collation that ignores case sees it: names of a lookup that are distinct only by case."""
    lookup = distinct_values(_named_parts(spark, sf_dir), ["name"])
    return audit.pk_audit(lookup, ["name"], collation="UTF8_LCASE")


@query("fk_audit_collated", _with(_NAMES_SQL) + """
SELECT p_partkey, name FROM names WHERE lower(name) NOT IN (SELECT lower(name) FROM names WHERE p_size <= 3)""")
def q_fk_audit_collated(spark, sf_dir):
    """K3 under the same collation: names that no spelling in the lookup (the names of the smallest parts) matches."""
    names = _named_parts(spark, sf_dir)
    return audit.fk_audit(names.select("p_partkey", "name"), names.where("p_size <= 3"), ["name"], ["name"], collation="UTF8_LCASE")


# ================================================================== delimited text F1-F3, G4
@query("split_plain", f"""
SELECT doc_id, {_strip_sql('piece')} AS item FROM (
  SELECT doc_id, unnest(string_split(text, ',')) AS piece FROM documents)
WHERE length({_strip_sql('piece')}) > 0""")
def q_split_plain(spark, sf_dir):
    """F1+F3+G4+P14: every comma splits (borrower / agency rule)."""
    d = DriverTables(spark, sf_dir)("documents", "doc_id", "text")
    return explode_delimited(d, "text", "item", rule="plain", keep=["doc_id"])


@query("split_comma_nospace", _with(CTE_F2) + f"""
SELECT doc_id, {_strip_sql('piece')} AS item FROM f2 WHERE length({_strip_sql('piece')}) > 0""")
def q_split_comma_nospace(spark, sf_dir):
    """F2+F3+G4: a comma followed by a space does not split (theme rule)."""
    d = DriverTables(spark, sf_dir)("documents", "doc_id", "text")
    return explode_delimited(d, "text", "item", rule="comma_nospace", keep=["doc_id"])


# ================================================================== nested payloads G1-G3, G5, F6
def _sector_records(t: DriverTables) -> DataFrame:
    """One project record per bridge row, as raw JSON text: two major sectors,
    the second without ``sectors`` unless the line is closed; returned lines
    carry ``major_sectors`` as a string (not a list, so unused)."""
    li = t("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_discount",
           "l_tax", "l_returnflag", "l_linestatus")
    j = li.join(t("part", "p_partkey", "p_name", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    pct, tax = percent_of_discount().cast("string"), percent_of_discount("l_tax").cast("string")

    def sector(code, name, percent):
        return F.struct(code.cast("string").alias("sector_code"), name.alias("sector_name"),
                        percent.alias("sector_percent"))

    ms0 = F.struct(F.struct(F.col("p_type").alias("major_sector_code"),
                            F.lower("p_type").alias("major_sector_name"),
                            F.array(sector(F.col("l_partkey"), F.col("p_name"), pct),
                                    sector(F.col("l_suppkey"), F.lit("supplier"), tax)).alias("sectors"))
                   .alias("major_sector"))
    ms1 = F.struct(F.struct(F.col("l_linestatus").alias("major_sector_code"),
                            F.concat(F.lit("status "), F.col("l_linestatus")).alias("major_sector_name"),
                            F.when(F.col("l_linestatus") == "F", F.array(
                                sector(F.col("l_suppkey"),
                                       F.concat(F.lit("line "), F.col("l_linenumber").cast("string")),
                                       pct))).alias("sectors"))
                   .alias("major_sector"))
    major = F.when(F.col("l_returnflag") == "R", F.lit('"n/a"')).otherwise(F.to_json(F.array(ms0, ms1)))
    record = F.concat(F.lit('{"id":"'), F.col("l_orderkey").cast("string"),
                      F.lit('","major_sectors":'), major, F.lit("}"))
    return j.select(F.lit(0).cast("long").alias("landing_seq"), F.lit(None).cast("int").alias("page_year"),
                    F.lit(0).cast("long").alias("page_offset"), F.lit(0).alias("pos"), record.alias("record"))


_SECTOR_SQL = _with(CTE_SECTOR_JOIN) + ", k AS (SELECT * FROM j WHERE l_returnflag <> 'R')\n"


@query("explode_major_sectors", _SECTOR_SQL + """
SELECT l_orderkey AS project_id, 0 AS ms_pos, p_type AS major_sector_code,
       lower(p_type) AS major_sector_name FROM k
UNION ALL
SELECT l_orderkey, 1, l_linestatus, 'status ' || l_linestatus FROM k""")
def q_explode_major_sectors(spark, sf_dir):
    """G1 (+P13): list of structs into project x major sector rows."""
    flat = normalize.flatten_projects(_sector_records(DriverTables(spark, sf_dir)))
    rows = explode_major_sectors(flat, "major_sectors", keep=["id"])
    return rows.select(F.col("id").cast("long").alias("project_id"), "ms_pos",
                       "major_sector_code", "major_sector_name")


@query("explode_nested_two_level", _SECTOR_SQL + f"""
SELECT l_orderkey AS project_id, 0 AS ms_pos, p_type AS major_sector_code, 0 AS s_pos,
       CAST(l_partkey AS VARCHAR) AS sector_code, p_name AS sector_name,
       {PCT.format(c='l_discount')} AS sector_percent FROM k
UNION ALL
SELECT l_orderkey, 0, p_type, 1, CAST(l_suppkey AS VARCHAR), 'supplier', {PCT.format(c='l_tax')} FROM k
UNION ALL
SELECT l_orderkey, 1, l_linestatus, 0, CAST(l_suppkey AS VARCHAR), 'line ' || CAST(l_linenumber AS VARCHAR),
       {PCT.format(c='l_discount')} FROM k WHERE l_linestatus = 'F'""")
def q_explode_nested_two_level(spark, sf_dir):
    """G2 (+F10, P13): two-level explode with the parent code carried down."""
    flat = normalize.flatten_projects(_sector_records(DriverTables(spark, sf_dir)))
    rows = explode_sectors(flat, "major_sectors", keep=["id"])
    return rows.select(F.col("id").cast("long").alias("project_id"), "ms_pos", "major_sector_code",
                       "s_pos", "sector_code", "sector_name",
                       parse_decimal("sector_percent", 5, 2).alias("sector_percent"))


@query("explode_map", _with(CTE_SECTOR_JOIN) + f"""
SELECT l_orderkey * 100 + l_linenumber AS document_id, 0 AS entry_pos,
       {_strip_sql('p_name')} AS sector_name
FROM j WHERE l_linestatus <> 'O' AND length({_strip_sql('p_name')}) > 0
UNION ALL
SELECT l_orderkey * 100 + l_linenumber, 2, l_returnflag FROM j WHERE l_linestatus <> 'O'""")
def q_explode_map(spark, sf_dir):
    """``{"0": {"sector": ..}, ..}`` map values into rows, blanks dropped;
    a non-map value yields nothing."""
    t = DriverTables(spark, sf_dir)
    li = t("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus")
    j = li.join(t("part", "p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    entries = F.create_map(
        F.lit("0"), F.create_map(F.lit("sector"), F.col("p_name")),
        F.lit("1"), F.create_map(F.lit("sector"), F.lit("  ")),
        F.lit("2"), F.create_map(F.lit("sector"), F.concat(F.lit("\t"), F.col("l_returnflag"), F.lit(" "))))
    sectr = F.when(F.col("l_linestatus") == "O", F.lit('"none"')).otherwise(F.to_json(entries))
    doc_id = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    rec = j.select(doc_id.alias("document_id"),
                   F.concat(F.lit('{"sectr":'), sectr, F.lit("}")).alias("record"))
    rec = rec.select("document_id", json_field("record", "sectr").alias("sectr"))
    return explode_map_field(rec, "sectr", "sector", "sector_name", keep=["document_id"])


@query("first_nested_value", """
SELECT event_id, CASE WHEN event_id % 7 = 3 THEN '{"0": {"author": "quoted"}}'
                      WHEN event_type = 'click' THEN 'user ' || CAST(user_id AS VARCHAR)
                      WHEN event_type = 'view' THEN 'v' || CAST(event_id AS VARCHAR)
                      WHEN event_type = 'error' THEN '{"0":"x' || CAST(event_id AS VARCHAR) || '"}'
                      ELSE '{"1":{"author":"u' || CAST(user_id AS VARCHAR) || '"}}' END AS author
FROM events""")
def q_first_nested_value(spark, sf_dir):
    """``{"0": {"author": v}}`` -> v; plain strings, other maps and a
    string that only looks like a map pass through."""
    e = DriverTables(spark, sf_dir)("events", "event_id", "user_id", "event_type")
    et, user = F.col("event_type"), F.concat(F.lit("u"), F.col("user_id").cast("string"))
    value = (F.when(F.pmod("event_id", F.lit(7)) == 3, F.lit('"{\\"0\\": {\\"author\\": \\"quoted\\"}}"'))
              .when(et == "click", F.to_json(F.create_map(F.lit("0"), F.create_map(
                 F.lit("author"), F.concat(F.lit("user "), F.col("user_id").cast("string")), F.lit("more"), F.lit("no")))))
              .when(et == "view", F.concat(F.lit('"v'), F.col("event_id").cast("string"), F.lit('"')))
              .when(et == "error", F.to_json(F.create_map(F.lit("0"), F.concat(
                  F.lit("x"), F.col("event_id").cast("string")))))
              .otherwise(F.to_json(F.create_map(F.lit("1"), F.create_map(F.lit("author"), user)))))
    record = F.concat(F.lit('{"authors":'), value, F.lit("}"))
    rec = e.select("event_id", record.alias("record"))
    return rec.select("event_id", first_nested_value("record", "authors").alias("author"))


def _land_document_pages(spark, sf_dir, page_size: int = PAGE_SIZE) -> str:
    """Land orders as document API pages (JSON lines) under the shared scratch
    folder and return the path.  Every order appears twice: in a first pass
    of pages (year 0) with a stale type, and again in year 1 with its real
    values; in the second pass low-priority orders lose ``projectid`` and
    pending orders get an empty one (so their stale copy is what survives).
    Each page also carries the ``facets: {}`` pseudo-record."""
    t = DriverTables(spark, sf_dir)
    o = t("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    numbered = with_surrogate_key(o, ["o_orderkey"], "rn", start=0)
    pid = F.concat(F.lit("P"), F.col("o_custkey").cast("string"))
    docdt = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00Z"))

    def rec(projectid, docty):
        return F.struct(F.col("o_orderkey").cast("string").alias("id"), projectid.alias("projectid"),
                        docty.alias("docty"), docdt.alias("docdt"))

    real_pid = (F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
                 .when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(pid))
    key = F.concat(F.lit("D"), F.col("o_orderkey").cast("string")).alias("key")
    stale = numbered.select("rn", F.lit(0).alias("year"), key, rec(pid, F.lit("stale")).alias("rec"))
    real = numbered.select("rn", F.lit(1).alias("year"), key, rec(real_pid, F.col("o_orderstatus")).alias("rec"))
    return write_document_pages(spark, stale.unionByName(real), "year", page_size, "document-pages")


_KEYED_SQL = """
SELECT 'D' || CAST(o_orderkey AS VARCHAR) AS record_key, o_orderkey AS document_id,
       'P' || CAST(o_custkey AS VARCHAR) AS project_id,
       CASE WHEN o_orderpriority = '5-LOW' OR o_orderstatus = 'P' THEN 'stale'
            ELSE o_orderstatus END AS document_type,
       CAST(o_orderdate AS DATE) AS docdt
FROM orders"""


def _documents_view(kept: DataFrame) -> DataFrame:
    return normalize.flatten_documents(kept).select("record_key", F.col("document_id").cast("long").alias("document_id"),
                        "project_id", "document_type", parse_date("docdt").alias("docdt"))


@query("keyed_records", _KEYED_SQL)
def q_keyed_records(spark, sf_dir):
    """G5+S2+U1+P3+P4+A7: landed pages -> keyed records -> last write wins
    among records with a truthy project id -> flattened documents."""
    path = _land_document_pages(spark, sf_dir)
    recs = P.document_records(P.read_pages(spark, path))
    return _documents_view(normalize.kept_documents(recs))


@query("raw_jsonl_replay", _KEYED_SQL)
def q_raw_jsonl_replay(spark, sf_dir):
    """S4+S3: kept records dumped as raw JSON lines, replayed through the same
    builders; equal to building from the pages."""
    path = _land_document_pages(spark, sf_dir)
    kept = normalize.kept_documents(P.document_records(P.read_pages(spark, path)))
    dump = scratch_path(spark, "raw-dump")
    sinks.write_raw_dump(kept.select("record_key", "record", "nested", "first_seen.*"), dump)
    replayed = normalize.kept_documents(P.read_raw_dump(spark, dump))
    return _documents_view(replayed)


@query("parse_dates", """
SELECT o_orderkey,
       CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d') || 'T23:30:00Z'
                            WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%d')
                            WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y-%m-%d') || 'Tjunk'
                            WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') || ' xyz' END
                            ELSE NULL END AS raw,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CAST(o_orderdate AS DATE) END AS parsed
FROM orders""")
def q_parse_dates(spark, sf_dir):
    """ISO-Z and plain dates parse to the date as written; junk and empty are null."""
    o = DriverTables(spark, sf_dir)("orders", "o_orderkey", "o_orderpriority", "o_orderdate")
    d, pr = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderpriority")
    raw = (F.when(pr == "1-URGENT", F.concat(d, F.lit("T23:30:00Z"))).when(pr == "2-HIGH", d)
            .when(pr == "3-MEDIUM", F.concat(d, F.lit("Tjunk")))
            .when(pr == "4-NOT SPECIFIED", F.when(F.pmod("o_orderkey", F.lit(2)) == 0, F.lit("")).otherwise(F.concat(d, F.lit(" xyz")))))
    x = o.select("o_orderkey", raw.alias("raw"))
    return x.select("o_orderkey", "raw", parse_date("raw").alias("parsed"))


@query("parse_numbers", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_returnflag = 'R' THEN NULL
            ELSE l_linenumber + CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END END AS volnb,
       CASE WHEN l_returnflag = 'A' THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(20,2)) END AS amount,
       CASE WHEN l_linestatus = 'O' THEN NULL ELSE CAST(l_orderkey AS INTEGER) END AS id_int
FROM lineitem""")
def q_parse_numbers(spark, sf_dir):
    """F7 (number into INT, '2.5' -> 3, junk and '3d' -> null), F8 (money string into
    DECIMAL(20,2)), F9 (id string into INT)."""
    li = DriverTables(spark, sf_dir)("lineitem", "l_orderkey", "l_linenumber", "l_extendedprice",
                                     "l_returnflag", "l_linestatus")
    vol = F.when(F.col("l_returnflag") == "R", F.concat(F.col("l_linenumber").cast("string"), F.lit("d"))).otherwise(F.concat(
        F.col("l_linenumber").cast("string"),
        F.when(F.col("l_linestatus") == "O", F.lit(".5")).otherwise(F.lit(""))))
    money = F.when(F.col("l_returnflag") == "A", F.lit("n/a")).otherwise(
        F.col("l_extendedprice").cast("decimal(20,2)").cast("string"))
    ident = F.when(F.col("l_linestatus") == "O",
                   F.concat(F.col("l_orderkey").cast("string"), F.lit("x"))).otherwise(
        F.col("l_orderkey").cast("string"))
    x = li.select("l_orderkey", "l_linenumber", vol.alias("v"), money.alias("m"), ident.alias("i"))
    return x.select("l_orderkey", "l_linenumber", parse_int_number("v").alias("volnb"),
                    parse_decimal("m", 20, 2).alias("amount"), parse_int_id("i").alias("id_int"))


# ================================================================== country dimension R9
@query("null_if_equal", _with(CTE_COUNTRY_ROWS, CTE_COUNTRY) + "SELECT * FROM country_m")
def q_null_if_equal(spark, sf_dir):
    """P5+P6+P7: the country dimension as the project load builds it."""
    return normalize.build_country(S.country_rows(DriverTables(spark, sf_dir)))


@query("region_repair", _with(CTE_COUNTRY_ROWS, CTE_COUNTRY) + """
SELECT countryshortname,
       CASE WHEN regionname IS NULL OR regionname = 'Other' THEN countryshortname
            ELSE regionname END AS regionname
FROM country_m""")
def q_region_repair(spark, sf_dir):
    """Region := country where missing or 'Other'."""
    return marts.repaired_country(normalize.build_country(S.country_rows(DriverTables(spark, sf_dir))))


@query("region_checks", _with(CTE_COUNTRY_ROWS, CTE_COUNTRY) + """
, fixed AS (SELECT countryshortname,
       CASE WHEN regionname IS NULL OR regionname = 'Other' THEN countryshortname
            ELSE regionname END AS regionname FROM country_m)
SELECT count(*) FILTER (WHERE regionname IS NULL) AS null_regions,
       count(*) FILTER (WHERE regionname = 'Other' AND countryshortname <> 'Other') AS residual_placeholder
FROM fixed""")
def q_region_checks(spark, sf_dir):
    """P10+P12: both checks after the repair (expected 0 and 0)."""
    fixed = marts.repaired_country(normalize.build_country(S.country_rows(DriverTables(spark, sf_dir))))
    return audit.region_checks(fixed)


# ================================================================== page plan S13, S14, F13
_TOTALS_SQL = "totals AS (SELECT CAST(ts AS DATE) AS day, count(*) AS total FROM events GROUP BY 1)"
_PLAN_SQL = (f"plan AS (SELECT day, total, unnest(generate_series(0, total - 1, "
             f"{PAGE_SIZE})) AS page_offset FROM totals WHERE total > 0)")


def _day_plan(spark, sf_dir):
    e = DriverTables(spark, sf_dir)("events", "ts")
    totals = e.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("total"))
    return pageplan.page_plan(totals, "day", PAGE_SIZE)


@query("page_plan", _with(_TOTALS_SQL, _PLAN_SQL) + "SELECT day, total, page_offset FROM plan")
def q_page_plan(spark, sf_dir):
    """Every page to fetch, from per-group totals (events per day stand in for documents per year)."""
    return _day_plan(spark, sf_dir)


@query("completeness", _with(_TOTALS_SQL, _PLAN_SQL) + f"""
, inv AS (SELECT day, page_offset, least({PAGE_SIZE}, total - page_offset) AS records FROM plan
          WHERE NOT (dayofweek(day) = 0 AND page_offset = 0))
, agg AS (SELECT p.day, max(p.total) AS total, count(*) AS planned_pages, count(i.page_offset) AS landed_pages,
                 CAST(coalesce(sum(i.records), 0) AS BIGINT) AS landed_records
          FROM plan p LEFT JOIN inv i ON p.day = i.day AND p.page_offset = i.page_offset GROUP BY p.day)
SELECT day, total, planned_pages, landed_pages, planned_pages - landed_pages AS failed_pages, landed_records,
       round_even(landed_records / total * 100, 1) AS pct_done,
       greatest(total - {SERVED}, 0) AS records_beyond_cap
FROM agg""")
def q_completeness(spark, sf_dir):
    """S14+F13: the pages that landed and can be read against the plan (first page of each Sunday failed)."""
    days = F.to_date(F.col("year").cast("string"), "yyyyMMdd")
    pages = P.read_pages(spark, _land_event_pages(spark, sf_dir)).withColumn("day", days)
    pages = pages.where(~F.coalesce((F.dayofweek("day") == 1) & (F.col("offset") == 0), F.lit(False)))
    inventory = P.latest_pages(P.page_inventory(pages)).select(days.alias("day"), F.col("offset").alias("page_offset"), "records")
    return pageplan.completeness(_day_plan(spark, sf_dir), inventory, "day", SERVED)


def _land_event_pages(spark, sf_dir) -> str:
    """Events landed as document pages of their day (the page's year is yyyymmdd), numbered from 0 in each day."""
    e = DriverTables(spark, sf_dir)("events", "event_id", "ts").withColumn("year", F.date_format("ts", "yyyyMMdd").cast("int"))
    numbered = with_surrogate_key(e, ["year", "event_id", "ts"], "at", start=0)
    first = numbered.groupBy("year").agg(F.min("at").alias("first"))
    rows = numbered.join(first, "year").select(
        (F.col("at") - F.col("first")).alias("rn"), "year", F.concat(F.lit("D"), F.col("at").cast("string")).alias("key"),
        F.struct(F.col("event_id").cast("string").alias("id")).alias("rec"))
    return write_document_pages(spark, rows, "year", PAGE_SIZE, "event-pages")


# What is planted in the landed pages, written out for the oracle on its own: a value that is no record on every third
# page, the torn line of a first fetch on the third of every five.
_BAD_SQL = """CASE CAST(floor(page / 3) AS BIGINT) % 5 WHEN 0 THEN '"oops"' WHEN 1 THEN '17' WHEN 2 THEN 'null' WHEN 3 THEN '["a",1]' ELSE 'true' END"""


@query("rejected_records", f"""
WITH p AS (SELECT CAST(y AS INTEGER) AS year, page, page * {PAGE_SIZE} AS page_offset FROM (
             SELECT unnest(range(CAST(ceil((SELECT count(*) FROM orders) / {PAGE_SIZE}.0) AS BIGINT))) AS page), (VALUES (0), (1)) v(y))
SELECT 'documents' AS source, year AS page_year, page_offset, 'bad-' || CAST(page AS VARCHAR) AS record_key, 'not an object' AS reason, {_BAD_SQL} AS raw
FROM p WHERE page % 3 = 0
UNION ALL
SELECT NULL, NULL, NULL, NULL, 'broken line',
       '{{"source":"documents","year":' || CAST(year AS VARCHAR) || ',"offset":' || CAST(page_offset AS VARCHAR) || ',"body":{{"' FROM p WHERE page % 5 = 2""")
def q_rejected_records(spark, sf_dir):
    """What landed and became no record, with its place, reason and raw text.  The records beside it are
    those of ``keyed_records``, which reads the same pages."""
    pages = P.read_pages(spark, _land_document_pages(spark, sf_dir))
    return P.rejected_records(pages).select("source", "page_year", "page_offset", "record_key", "reason", "raw")


@query("rejected_per_page", f"""
SELECT CAST(floor(rn / 1000) * 1000 AS BIGINT) AS page_offset, count(*) AS records, CASE WHEN floor(min(rn) / 1000) % 3 = 0 THEN 1 ELSE 0 END AS rejected
FROM (SELECT row_number() OVER () - 1 AS rn FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey) x
GROUP BY 1, floor(rn / 1000)""")
def q_rejected_per_page(spark, sf_dir):
    """Records that came out of every landed project page, and entries that did not."""
    inventory = P.page_inventory(P.read_pages(spark, land_project_pages(spark, sf_dir)))
    return inventory.select(F.col("offset").alias("page_offset"), "records", F.col("rejected").cast("int").alias("rejected"))


# ================================================================== reports S12, A9
@query("load_report", _with(CTE_PROJECTS, CTE_PS, CTE_PMS, CTE_PSL, CTE_MSL, CTE_DOCS) + """
SELECT 'projects' AS table_name, count(*) AS row_count FROM projects_m
UNION ALL SELECT 'project_sectors', count(*) FROM ps_m
UNION ALL SELECT 'project_major_sectors', count(*) FROM pms_m
UNION ALL SELECT 'proj_sector_lookup', count(*) FROM sl_m
UNION ALL SELECT 'major_sector_lookup', count(*) FROM msl_m
UNION ALL SELECT 'documents', count(*) FROM doc_m""")
def q_load_report(spark, sf_dir):
    """Rows per built table."""
    return audit.load_report(S.model(DriverTables(spark, sf_dir)))


_MART_TYPES = [("project_id", "bigint"), ("countryshortname", "string"), ("totalamt", "decimal(20,2)"),
               ("major_sector_code", "string"), ("major_sector_name", "string"),
               ("sector_code", "bigint"), ("sector_name", "string"),
               ("sector_percent", "decimal(5,2)"), ("allocated_amount", "decimal(30,8)")]


@query("column_profile", _with(CTE_PROJECTS, CTE_PS, CTE_PMS, CTE_PSL, CTE_MSL, CTE_MART) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{ty}' AS data_type, count(*) AS row_count, "
    f"count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count, "
    f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM mart"
    for c, ty in _MART_TYPES))
def q_column_profile(spark, sf_dir):
    """Per column type, rows, nulls, exact distinct values of the stored mart."""
    return audit.column_profile(_stored(q_sector_mart(spark, sf_dir), "mart"), exact=True)


@query("column_profile_approx", _with(CTE_PROJECTS, CTE_PS, CTE_PMS, CTE_PSL, CTE_MSL, CTE_MART) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{ty}' AS data_type, count(*) AS row_count, "
    f"count(*) - count({c}) AS null_count, true AS within_5_percent, "
    f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM mart"
    for c, ty in _MART_TYPES))
def q_column_profile_approx(spark, sf_dir):
    """A9 by HyperLogLog sketches, each estimate held against the exact count."""
    mart = _stored(q_sector_mart(spark, sf_dir), "mart")
    sketch, exact = audit.column_profile(mart), audit.column_profile(mart, exact=True)
    both = sketch.join(exact.select("column_name", F.col("distinct_count").alias("n")), "column_name")
    return both.select("column_name", "data_type", "row_count", "null_count",
                       (F.abs(F.col("distinct_count") - F.col("n")) <= 0.05 * F.col("n")).alias("within_5_percent"), "min_value", "max_value")


@query("column_profile_merged", _with(CTE_PROJECTS, CTE_PS, CTE_PMS, CTE_PSL, CTE_MSL, CTE_MART) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{ty}' AS data_type, count(*) AS row_count, "
    f"count(*) - count({c}) AS null_count, true AS within_5_percent, "
    f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM mart"
    for c, ty in _MART_TYPES))
def q_column_profile_merged(spark, sf_dir):
    """A9 kept up to date batch by batch: each batch's sketches are stored, the profile of all is made of them
    alone, and held against the exact count."""
    mart, path = _stored(q_sector_mart(spark, sf_dir), "mart"), scratch_path(spark, "profile")
    for batch in range(3):
        audit.append_profile(mart.where(F.pmod("project_id", F.lit(3)) == batch), path, str(batch))
    sketch, exact = audit.stored_profile(spark, path, mart.dtypes), audit.column_profile(mart, exact=True)
    both = sketch.join(exact.select("column_name", F.col("distinct_count").alias("n")), "column_name")
    return both.select("column_name", "data_type", "row_count", "null_count",
                       (F.abs(F.col("distinct_count") - F.col("n")) <= 0.05 * F.col("n")).alias("within_5_percent"), "min_value", "max_value")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    sinks.write_parquet(df, path)
    return read_table(df.sparkSession, path)


# ================================================================== sinks and round trips
def _csv_and_back(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    sinks.write_csv(df, path)
    return read_typed_csv(df.sparkSession, path, df.schema)


@query("csv_round_trip", _with(CTE_PROJECTS, CTE_PS, CTE_PMS, CTE_PSL, CTE_MSL, CTE_MART)
       + "SELECT * FROM mart")
def q_csv_round_trip(spark, sf_dir):
    """S8+S9: the mart exported as CSV with header, read back with its schema."""
    return _csv_and_back(q_sector_mart(spark, sf_dir), "mart-csv")


@query("csv_export_documents", """
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN text || chr(10) || 'said "so, then"' WHEN 1 THEN '' WHEN 2 THEN NULL
                               WHEN 3 THEN ' "' || text ELSE text END AS text, lang, source, n_chars FROM documents""")
def q_csv_export_documents(spark, sf_dir):
    """S8+S9 on real text: quotes, line breaks, empty and missing values of whole texts survive."""
    d, no = DriverTables(spark, sf_dir)("documents"), F.pmod("doc_id", F.lit(5))
    text = (F.when(no == 0, F.concat("text", F.lit('\nsaid "so, then"'))).when(no == 1, F.lit(""))
             .when(no == 2, F.lit(None).cast("string")).when(no == 3, F.concat(F.lit(' "'), "text")).otherwise(F.col("text")))
    return _csv_and_back(d.withColumn("text", text), "documents-csv")


@query("csv_export_document_dates", ORACLE["project_document_dates"])
def q_csv_export_document_dates(spark, sf_dir):
    """S8 of R1."""
    return _csv_and_back(q_project_document_dates(spark, sf_dir), "r1-csv")


@query("csv_export_sector_percent", ORACLE["project_sector_percent"])
def q_csv_export_sector_percent(spark, sf_dir):
    """S8 of R2."""
    return _csv_and_back(q_project_sector_percent(spark, sf_dir), "r2-csv")


@query("csv_export_major_sector", ORACLE["project_major_sector"])
def q_csv_export_major_sector(spark, sf_dir):
    """S8 of R3."""
    return _csv_and_back(q_project_major_sector(spark, sf_dir), "r3-csv")


@query("parquet_round_trip", "SELECT * FROM documents")
def q_parquet_round_trip(spark, sf_dir):
    """Whole documents through a Parquet layer."""
    return _stored(DriverTables(spark, sf_dir)("documents"), "documents-parquet")


@query("column_read_back", "SELECT doc_id, lang FROM documents")
def q_column_read_back(spark, sf_dir):
    """Two columns of a stored table; the scan reads no others."""
    path = scratch_path(spark, "documents-parquet")
    sinks.write_parquet(DriverTables(spark, sf_dir)("documents"), path)
    return read_table(spark, path, ["doc_id", "lang"])


@query("append_load", "SELECT * FROM orders")
def q_append_load(spark, sf_dir):
    """A table loaded in two batches, the second one run twice, reads back whole and once."""
    return sinks.read_back(spark, _two_batches(spark, sf_dir), "orders")


def _two_batches(spark, sf_dir) -> str:
    o = DriverTables(spark, sf_dir)("orders")
    first = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    base = scratch_path(spark, "append")
    sinks.append_load({"orders": o.filter(first)}, base, "final")
    for _ in range(2):
        sinks.append_load({"orders": o.filter(~first)}, base, "open")
    return base


@query("load_ledger", """
SELECT CASE WHEN o_orderstatus = 'F' THEN 'final' ELSE 'open' END AS batch, 'orders' AS table_name, count(*) AS row_count
FROM orders GROUP BY 1""")
def q_load_ledger(spark, sf_dir):
    """S6+S12: the committed loads and their rows, counted while they were written."""
    return sinks.load_ledger(spark, _two_batches(spark, sf_dir))


@query("merge_by_key", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 3 WHEN o_orderkey % 7 = 3 THEN 2 ELSE 1 END AS landing,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'third' WHEN o_orderkey % 7 = 3 THEN 'second' ELSE o_orderstatus END AS status, 1 AS first_landing
FROM orders""")
def q_merge_by_key(spark, sf_dir):
    """A7+U1: three landings of one table merged by key, the newest last or not; the table is not rebuilt."""
    o = DriverTables(spark, sf_dir)("orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    path = scratch_path(spark, "merged")
    landings = [(1, o, F.col("o_orderstatus")), (3, o.where("o_orderpriority = '1-URGENT'"), F.lit("third")),
                (2, o.where("o_orderkey % 7 = 3"), F.lit("second"))]
    for landing, rows, status in landings:
        merge_by_key(rows.select("o_orderkey", F.lit(landing).alias("landing"), status.alias("status")), path, ["o_orderkey"], ["landing"], buckets=16)
    return read_merged(spark, path).select("o_orderkey", F.col("newest.landing").alias("landing"), "status", F.col("first_seen.landing").alias("first_landing"))


@query("merge_documents", _KEYED_SQL)
def q_merge_documents(spark, sf_dir):
    """A7+U1 on landed pages: the records of one fetch merged into those of the one before, equal to building from all pages."""
    pages, path = P.read_pages(spark, _land_document_pages(spark, sf_dir)), scratch_path(spark, "merged-documents")
    for year in (0, 1):
        normalize.merge_documents(P.document_records(pages.where(F.col("year") == year)), path)
    return _documents_view(normalize.merged_documents(spark, path))


@query("full_refresh", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN '4-NOT SPECIFIED' ELSE o_orderpriority END AS o_orderpriority,
       o_totalprice FROM orders""")
def q_full_refresh(spark, sf_dir):
    """S10+S11: a rerun replaces instead of duplicating, and a table may be
    refreshed from what it holds (as a repair does)."""
    o = DriverTables(spark, sf_dir)("orders", "o_orderkey", "o_orderpriority", "o_totalprice")
    base = scratch_path(spark, "refresh")
    sinks.full_refresh({"orders": o}, base)
    sinks.full_refresh({"orders": o}, base)
    held, p = sinks.read_back(spark, base, "orders"), F.col("o_orderpriority")
    sinks.full_refresh({"orders": held.withColumn("o_orderpriority", F.when(
        p == "5-LOW", F.lit("4-NOT SPECIFIED")).otherwise(p))}, base)
    return sinks.read_back(spark, base, "orders")


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLE)


# ================================================================== R10 on landed driver pages
from finmesh.plans.landed import land_project_pages  # noqa: E402,F811

# The total order of line items, written out for the oracle on its own.
_ORDER_SQL = ("l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate, l.l_quantity, "
              "l.l_discount, l.l_tax, l.l_extendedprice, l.l_returnflag, l.l_linestatus")
_LANDED_SQL = "landed AS (\n  SELECT l.*, o.*, c.c_name, c.c_mktsegment, n.n_name, r.r_name, p.p_name, p.p_type,\n" \
    f"         row_number() OVER (ORDER BY {_ORDER_SQL}) - 1 AS rn\n" \
    """  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""
_PROJ_SQL = """proj AS (
  SELECT rn, 'P' || CAST(l_orderkey AS VARCHAR) AS project_id,
         'Project ' || CAST(l_orderkey AS VARCHAR) ||
           CASE WHEN l_linenumber = 1 THEN '' ELSE ' line ' || CAST(l_linenumber AS VARCHAR) END AS project_name,
         n_name AS countryshortname,
         CASE o_orderpriority WHEN '1-URGENT' THEN n_name WHEN '2-HIGH' THEN 'Other'
              WHEN '3-MEDIUM' THEN NULL ELSE r_name END AS regionname,
         CAST(o_totalprice AS DECIMAL(20,2)) AS totalamt,
         CAST(o_orderdate AS DATE) AS boardapprovaldate, CAST(l_shipdate AS DATE) AS closingdate,
         o_orderstatus AS envassesmentcategorycode, c_name, c_mktsegment, l_suppkey, l_linenumber,
         l_returnflag, l_linestatus, p_type, p_name, l_partkey, l_discount
  FROM landed)"""
_SEC_SQL = f"""sec AS (
  SELECT rn, project_id, p_type AS major_sector_code,
         lower(p_type) || CASE WHEN l_linestatus = 'O' THEN ' (open)' ELSE '' END AS major_sector_name,
         CAST(l_partkey AS VARCHAR) AS sector_code,
         p_name || CASE WHEN l_linestatus = 'O' THEN ' ' ELSE '' END AS sector_name,
         {PCT.format(c='l_discount')} AS sector_percent,
         row_number() OVER (ORDER BY rn) AS rid
  FROM proj WHERE l_returnflag <> 'R')"""


def _landed_tables(spark, sf_dir):
    """The project-side tables over freshly landed pages; only what is asked for is built."""
    return normalize.build_project_tables(P.project_entries(P.read_pages(spark, land_project_pages(spark, sf_dir))), shared=False)


@query("normalize_country", _with(_LANDED_SQL, _PROJ_SQL) + """
SELECT countryshortname, regionname FROM (
  SELECT countryshortname, NULLIF(regionname, countryshortname) AS regionname,
         row_number() OVER (PARTITION BY countryshortname ORDER BY rn) AS k
  FROM proj WHERE countryshortname IS NOT NULL) WHERE k = 1""")
def q_normalize_country(spark, sf_dir):
    """R10 country table from landed project pages."""
    return _landed_tables(spark, sf_dir)["country"]


@query("normalize_projects", _with(_LANDED_SQL, _PROJ_SQL) + """
SELECT project_id, project_name, countryshortname, CAST(NULL AS DECIMAL(20,2)) AS curr_ibrd_commitment,
       CAST(NULL AS DECIMAL(20,2)) AS idacommamt, totalamt, CAST(0 AS DECIMAL(20,2)) AS grantamt,
       CAST(NULL AS DECIMAL(20,2)) AS lendprojectcost, boardapprovaldate, closingdate,
       envassesmentcategorycode
FROM (SELECT *, row_number() OVER (PARTITION BY project_id ORDER BY rn) AS k FROM proj) WHERE k = 1""")
def q_normalize_projects(spark, sf_dir):
    """R10 projects table: first record per project, coerced money and dates."""
    return _landed_tables(spark, sf_dir)["projects"]


@query("normalize_major_sector_lookup", _with(_LANDED_SQL, _PROJ_SQL, _SEC_SQL) + """
SELECT major_sector_code, major_sector_name FROM (
  SELECT *, row_number() OVER (PARTITION BY major_sector_code ORDER BY rid) AS k FROM sec) WHERE k = 1""")
def q_normalize_major_sector_lookup(spark, sf_dir):
    """R10 major sector lookup: first name per code."""
    return _landed_tables(spark, sf_dir)["major_sector_lookup"]


@query("normalize_proj_sector_lookup", _with(_LANDED_SQL, _PROJ_SQL, _SEC_SQL) + """
SELECT sector_code, sector_name FROM (
  SELECT *, row_number() OVER (PARTITION BY sector_code ORDER BY rid) AS k FROM sec) WHERE k = 1""")
def q_normalize_proj_sector_lookup(spark, sf_dir):
    """R10 sector lookup: first name per code, names not stripped."""
    return _landed_tables(spark, sf_dir)["proj_sector_lookup"]


@query("normalize_project_major_sectors", _with(_LANDED_SQL, _PROJ_SQL, _SEC_SQL) + """
SELECT rid AS project_major_sector_id, project_id, major_sector_code FROM sec""")
def q_normalize_project_major_sectors(spark, sf_dir):
    """R10 project x major sector bridge with surrogate ids (G1, K1)."""
    return _landed_tables(spark, sf_dir)["project_major_sectors"]


@query("normalize_project_sectors", _with(_LANDED_SQL, _PROJ_SQL, _SEC_SQL) + """
, par AS (SELECT project_id, major_sector_code, min(rid) AS pid FROM sec GROUP BY 1, 2)
SELECT s.rid AS project_sector_id, s.project_id, par.pid AS project_major_sector_id, s.sector_code,
       s.sector_percent
FROM sec s JOIN par ON s.project_id = par.project_id AND s.major_sector_code = par.major_sector_code""")
def q_normalize_project_sectors(spark, sf_dir):
    """R10 sector bridge: parent surrogate key resolved (G2, J5 unique, K1)."""
    return _landed_tables(spark, sf_dir)["project_sectors"]


@query("normalize_borrower", _with(_LANDED_SQL, _PROJ_SQL) + """
SELECT row_number() OVER (ORDER BY rn, k) AS borrower_id, borrower_name, project_id FROM (
  SELECT rn, 0 AS k, c_name AS borrower_name, project_id FROM proj WHERE c_name IS NOT NULL AND c_mktsegment IS NOT NULL
  UNION ALL
  SELECT rn, 1, c_mktsegment, project_id FROM proj WHERE c_name IS NOT NULL AND c_mktsegment IS NOT NULL)""")
def q_normalize_borrower(spark, sf_dir):
    """R10 borrower list: plain comma split."""
    return _landed_tables(spark, sf_dir)["borrower"]


@query("normalize_impagency", _with(_LANDED_SQL, _PROJ_SQL) + """
SELECT row_number() OVER (ORDER BY rn, k) AS impagency_id, impagency_name, project_id FROM (
  SELECT rn, 0 AS k, 'Agency ' || CAST(l_suppkey AS VARCHAR) AS impagency_name, project_id FROM proj
  UNION ALL
  SELECT rn, 1, 'Unit ' || CAST(l_linenumber AS VARCHAR), project_id FROM proj)""")
def q_normalize_impagency(spark, sf_dir):
    """R10 implementing agencies: a name with a comma is cut in two (F1)."""
    return _landed_tables(spark, sf_dir)["impagency"]


# ------------------------------------------------------------------ document side of R10
from finmesh.plans.landed import land_documents_table  # noqa: E402


def _landed_documents(spark, sf_dir) -> DataFrame:
    return P.document_records(P.read_pages(spark, land_documents_table(spark, sf_dir)))


def _landed_document_tables(spark, sf_dir):
    proj = _landed_tables(spark, sf_dir)
    return normalize.build_document_tables(_landed_documents(spark, sf_dir), proj.known_ids, proj["country"], shared=False)


_DOCS_SQL = _with(_LANDED_SQL) + """
, dl AS (SELECT doc_id, text, lang, source, n_chars,
                CASE lang WHEN 'de' THEN '' WHEN 'es' THEN NULL ELSE 'P' || CAST(doc_id AS VARCHAR) END AS projectid
         FROM documents)
, truthy AS (SELECT * FROM dl WHERE projectid IS NOT NULL AND projectid <> '')
, kept AS (SELECT * FROM truthy WHERE doc_id % 53 NOT IN (7, 8))
, ins AS (SELECT * FROM kept WHERE projectid IN (SELECT DISTINCT 'P' || CAST(l_orderkey AS VARCHAR) FROM landed))
"""


def _pieces_sql(src: str, expr: str, lower: bool = False) -> str:
    """Comma-not-space split of ``expr`` per document of ``src`` with positions, stripped, empties dropped."""
    item = _strip_sql("replace(piece, chr(57344), ', ')")
    if lower:
        item = f"lower({item})"
    return f"""(SELECT doc_id, ord, item FROM (
      SELECT doc_id, ord, {item} AS item FROM (
        SELECT doc_id, unnest(arr) AS piece, generate_subscripts(arr, 1) AS ord FROM (
          SELECT doc_id, string_split(replace({expr}, ', ', chr(57344)), ',') AS arr FROM {src})))
    WHERE length(item) > 0)"""


_SUBSC = "source || ',' || upper(lang) || ',' || lang"
_COUNT = "'NATION_' || CAST(doc_id % 25 AS VARCHAR) || ',nation_' || CAST(doc_id % 7 AS VARCHAR) || ',Atlantis'"


_DAY = "(DATE '2001-02-03' + CAST(doc_id % 3000 AS INTEGER))"


def _document_columns(cleaned: bool) -> str:
    """The 25 columns as landed (text) or cleaned."""
    day = f"strftime({_DAY}, '%Y-%m-%d')"
    date = lambda raw, value: f"CAST({value} AS DATE)" if cleaned else raw
    return f"""{'CAST(doc_id AS INTEGER)' if cleaned else "CASE WHEN doc_id % 53 = 7 THEN NULL WHEN doc_id % 53 = 8 THEN '' ELSE CAST(doc_id AS VARCHAR) END"} AS document_id,
       'Document ' || doc_id AS document_name, source AS document_type, 'L' || (doc_id % 7) AS prdln,
       CASE WHEN doc_id % 5 = 0 THEN '{{"0":{{"lndinstr":"x"}}}}' ELSE 'Instrument ' || doc_id END AS lndinstr,
       {date(f"{day} || 'T23:30:00Z'", _DAY)} AS docdt, {date(day, _DAY)} AS datestored,
       {date(f"CASE lang WHEN 'fr' THEN {day} || 'Tjunk' ELSE {day} END", f"CASE lang WHEN 'fr' THEN NULL ELSE {_DAY} END")} AS disclosure_date,
       {date(f"{day} || ' 10:00:00'", _DAY)} AS last_modified_date,
       'http://docs.example/' || doc_id || '.pdf' AS pdfurl, 'http://docs.example/' || doc_id || '.txt' AS txturl,
       'http://docs.example/' || doc_id AS url, 'Major ' || source AS maj_document_type,
       CASE WHEN doc_id % 2 = 0 THEN 'Disclosed' END AS disclstat, 'Final' AS versiontype, source AS author,
       'Public' AS security_class, lang, 'R' || doc_id AS repnb, {'CAST(n_chars AS INTEGER)' if cleaned else 'CAST(n_chars AS VARCHAR)'} AS volnb,
       'Title of ' || doc_id AS display_title, 'C' || doc_id AS chronical_docm_id, 'G' || doc_id AS guid,
       'Owner ' || source AS owner, projectid AS project_id"""


@query("normalize_documents", _DOCS_SQL + f"SELECT {_document_columns(True)} FROM ins")
def q_normalize_documents(spark, sf_dir):
    """R10 documents from landed pages, all 25 columns: truthy project id (P3), nested first
    values (F6), dates (F5), number coercion (F7, F9), known projects only (J6)."""
    return _landed_document_tables(spark, sf_dir)["documents"]


@query("flattened_documents", _DOCS_SQL + f"SELECT {_document_columns(False)} FROM truthy")
def q_flattened_documents(spark, sf_dir):
    """The 25 columns before cleaning, stored as Parquet and read back."""
    flat = normalize.flatten_documents(normalize.kept_documents(_landed_documents(spark, sf_dir)))
    return _stored(flat.drop("first_seen", "record_key"), "documents-flat")


@query("normalize_doc_sector_lookup", _DOCS_SQL + f"""
SELECT DISTINCT {_strip_sql('source')} AS sector_name FROM ins WHERE length({_strip_sql('source')}) > 0
UNION SELECT DISTINCT lang FROM ins WHERE length(lang) > 0""")
def q_normalize_doc_sector_lookup(spark, sf_dir):
    """R10 sector names of documents (A5)."""
    return _landed_document_tables(spark, sf_dir)["doc_sector_lookup"]


@query("normalize_doc_theme", _DOCS_SQL + f"""
SELECT row_number() OVER (ORDER BY doc_id, ord) AS doc_theme_id, item AS theme_name,
       CAST(doc_id AS INTEGER) AS document_id FROM {_pieces_sql('ins', 'text')}""")
def q_normalize_doc_theme(spark, sf_dir):
    """R10 themes of whole texts."""
    return _landed_document_tables(spark, sf_dir)["doc_theme"]


@query("normalize_doc_theme_lookup", _DOCS_SQL + f"""
SELECT DISTINCT item AS theme_name FROM {_pieces_sql('ins', 'text')}""")
def q_normalize_doc_theme_lookup(spark, sf_dir):
    return _landed_document_tables(spark, sf_dir)["doc_theme_lookup"]


@query("normalize_doc_sub_sector_lookup", _DOCS_SQL + f"""
SELECT DISTINCT item AS sub_sector_name FROM {_pieces_sql('kept', _SUBSC, lower=True)}""")
def q_normalize_doc_sub_sector_lookup(spark, sf_dir):
    """R10 sub-sector lookup: lower-cased, over all kept documents (not only inserted)."""
    return _landed_document_tables(spark, sf_dir)["doc_sub_sector_lookup"]


@query("normalize_doc_sub_sector", _DOCS_SQL + f"""
SELECT row_number() OVER (ORDER BY doc_id, ord) AS doc_sub_sector_id, item AS sub_sector_name,
       CAST(doc_id AS INTEGER) AS document_id FROM {_pieces_sql('ins', _SUBSC, lower=True)}""")
def q_normalize_doc_sub_sector(spark, sf_dir):
    return _landed_document_tables(spark, sf_dir)["doc_sub_sector"]


@query("normalize_doc_sector", _DOCS_SQL + f"""
SELECT row_number() OVER (ORDER BY doc_id, pos) AS doc_sector_id, sector_name,
       CAST(doc_id AS INTEGER) AS document_id FROM (
  SELECT doc_id, 0 AS pos, {_strip_sql('source')} AS sector_name FROM ins
  UNION ALL SELECT doc_id, 1, {_strip_sql("' ' || lang || ' '")} FROM ins)
WHERE length(sector_name) > 0""")
def q_normalize_doc_sector(spark, sf_dir):
    """R10 document sectors from the ``sectr`` map."""
    return _landed_document_tables(spark, sf_dir)["doc_sector"]


@query("normalize_doc_country", _DOCS_SQL + f"""
, known AS (SELECT DISTINCT n_name FROM landed WHERE n_name IS NOT NULL)
SELECT row_number() OVER (ORDER BY doc_id, ord) AS doc_country_id, item AS countryshortname,
       CAST(doc_id AS INTEGER) AS document_id
FROM {_pieces_sql('ins', _COUNT)} x WHERE item IN (SELECT n_name FROM known)""")
def q_normalize_doc_country(spark, sf_dir):
    """R10 document countries: exact match against the country table."""
    return _landed_document_tables(spark, sf_dir)["doc_country"]


# ------------------------------------------------------------------ incremental ingest
from finmesh.streaming import landing as stream_landing  # noqa: E402


@query("stream_ingest_pages", _with(_LANDED_SQL) + """
SELECT CAST(floor(rn / 1000) * 1000 AS BIGINT) AS page_offset, CAST(rn % 1000 AS INTEGER) AS pos,
       'P' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(rn AS VARCHAR) AS record_key
FROM landed""")
def q_stream_ingest_pages(spark, sf_dir):
    """S1/U1 as a stream: every landed project page ingested exactly once into bronze."""
    path = land_project_pages(spark, sf_dir)
    bronze = scratch_path(spark, "bronze")
    stream_landing.ingest_pages(spark, path, bronze)
    return stream_landing.read_bronze(spark, bronze, "projects").select("page_offset", "pos", "record_key")


# Fixed value: documents returned by one per-project fetch.
DOCUMENTS_PER_FETCH = 50


@query("document_limit_audit", f"""
SELECT user_id, count(*) AS n_documents FROM events GROUP BY user_id
HAVING count(*) > {DOCUMENTS_PER_FETCH}""")
def q_document_limit_audit(spark, sf_dir):
    """Owners with more documents than one fetch returns (events per user
    stand in for documents per project)."""
    e = DriverTables(spark, sf_dir)("events", "user_id")
    return audit.per_key_limit_audit(e, "user_id", DOCUMENTS_PER_FETCH, "n_documents")


# ------------------------------------------------------------------ R10 load report and integrity
from finmesh.schemas import FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS, TEXT_WIDTHS  # noqa: E402

_TABLE_QUERY = {name: f"normalize_{name}" for name in [
    "country", "projects", "major_sector_lookup", "proj_sector_lookup", "project_major_sectors",
    "project_sectors", "borrower", "impagency", "documents", "doc_theme", "doc_theme_lookup",
    "doc_sub_sector_lookup", "doc_sub_sector", "doc_sector", "doc_sector_lookup", "doc_country"]}


def _table_sql(name: str) -> str:
    return ORACLE[_TABLE_QUERY[name]]


def _all_landed_tables(spark, sf_dir, base: str | None = None) -> dict:
    """The 16 tables stored once; what reads them reads the stored ones, so pages and what was stored on the way are gone by then."""
    base = base or scratch_path(spark, "tables")
    with scratch(spark):
        projects = P.project_records(P.read_pages(spark, land_project_pages(spark, sf_dir)))
        return normalize.store_all(projects, _landed_documents(spark, sf_dir), base)


# The tables and their keys, written out for the oracle on its own.
_KEYS_SQL = {
    "country": "countryshortname", "projects": "project_id", "major_sector_lookup": "major_sector_code", "proj_sector_lookup": "sector_code",
    "doc_theme_lookup": "theme_name", "doc_sector_lookup": "sector_name", "doc_sub_sector_lookup": "sub_sector_name",
    "project_major_sectors": "project_major_sector_id", "project_sectors": "project_sector_id", "impagency": "impagency_id",
    "borrower": "borrower_id", "documents": "document_id", "doc_country": "doc_country_id", "doc_theme": "doc_theme_id",
    "doc_sector": "doc_sector_id", "doc_sub_sector": "doc_sub_sector_id"}
_PARENTS = """project_major_sectors.project_id projects.project_id, project_major_sectors.major_sector_code major_sector_lookup.major_sector_code,
project_sectors.project_id projects.project_id, project_sectors.project_major_sector_id project_major_sectors.project_major_sector_id,
project_sectors.sector_code proj_sector_lookup.sector_code, impagency.project_id projects.project_id, borrower.project_id projects.project_id,
documents.project_id projects.project_id, doc_country.document_id documents.document_id, doc_country.countryshortname country.countryshortname,
doc_theme.document_id documents.document_id, doc_theme.theme_name doc_theme_lookup.theme_name, doc_sector.document_id documents.document_id,
doc_sector.sector_name doc_sector_lookup.sector_name, doc_sub_sector.document_id documents.document_id,
doc_sub_sector.sub_sector_name doc_sub_sector_lookup.sub_sector_name"""
_FK_SQL = [tuple(x.replace(".", " ").split()) for x in _PARENTS.split(",")]
_TABLE_ORDER = list(_KEYS_SQL)


@query("normalize_load_report", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM ({_table_sql(t)}) x" for t in _TABLE_ORDER))
def q_normalize_load_report(spark, sf_dir):
    """S12 over the 16 tables built from landed pages: rows counted while they were written, no table is scanned."""
    base = scratch_path(spark, "tables")
    _all_landed_tables(spark, sf_dir, base)
    return sinks.load_ledger(spark, base).groupBy("table_name").agg(F.sum("row_count").alias("row_count"))


def _pk_sql(t, key):
    return (f"SELECT 'pk:{t}' AS check_name, count(*) AS violations FROM (SELECT {key} "
            f"FROM ({_table_sql(t)}) x GROUP BY {key} HAVING count(*) > 1 OR {key} IS NULL) y")


def _fk_sql(child, column, parent, key):
    return (f"SELECT 'fk:{child}.{column}' AS check_name, count(*) AS violations FROM ({_table_sql(child)}) c "
            f"WHERE c.{column} IS NOT NULL AND c.{column} NOT IN (SELECT {key} FROM ({_table_sql(parent)}) p WHERE {key} IS NOT NULL)")


@query("normalize_integrity", "\nUNION ALL\n".join(
    [_pk_sql(t, k) for t, k in _KEYS_SQL.items()] + [_fk_sql(*x) for x in _FK_SQL]))
def q_normalize_integrity(spark, sf_dir):
    """K2+K3 on R10: every primary key and foreign key of the 16 built tables,
    one row per constraint with its violation count (expected 0)."""
    tables = _all_landed_tables(spark, sf_dir)
    parts = []
    for t, keys in PRIMARY_KEYS.items():
        parts.append(audit.pk_audit(tables[t].select(*keys), keys).agg(
            F.count(F.lit(1)).alias("violations")).select(F.lit(f"pk:{t}").alias("check_name"), "violations"))
    for child, ccols, parent, pcols in FOREIGN_KEYS:
        orphans = audit.fk_audit(tables[child].select(*ccols), tables[parent], ccols, pcols)
        parts.append(orphans.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(f"fk:{child}.{'+'.join(ccols)}").alias("check_name"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _union(parts: list) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_REQUIRED_SQL = [(t, k) for t, k in _KEYS_SQL.items()] + [
    ("project_major_sectors", "project_id"), ("project_major_sectors", "major_sector_code"), ("project_sectors", "project_id"),
    ("project_sectors", "project_major_sector_id"), ("project_sectors", "sector_code")]


@query("normalize_null_audit", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS row_count FROM ({_table_sql(t)}) x"
    for t, c in _REQUIRED_SQL))
def q_normalize_null_audit(spark, sf_dir):
    """K4: the key and NOT NULL columns of the 16 tables."""
    tables = _all_landed_tables(spark, sf_dir)
    return _union([audit.null_audit(tables[t], PRIMARY_KEYS[t] + NOT_NULL.get(t, [])).select(F.lit(t).alias("table_name"), "*") for t in _TABLE_ORDER])


# Declared widths of the 16 tables' text columns, written out for the oracle on its own.
_WIDTH_SQL = {
    "country": "countryshortname regionname", "projects": "project_id project_name countryshortname envassesmentcategorycode:1",
    "major_sector_lookup": "major_sector_code:3 major_sector_name", "proj_sector_lookup": "sector_code:3 sector_name",
    "doc_theme_lookup": "theme_name", "doc_sector_lookup": "sector_name", "doc_sub_sector_lookup": "sub_sector_name",
    "project_major_sectors": "project_id major_sector_code:3", "project_sectors": "project_id sector_code:3", "impagency": "project_id",
    "borrower": "project_id", "doc_country": "countryshortname", "doc_theme": "theme_name", "doc_sector": "sector_name", "doc_sub_sector": "sub_sector_name",
    "documents": "document_name document_type prdln lndinstr pdfurl txturl url maj_document_type disclstat versiontype author security_class "
                 "lang repnb display_title chronical_docm_id guid owner project_id"}


@query("normalize_length_audit", "SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, {w or 255} AS width, count(*) AS n_over, max(length({c})) AS longest "
    f"FROM ({_table_sql(t)}) x WHERE length({c}) > {w or 255}"
    for t, cs in _WIDTH_SQL.items() for c, _, w in (x.partition(":") for x in cs.split())) + ") y WHERE n_over > 0")
def q_normalize_length_audit(spark, sf_dir):
    """K5: values of the 16 tables over their declared widths, one scan per table."""
    tables = _all_landed_tables(spark, sf_dir)
    return _union([audit.length_audit(tables[t], TEXT_WIDTHS[t], []).groupBy("column_name", "width").agg(
        F.count(F.lit(1)).alias("n_over"), F.max("value_length").alias("longest")).select(F.lit(t).alias("table_name"), "*") for t in _TABLE_ORDER])


@query("failed_pages", f"""
SELECT CAST(y AS INTEGER) AS year, page_offset FROM (SELECT unnest(generate_series(0, (SELECT count(*) FROM orders) - 1, {PAGE_SIZE})) AS page_offset),
       (VALUES (0), (1)) v(y) WHERE page_offset % 300 = y * 100""")
def q_failed_pages(spark, sf_dir):
    """Pages planned from the totals that the landed pages state, against
    the pages that landed (every third of either year did not)."""
    pages = P.read_pages(spark, _land_document_pages(spark, sf_dir))
    landed = P.page_inventory(pages.where(F.pmod("offset", F.lit(300)) != F.col("year") * 100))
    plan = pageplan.page_plan(landed.groupBy("year").agg(F.max("total").alias("total")), "year", PAGE_SIZE)
    return pageplan.missing_pages(plan, landed.select("year", F.col("offset").alias("page_offset")))


from finmesh.operators.keys import append_with_keys  # noqa: E402


@query("append_surrogate_keys", """
SELECT o_orderkey, row_number() OVER (ORDER BY CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END, o_orderkey)
       AS order_id
FROM orders""")
def q_append_surrogate_keys(spark, sf_dir):
    """S6+K1: a table loaded in two batches; the second batch's keys continue
    after the first batch's largest key (read back from storage)."""
    o = DriverTables(spark, sf_dir)("orders", "o_orderkey", "o_orderstatus")
    first = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    base = scratch_path(spark, "append-keys")
    batch1 = with_surrogate_key(o.filter(first).select("o_orderkey"), ["o_orderkey"], "order_id")
    sinks.append_load({"orders": batch1}, base)
    loaded = sinks.read_back(spark, base, "orders")
    batch2 = append_with_keys(loaded, o.filter(~first).select("o_orderkey"), ["o_orderkey"], "order_id")
    sinks.append_load({"orders": batch2}, base)
    return sinks.read_back(spark, base, "orders")


# ------------------------------------------------------------------ marts over the built tables (R10 -> R1, R7, R8)
def _sub(name: str) -> str:
    return f"({_table_sql(name)})"


_BUILT_MART_SQL = f"""
SELECT p.project_id, p.countryshortname, p.totalamt, msl.major_sector_code, msl.major_sector_name,
       sl.sector_code, sl.sector_name, ps.sector_percent,
       CAST(p.totalamt * ps.sector_percent * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(30,8)) AS allocated_amount
FROM {_sub('projects')} p
JOIN {_sub('project_major_sectors')} pms ON p.project_id = pms.project_id
JOIN {_sub('major_sector_lookup')} msl ON pms.major_sector_code = msl.major_sector_code
JOIN {_sub('project_sectors')} ps ON pms.project_major_sector_id = ps.project_major_sector_id
JOIN {_sub('proj_sector_lookup')} sl ON ps.sector_code = sl.sector_code"""


def _built_mart(spark, sf_dir):
    t = _all_landed_tables(spark, sf_dir)
    return marts.sector_mart(t["projects"], t["project_major_sectors"], t["major_sector_lookup"],
                             t["project_sectors"], t["proj_sector_lookup"])


@query("normalize_project_document_dates", f"""
SELECT p.project_id, p.countryshortname, p.boardapprovaldate, d.docdt,
       d.document_type, d.document_id
FROM {_sub('projects')} p JOIN {_sub('documents')} d ON p.project_id = d.project_id""")
def q_normalize_project_document_dates(spark, sf_dir):
    """R1 over the projects and documents built from landed pages."""
    t = _all_landed_tables(spark, sf_dir)
    return marts.project_document_dates(t["projects"], t["documents"])


@query("normalize_sector_mart", _BUILT_MART_SQL)
def q_normalize_sector_mart(spark, sf_dir):
    """The 9-column mart over the five built tables, joined through the
    bridge's surrogate key."""
    return _built_mart(spark, sf_dir)


@query("normalize_top_sectors", f"""
SELECT sector_name, CAST(SUM(allocated_amount) AS DECIMAL(38,8)) AS allocated_amount
FROM ({_BUILT_MART_SQL}) m WHERE countryshortname = '{FLAGSHIP_COUNTRY}'
GROUP BY sector_name ORDER BY allocated_amount DESC, sector_name LIMIT {TOP_K}""")
def q_normalize_top_sectors(spark, sf_dir):
    """R8 exactly as the chart reads it, over the mart built from landed pages."""
    return marts.top_sectors(_built_mart(spark, sf_dir), FLAGSHIP_COUNTRY, TOP_K)
