"""Driver tables landed as API pages, so the real ingest and table builders
run on data whose size follows the tables.

Project pages: every line item becomes one project record (so a project
appears once per line, across pages, as a project repeated between fetches
does), with nested major sectors, delimited borrower and agency lists and
planted edge cases.  Pages hold at most ``page_size`` records in a total
landing order; each page is one JSON line, compressed, under the shared scratch folder.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from finmesh.operators.joins import keep_known
from finmesh.operators.keys import MAX_PARTITIONS, blocks_of, with_totals_before
from finmesh.plans.standins import DriverTables, percent_of_discount
from finmesh.session import scratch, scratch_path, shuffles_freed

# Total order of line items (unique over the whole table).
LANDING_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
                 "l_discount", "l_tax", "l_extendedprice", "l_returnflag", "l_linestatus"]

def project_landing_rows(t: DriverTables, page_size: int) -> tuple[DataFrame, str]:
    """Line items numbered ``rn`` (0..n-1) in landing order, with their order, customer country and part attributes; and
    the column by which they are dealt out: all rows of a page have the same value there.

    Lines of one order are neighbours in landing order, so the line items per order are counted first and summed in
    order of the keys; a line's number is its order's sum plus its rank within the order.  Line items meet their order in the
    task that makes their pages (``keys.blocks_of``), so they are shuffled for their part and for their block only.  A part is one row per
    key that holds all rows of that key as a list: a line item meets it once, and repeats for every row of its parents after it is ranked."""
    li, part, orders = t("lineitem", *LANDING_ORDER), t("part", "p_partkey", "p_name", "p_type"), t(
        "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority")
    c = t("customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    n = t("nation", "n_nationkey", "n_name", "n_regionkey")
    r = t("region", "r_regionkey", "r_name")
    known = keep_known(li.select("l_orderkey", "l_partkey"), part, ["l_partkey"], ["p_partkey"])
    known = keep_known(known.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines")), orders, ["l_orderkey"], ["o_orderkey"])
    starts, rows = with_totals_before(known, ["l_orderkey"], ["lines"])
    blocks = blocks_of(starts, "l_orderkey", "lines_before", page_size, _block_rows(rows, page_size))
    cn = (c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
           .join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
           .select("c_custkey", "c_name", "c_mktsegment", "n_name", "r_name"))
    o = orders.join(cn, F.col("o_custkey") == F.col("c_custkey"), "left").select(F.col("o_orderkey").alias("l_orderkey"), F.struct(
        *orders.columns[2:], *cn.columns[1:]).alias("__order"))
    p = part.groupBy(F.col("p_partkey").alias("l_partkey")).agg(F.collect_list(F.struct("p_name", "p_type")).alias("__parts"))
    # One frame, so that one shuffle brings together what has the same order; a join would shuffle each by its key again.
    met = li.join(p, "l_partkey").unionByName(o, allowMissingColumns=True).unionByName(starts.drop("lines"), allowMissingColumns=True)
    dealt = met.where("l_orderkey is not null").withColumn(BLOCK, blocks.of(F.col("l_orderkey"))).repartition(len(blocks), BLOCK)
    in_order = Window.partitionBy(BLOCK, "l_orderkey").orderBy(F.col("__parts").isNull(), *LANDING_ORDER[1:])     # its lines come first
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = dealt.select(
        BLOCK, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_discount", "l_returnflag", "l_linestatus", "__parts",
        F.collect_list("__order").over(whole).alias("__orders"), (F.max("lines_before").over(whole) + F.row_number().over(in_order) - 1).alias("rn"))
    ranked = ranked.where("__parts is not null and rn is not null")
    numbered = ranked.select("*", F.inline("__orders")).drop("__orders")
    return numbered.select("*", F.inline("__parts")).drop("__parts"), BLOCK


def _project_record(rows: DataFrame) -> DataFrame:
    opened = F.col("l_linestatus") == "O"
    pr = F.col("o_orderpriority")
    region = (F.when(pr == "1-URGENT", F.col("n_name")).when(pr == "2-HIGH", F.lit("Other"))
               .when(pr == "3-MEDIUM", F.lit(None).cast("string")).otherwise(F.col("r_name")))
    base = F.struct(
        F.concat(F.lit("P"), F.col("l_orderkey").cast("string")).alias("id"),
        F.concat(F.lit("Project "), F.col("l_orderkey").cast("string"),
                 F.when(F.col("l_linenumber") == 1, F.lit("")).otherwise(
                     F.concat(F.lit(" line "), F.col("l_linenumber").cast("string")))).alias("project_name"),
        F.col("n_name").alias("countryshortname"),
        region.alias("regionname"),
        F.col("o_totalprice").cast("decimal(20,2)").cast("string").alias("totalamt"),
        F.lit("0").alias("grantamt"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00Z")).alias("boardapprovaldate"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("closingdate"),
        F.col("o_orderstatus").alias("envassesmentcategorycode"),
        F.concat(F.col("c_name"), F.lit(","), F.col("c_mktsegment")).alias("borrower"),
        F.concat(F.lit("Agency "), F.col("l_suppkey").cast("string"), F.lit(", Unit "),
                 F.col("l_linenumber").cast("string")).alias("impagency"))
    sector = F.struct(F.col("l_partkey").cast("string").alias("sector_code"),
                      F.concat(F.col("p_name"), F.when(opened, F.lit(" ")).otherwise(F.lit(""))).alias("sector_name"),
                      percent_of_discount().cast("string").alias("sector_percent"))
    major = F.struct(F.struct(
        F.col("p_type").alias("major_sector_code"),
        F.concat(F.lower("p_type"), F.when(opened, F.lit(" (open)")).otherwise(F.lit(""))).alias("major_sector_name"),
        F.array(sector).alias("sectors")).alias("major_sector"))
    ms_json = F.when(F.col("l_returnflag") == "R", F.lit('"n/a"')).otherwise(F.to_json(F.array(major)))
    base_json = F.to_json(base)
    # base object + a field whose JSON type differs between records
    record = F.concat(F.expr("substr(__b, 1, length(__b) - 1)"), F.lit(',"major_sectors":'), ms_json, F.lit("}"))
    return rows.withColumn("__b", base_json).select(BLOCK, "page", "rn", record.alias("record"),
                                                   F.col("l_orderkey").alias("__ok"))


# What is planted beside the records of a page: values that are no records.
BAD_ENTRIES = ['"oops"', "17", "null", '["a",1]', "true"]


def _with_bad_entry(body: Column, number: Column) -> Column:
    """A body whose map of records, its last field, gains an entry that is no record: on every third page."""
    bad = F.element_at(F.array(*map(F.lit, BAD_ENTRIES)), (F.floor(number / 3) % len(BAD_ENTRIES) + 1).cast("int"))
    entry = F.concat(F.lit(',"bad-'), number.cast("string"), F.lit('":'), bad, F.lit("}}"))
    return F.when(number % 3 == 0, F.concat(body.substr(F.lit(1), F.length(body) - 2), entry)).otherwise(body)


def _torn(source: str, year: Column, offset: Column) -> Column:
    """The beginning of a page's line, as a fetch that broke off leaves it."""
    return F.concat(F.lit(f'{{"source":"{source}","year":'), F.coalesce(year.cast("string"), F.lit("null")), F.lit(',"offset":'), offset.cast("string"), F.lit(',"body":{"'))


def land_project_pages(spark: SparkSession, sf_dir: str, page_size: int = 1000) -> str:
    """Write project pages for the whole ``lineitem`` table; return the folder."""
    path = scratch_path(spark, "project-pages")
    with scratch(spark):                                        # the numbering is no longer needed once the pages stand
        rows, block = project_landing_rows(DriverTables(spark, sf_dir), page_size)
        rows = rows.withColumn("page", F.floor(F.col("rn") / page_size))
        entry = F.struct(F.col("rn"), F.concat(
            F.lit('"P'), F.col("__ok").cast("string"), F.lit("-"), F.col("rn").cast("string"), F.lit('":'),
            F.col("record")).alias("text"))
        # A page holds at most ``page_size`` records: the group is bounded by construction.
        pages = _project_record(rows).groupBy(block, "page").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
        body = F.concat(F.lit('{"projects":{'), F.array_join("entries.text", ","),
                        F.lit("}}"))
        line = F.concat(F.lit('{"source":"projects","seq":0,"year":null,"offset":'),
                        (F.col("page") * page_size).cast("string"), F.lit(',"body":'), _with_bad_entry(body, F.col("page")), F.lit("}"))
        torn = F.when(F.col("page") % 5 == 2, _torn("projects", F.lit(None), F.col("page") * page_size))
        _write_pages(pages.select(F.explode(F.array_compact(F.array(line, torn))).alias("value")), path)
    return path


# The block of pages that one task makes.
BLOCK = "__block"
# Pages of a block.  Spark gathers lists of more than 128 groups by sorting all their rows, texts and all, and spills those; a task
# may have a few blocks, as they are dealt out by hash.
PAGES_PER_BLOCK = 24


def _block_rows(rows: int, page_size: int) -> int:
    """Rows of a block; beyond ``MAX_PARTITIONS`` blocks they grow with the input."""
    return page_size * max(PAGES_PER_BLOCK, -(-rows // (page_size * MAX_PARTITIONS)))


def _write_pages(lines: DataFrame, path: str) -> None:
    """Page lines as compressed text.  A file is one unit of reading: the partitions of ``lines`` are its bound."""
    with shuffles_freed(lines.sparkSession):
        lines.write.mode("overwrite").option("compression", "gzip").text(path)


def write_document_pages(spark: SparkSession, rows: DataFrame, year_col: str, page_size: int,
                         name: str) -> str:
    """Write document API pages from ``rn, <year_col>, key, rec`` rows (``rec`` a
    struct; null fields are left out of the JSON).  Pages of at most
    ``page_size`` records in ``rn`` order, each with the year's ``total`` and
    the ``facets: {}`` pseudo-record; some with an entry that is no record, and
    some that left a torn line when they were first fetched."""
    path = scratch_path(spark, name)
    _write_document_pages(rows, rows.groupBy(year_col).agg(F.count(F.lit(1)).cast("string").alias("total")), year_col, page_size, path)
    return path


def _write_document_pages(rows: DataFrame, totals: DataFrame, year_col: str, page_size: int, path: str, dealt_by: Sequence[str] = ()) -> None:
    """``dealt_by``: columns by which ``rows`` are partitioned already, with one value for all rows of a page, which are then
    gathered where they are."""
    rows = rows.withColumn("offset", (F.floor(F.col("rn") / page_size) * page_size).cast("long"))
    entry = F.struct(F.col("rn"), F.col("key"), F.col("rec").alias("value"))
    # A page holds at most ``page_size`` records: the group is bounded by construction.
    by_rn = lambda a, b: F.when(a["rn"] < b["rn"], -1).when(a["rn"] > b["rn"], 1).otherwise(0)
    pages = rows.groupBy(*dealt_by, year_col, "offset").agg(F.array_sort(F.collect_list(entry), by_rn).alias("entries"))
    facets = F.struct(F.lit("facets").alias("key"),
                      F.lit(None).cast(rows.schema["rec"].dataType).alias("value"))
    docs = F.map_from_entries(F.concat(
        F.transform("entries", lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))),
        F.array(facets)))
    body = F.struct(F.col("total"), docs.alias("documents"))
    number = F.col("offset") / page_size
    line = F.concat(F.lit('{"source":"documents","year":'), F.col(year_col).cast("string"), F.lit(',"offset":'), F.col("offset").cast("string"),
                    F.lit(',"body":'), _with_bad_entry(F.to_json(body), number.cast("long")), F.lit("}"))
    torn = F.when(number % 5 == 2, _torn("documents", F.col(year_col), F.col("offset")))
    # one row per year
    _write_pages(pages.join(F.broadcast(totals), year_col).select(F.explode(F.array_compact(F.array(line, torn))).alias("value")), path)


# The year of all pages of the ``documents`` table.
YEAR = 2020


def document_record(d: DataFrame) -> DataFrame:
    """The driver ``documents`` table as document records with every field of
    the payload: the whole text is the theme list, sub-sectors differ only by
    case, a sector map, countries known / case-variant / unknown, dates in
    three spellings and junk, a string that looks like a nested map, and
    planted falsy project ids and ids."""
    lang, no = F.col("lang"), F.col("doc_id").cast("string")
    day = F.date_format(F.date_add(F.lit("2001-02-03").cast("date"), F.pmod("doc_id", F.lit(3000)).cast("int")), "yyyy-MM-dd")

    def text(prefix, *more):
        return F.concat(F.lit(prefix), no, *map(F.lit, more))

    projectid = (F.when(lang == "de", F.lit("")).when(lang == "es", F.lit(None).cast("string"))
                  .otherwise(F.concat(F.lit("P"), F.col("doc_id").cast("string"))))
    rec = F.struct(
        F.when(F.pmod("doc_id", F.lit(53)) == 7, F.lit(None).cast("string")).when(
            F.pmod("doc_id", F.lit(53)) == 8, F.lit("")).otherwise(no).alias("id"),
        projectid.alias("projectid"),
        F.col("source").alias("docty"),
        F.col("lang").alias("lang"),
        F.create_map(F.lit("0"), F.create_map(F.lit("docna"), F.concat(
            F.lit("Document "), F.col("doc_id").cast("string")))).alias("docna"),
        F.create_map(F.lit("0"), F.create_map(F.lit("author"), F.col("source"))).alias("authors"),
        F.col("n_chars").cast("string").alias("volnb"),
        F.concat(F.lit("L"), F.pmod("doc_id", F.lit(7)).cast("string")).alias("prdln"),
        F.when(F.pmod("doc_id", F.lit(5)) == 0, F.lit('{"0":{"lndinstr":"x"}}')).otherwise(text("Instrument ")).alias("lndinstr"),
        F.concat(day, F.lit("T23:30:00Z")).alias("docdt"), day.alias("datestored"),
        F.when(lang == "fr", F.concat(day, F.lit("Tjunk"))).otherwise(day).alias("disclosure_date"),
        F.concat(day, F.lit(" 10:00:00")).alias("last_modified_date"),
        text("http://docs.example/", ".pdf").alias("pdfurl"), text("http://docs.example/", ".txt").alias("txturl"),
        text("http://docs.example/").alias("url"), F.concat(F.lit("Major "), F.col("source")).alias("majdocty"),
        F.when(F.pmod("doc_id", F.lit(2)) == 0, F.lit("Disclosed")).alias("disclstat"), F.lit("Final").alias("versiontyp"),
        F.lit("Public").alias("seccl"), text("R").alias("repnb"), text("Title of ").alias("display_title"),
        text("C").alias("chronical_docm_id"), text("G").alias("guid"), F.concat(F.lit("Owner "), F.col("source")).alias("owner"),
        F.col("text").alias("theme"),
        F.concat_ws(",", F.col("source"), F.upper("lang"), F.col("lang")).alias("subsc"),
        F.create_map(F.lit("0"), F.create_map(F.lit("sector"), F.col("source")),
                     F.lit("1"), F.create_map(F.lit("sector"), F.concat(F.lit(" "), lang, F.lit(" ")))
                     ).alias("sectr"),
        F.concat(F.lit("NATION_"), F.pmod(F.col("doc_id"), F.lit(25)).cast("string"), F.lit(",nation_"),
                 F.pmod(F.col("doc_id"), F.lit(7)).cast("string"), F.lit(",Atlantis")).alias("count"))
    return d.select("rn", *[c for c in d.columns if c == BLOCK], F.lit(YEAR).alias("year"),
                    F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("key"), rec.alias("rec"))


def land_documents_table(spark: SparkSession, sf_dir: str, page_size: int = 100) -> str:
    """Write the whole ``documents`` table as document pages; return the folder.  Only ids are summed up; a text is shuffled
    once, to the task that numbers it and makes its page, and stored on its page only."""
    docs = DriverTables(spark, sf_dir)("documents", "doc_id", "text", "lang", "source", "n_chars")
    path = scratch_path(spark, "documents-table-pages")
    with scratch(spark):
        known = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("docs"))
        starts, n = with_totals_before(known, ["doc_id"], ["docs"])
        blocks = blocks_of(starts, "doc_id", "docs_before", page_size, _block_rows(n, page_size))
        dealt = docs.withColumn(BLOCK, blocks.of(F.col("doc_id"))).repartition(len(blocks), BLOCK)
        rank = F.row_number().over(Window.partitionBy(BLOCK).orderBy("doc_id"))
        d = dealt.withColumn("rn", blocks.before(F.col(BLOCK)) + rank - 1)
        totals = spark.range(1).select(F.lit(YEAR).alias("year"), F.lit(str(n)).alias("total"))
        _write_document_pages(document_record(d), totals, "year", page_size, path, [BLOCK])
    return path
