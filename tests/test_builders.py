"""The 16 normalised tables on hand-made pages (R10), with expected rows."""
import datetime as dt
import os
from decimal import Decimal

import pytest

from finmesh.operators import audit
from finmesh.plans import normalize
from finmesh.schemas import FOREIGN_KEYS, PRIMARY_KEYS
from finmesh.sources import pages as P
from tests.payloads import LONG_TITLE, write_pages


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = write_pages(str(tmp_path_factory.mktemp("pages") / "pages.jsonl"))
    pages = P.read_pages(spark, path)
    t = normalize.build_all(P.project_records(pages), P.document_records(pages))
    return {k: v.collect() for k, v in t.items()}, t


def rows(tables, name, *cols):
    got = tables[0][name]
    return sorted(tuple(r[c] for c in cols) for r in got) if cols else got


def test_country(tables):
    assert rows(tables, "country", "countryshortname", "regionname") == sorted([
        ("Kenya", "Eastern Africa"), ("Chad", None), ("Other", None), ("Peru", "Other")],
        key=lambda x: x[0])


def test_projects(tables):
    got = {r["project_id"]: r for r in rows(tables, "projects")}
    assert sorted(got) == ["P1", "P2", "P3", "P4", "P5", "P6"]
    assert got["P1"]["project_name"] == "Water One"           # first row kept
    assert got["P1"]["totalamt"] == Decimal("1000000.00")
    assert got["P1"]["boardapprovaldate"] == dt.date(2020, 5, 14)
    assert got["P1"]["closingdate"] == dt.date(2025, 6, 30)
    assert got["P2"]["totalamt"] == Decimal("2500.01")          # half-up
    assert got["P2"]["boardapprovaldate"] is None and got["P2"]["closingdate"] is None
    assert got["P5"]["lendprojectcost"] is None
    assert got["P3"]["countryshortname"] is None


def test_sector_lookups(tables):
    assert rows(tables, "major_sector_lookup", "major_sector_code", "major_sector_name") == [
        ("EEX", "Energy"), ("WWX", "Water")]
    assert rows(tables, "proj_sector_lookup", "sector_code", "sector_name") == [
        ("WWA", "Sanitation "), ("WWC", "Water Supply")]


def test_bridges(tables):
    assert rows(tables, "project_major_sectors", "project_major_sector_id", "project_id",
                "major_sector_code") == [(1, "P1", "WWX"), (2, "P1", "EEX"), (3, "P1", "WWX"),
                                         (4, "P1", "EEX"), (5, "P6", "WWX")]
    assert rows(tables, "project_sectors", "project_sector_id", "project_id",
                "project_major_sector_id", "sector_code", "sector_percent") == [
        (1, "P1", 1, "WWA", Decimal("60.00")), (2, "P1", 1, "WWC", Decimal("40.00")),
        (3, "P1", 1, "WWA", Decimal("60.00")), (4, "P1", 1, "WWC", Decimal("40.00")),
        (5, "P6", 5, "WWA", None)]


def test_building_one_table_numbers_nothing(spark, tmp_path):
    """The country table is built without a surrogate-key write; the landing is parsed and stored once for all tables."""
    import os
    from finmesh.session import scratch, scratch_root
    path = write_pages(str(tmp_path / "pages.jsonl"))
    with scratch(spark):
        t = normalize.build_project_tables(P.project_records(P.read_pages(spark, path)))
        assert t["country"].count() == 4
        made = os.listdir(scratch_root(spark).replace("file:", ""))
        assert [m.rsplit("-", 1)[0] for m in made] == ["project-flat"]
        assert t["borrower"].count() == 4 and t["impagency"].count() == 4
        made = os.listdir(scratch_root(spark).replace("file:", ""))
        assert sorted(m.rsplit("-", 1)[0] for m in made) == ["list-offsets", "list-sizes", "project-flat"]
    assert not os.path.exists(scratch_root(spark).replace("file:", "") + "/" + made[0])


def test_refetched_page_wins(spark, tmp_path):
    """A page fetched again replaces what it had, whatever the order of files; its
    first-seen rows and offsets beyond 2^31 keep their order."""
    import json
    rec = lambda v: {"total": "1", "documents": {"D1": {"id": "1", "projectid": "P1", "docty": v}}}
    lines = [{"source": "documents", "seq": 9, "year": 2020, "offset": 3_000_000_000, "body": rec("new")},
             {"source": "documents", "seq": 2, "year": 2020, "offset": 3_000_000_000, "body": rec("old")}]
    for name, order in (("a", lines), ("b", lines[::-1])):
        path = tmp_path / f"{name}.jsonl"
        path.write_text("".join(json.dumps(x) + "\n" for x in order))
        kept = normalize.kept_documents(P.document_records(P.read_pages(spark, str(path)))).collect()
        assert [(r.record.docty, r.first_seen.landing_seq, r.first_seen.page_offset) for r in kept] == [("new", 2, 3_000_000_000)]


def test_string_that_looks_like_a_map(spark, tmp_path):
    import json
    body = {"documents": {"D1": {"id": "1", "projectid": "P1", "authors": '{"0": {"author": "x"}}', "docna": {"0": {"docna": "real"}}}}}
    path = tmp_path / "p.jsonl"
    path.write_text(json.dumps({"source": "documents", "year": 1, "offset": 0, "body": body}) + "\n")
    row = normalize.flatten_documents(normalize.kept_documents(P.document_records(P.read_pages(spark, str(path))))).first()
    assert (row.author, row.document_name) == ('{"0": {"author": "x"}}', "real")


def test_name_lists(tables):
    assert rows(tables, "borrower", "borrower_id", "borrower_name", "project_id") == [
        (1, "Ministry of Water", "P1"), (2, "Sanitation", "P1"),
        (3, "Ministry of Water", "P1"), (4, "Sanitation", "P1")]
    assert rows(tables, "impagency", "impagency_id", "impagency_name") == [
        (1, "A"), (2, "B"), (3, "A"), (4, "B")]


def test_documents(tables):
    got = {r["document_id"]: r for r in rows(tables, "documents")}
    assert sorted(got) == [10, 13, 14]                      # '' projectid and unknown project dropped
    d10 = got[10]
    assert d10["document_type"] == "Report v2"              # last write wins
    assert d10["docdt"] == dt.date(2026, 12, 31)            # date as written
    assert d10["volnb"] == 2 and d10["author"] == "AB" and d10["document_name"] == "Doc ten"
    d13 = got[13]
    assert d13["author"] == "plain author"
    assert d13["document_name"] == '{"1":{"docna":"no zero"}}'
    assert d13["volnb"] is None and d13["display_title"] == LONG_TITLE
    assert got[14]["docdt"] == dt.date(2021, 3, 4) and got[14]["volnb"] == 1


def test_document_children(tables):
    assert rows(tables, "doc_sector", "doc_sector_id", "sector_name", "document_id") == [(1, "Energy", 10)]
    assert rows(tables, "doc_sector_lookup", "sector_name") == [("Energy",)]
    assert rows(tables, "doc_theme", "doc_theme_id", "theme_name", "document_id") == [
        (1, "a", 10), (2, "b", 10), (3, "Tabbed", 13), (4, "Trail", 13)]
    assert rows(tables, "doc_theme_lookup", "theme_name") == [("Tabbed",), ("Trail",), ("a",), ("b",)]
    # the lookup spans all kept documents (incl. the unknown project), lower-cased
    assert rows(tables, "doc_sub_sector_lookup", "sub_sector_name") == [("mining only",), ("other industry",)]
    assert rows(tables, "doc_sub_sector", "doc_sub_sector_id", "sub_sector_name", "document_id") == [
        (1, "other industry", 10), (2, "other industry", 14)]
    assert rows(tables, "doc_country", "doc_country_id", "countryshortname", "document_id") == [
        (1, "Peru", 10), (2, "Other", 13)]


def test_audits_on_built_tables(tables):
    t = tables[1]
    for name, keys in PRIMARY_KEYS.items():
        assert audit.pk_audit(t[name], keys).count() == 0, name
    orphans = {}
    for child, ccols, parent, pcols in FOREIGN_KEYS:
        orphans[(child, tuple(ccols))] = audit.fk_audit(t[child], t[parent], ccols, pcols).count()
    # the only planted orphans: project P3/P4... have no country FK; bridges of P1 are fine
    assert all(v == 0 for v in orphans.values()), orphans
    long_titles = audit.length_audit(t["documents"], {"display_title": 255}, ["document_id"]).collect()
    assert [(r.document_id, r.value_length) for r in long_titles] == [(13, 300)]


def test_case_variants_of_sub_sectors(spark, tmp_path):
    from finmesh.operators.generators import explode_delimited
    path = write_pages(str(tmp_path / "pages.jsonl"))
    kept = normalize.kept_documents(P.document_records(P.read_pages(spark, path)))
    flat = kept.select("record.subsc")
    pieces = explode_delimited(flat, "subsc", "name")
    got = [(r.name_key, r.n_variants, r.n_rows) for r in audit.case_variant_audit(pieces, "name").collect()]
    assert got == [("other industry", 2, 2)]


def test_store_all(spark, tmp_path):
    from finmesh.plans import marts
    path = write_pages(str(tmp_path / "pages.jsonl"))
    pages = P.read_pages(spark, path)
    built = normalize.build_all(P.project_records(pages), P.document_records(pages))
    loaded = normalize.store_all(P.project_records(pages), P.document_records(pages), str(tmp_path / "db"))
    assert {k: v.count() for k, v in loaded.items()} == {k: v.count() for k, v in built.items()}
    detail = marts.project_sector_detail(loaded["projects"], loaded["project_major_sectors"],
                                         loaded["major_sector_lookup"], loaded["project_sectors"],
                                         loaded["proj_sector_lookup"])
    assert [(r.project_id, r.major_sector_code, r.sector_code) for r in detail.collect()] == [
        ("P1", "WWX", "WWA"), ("P1", "WWX", "WWA"), ("P1", "WWX", "WWC"), ("P1", "WWX", "WWC"),
        ("P6", "WWX", "WWA")]


def test_bridges_of_one_build_read_their_lists_as_stored(spark, tmp_path):
    """The records are shuffled once for all bridges, by page: none of them joins or shuffles a record again."""
    path = write_pages(str(tmp_path / "pages.jsonl"))
    t = normalize.build_project_tables(P.project_records(P.read_pages(spark, path)))
    for name in ("borrower", "impagency", "project_major_sectors"):
        plan = t[name]._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan, name


def test_stored_tables_leave_no_pages_behind(spark):
    """What was landed and stored on the way is gone, the 16 tables stay."""
    from finmesh.plans import catalog
    from finmesh.session import scratch, scratch_root
    from tests.conftest import SF001
    with scratch(spark):
        loaded = catalog._all_landed_tables(spark, SF001)
        made = [m for m in os.listdir(scratch_root(spark).replace("file:", "")) if not m.startswith(".")]
        assert len(made) == 1 and made[0].startswith("tables-")
        assert loaded["projects"].count() > 0 and loaded["documents"].count() > 0


def test_page_inventory(spark, tmp_path):
    path = write_pages(str(tmp_path / "pages.jsonl"))
    inv = sorted(tuple(r) for r in P.page_inventory(P.read_pages(spark, path)).collect())
    assert inv == [("documents", 2020, 0, 3, 1500, 0), ("documents", 2020, 1000, 2, 1500, 0),
                   ("documents", 2021, 0, 1, 1, 0), ("projects", None, 0, 5, None, 0),
                   ("projects", None, 1000, 2, None, 0)]


def test_landed_project_pages_are_compressed_and_leave_no_numbering(spark, tmp_path):
    """Repeated parents repeat a record under its one number, a line item without a parent has none; pages lie compressed
    and what numbered them is gone."""
    import glob
    from finmesh.plans.landed import land_project_pages
    from finmesh.session import scratch, scratch_root
    day = dt.datetime(2001, 2, 3)
    write = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    line = lambda o, no, p, flag="N": (o, p, 3, no, 1.0, 2.0, 0.05, 0.0, flag, "O", day)
    write("lineitem", [line(1, 1, 7), line(1, 2, 8), line(2, 1, 7), line(2, 1, 7), line(3, 1, 7), line(4, 1, 99), line(None, 1, 7)],
          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
          "l_returnflag string, l_linestatus string, l_shipdate timestamp")
    write("orders", [(1, 5, "O", 10.0, day, "5-LOW"), (2, 6, "O", 20.0, day, "5-LOW"), (2, None, "F", 21.0, day, "5-LOW"), (4, 5, "O", 1.0, day, "5-LOW")],
          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
    write("customer", [(5, "C5", "M", 0)], "c_custkey long, c_name string, c_mktsegment string, c_nationkey int")
    write("nation", [(0, "N0", 0)], "n_nationkey int, n_name string, n_regionkey int")
    write("region", [(0, "R0")], "r_regionkey int, r_name string")
    write("part", [(7, "seven", "T"), (8, "eight", "T")], "p_partkey long, p_name string, p_type string")
    with scratch(spark):
        path = land_project_pages(spark, str(tmp_path), page_size=2)
        made = os.listdir(scratch_root(spark).replace("file:", ""))
        assert [m.rsplit("-", 1)[0] for m in made if not m.startswith(".")][0] == "project-pages" and len(made) == 1
        parts = glob.glob(path.replace("file:", "") + "/part-*")
        assert parts and all(p.endswith(".gz") for p in parts)
        records = P.project_records(P.read_pages(spark, path)).collect()
    assert sorted((r.page_offset, r.record_key, r.record.totalamt) for r in records) == [
        (0, "P1-0", "10.00"), (0, "P1-1", "10.00"), (2, "P2-2", "20.00"), (2, "P2-2", "21.00"), (2, "P2-3", "20.00"), (2, "P2-3", "21.00")]


def test_pages_are_gathered_by_few_per_task(spark, tmp_path):
    """A task gathers fewer pages than Spark gathers without sorting (and spilling) their texts; an order that repeats repeats
    its lines under their numbers."""
    import glob
    import gzip
    from finmesh.plans.landed import land_project_pages
    from finmesh.session import scratch
    write = lambda name, df: df.write.parquet(f"{tmp_path}/{name}.parquet")
    day = "timestamp'2001-02-03' AS"
    write("lineitem", spark.range(600).selectExpr(
        "id div 2 AS l_orderkey", "7L AS l_partkey", "3L AS l_suppkey", "int(id % 2) AS l_linenumber", "1d AS l_quantity", "2d AS l_extendedprice",
        "0.05d AS l_discount", "0d AS l_tax", "'N' AS l_returnflag", "'O' AS l_linestatus", f"{day} l_shipdate"))
    write("orders", spark.range(301).selectExpr("least(id, 299L) AS o_orderkey", "5L AS o_custkey", "'O' AS o_orderstatus", "double(id) AS o_totalprice",
                                                f"{day} o_orderdate", "'5-LOW' AS o_orderpriority"))
    write("customer", spark.sql("SELECT 5L AS c_custkey, 'C5' AS c_name, 'M' AS c_mktsegment, 0 AS c_nationkey"))
    write("nation", spark.sql("SELECT 0 AS n_nationkey, 'N0' AS n_name, 0 AS n_regionkey"))
    write("region", spark.sql("SELECT 0 AS r_regionkey, 'R0' AS r_name"))
    write("part", spark.sql("SELECT 7L AS p_partkey, 'seven' AS p_name, 'T' AS p_type"))
    with scratch(spark):
        path = land_project_pages(spark, str(tmp_path), page_size=1)
        offsets = []
        for part in glob.glob(path.replace("file:", "") + "/part-*"):
            with gzip.open(part, "rt") as f:
                offsets.append(len({line.split('"offset":')[1].split(",")[0] for line in f}))
        assert sum(offsets) == 600 and max(offsets) <= 128
        records = P.project_records(P.read_pages(spark, path)).collect()
    assert sorted((r.page_offset, r.record_key, r.record.totalamt) for r in records) == [
        (n, f"P{n // 2}-{n}", f"{n // 2}.00") for n in range(598)] + [(n, f"P299-{n}", t) for n in (598, 599) for t in ("299.00", "300.00")]


def test_a_table_by_itself_stores_no_flat_records(spark, tmp_path):
    from finmesh.session import scratch, scratch_root
    path = tmp_path / "pages"
    path.mkdir()
    (path / "p.json").write_text('{"source":"projects","seq":0,"offset":0,"body":{"projects":{"a":{"id":"P1","countryshortname":"X","borrower":"b, c"}}}}\n')
    with scratch(spark):
        t = normalize.build_project_tables(P.project_records(P.read_pages(spark, str(path))), shared=False)
        assert [tuple(r) for r in t["country"].collect()] == [("X", None)]
        folder = scratch_root(spark).replace("file:", "")
        assert not os.path.exists(folder) or not os.listdir(folder)
        assert sorted(tuple(r) for r in t["borrower"].collect()) == [(1, "b", "P1"), (2, "c", "P1")]
        assert not [m for m in os.listdir(folder) if m.startswith("project-flat")]


def test_known_ids_and_country_come_from_one_stored_parse(spark, tmp_path):
    """Each id once, whatever records repeat it; what documents look up is read from the stored frames, not from the pages."""
    from finmesh.session import scratch
    path = tmp_path / "pages"
    path.mkdir()
    record = lambda key, pid, land: f'"{key}":{{"id":{pid},"countryshortname":"{land}","regionname":"R"}}'
    (path / "p.json").write_text('{"source":"projects","seq":0,"offset":0,"body":{"projects":{%s}}}\n' % ",".join(
        [record("a", '"P1"', "X"), record("b", '"P1"', "Y"), record("c", '"P2"', "X"), record("d", "null", "Z")]))
    with scratch(spark):
        t = normalize.build_project_tables(P.project_records(P.read_pages(spark, str(path))), shared=False)
        ids, country = t.known_ids, t["country"]
        assert not any("pages" in f for frame in (ids, country) for f in frame.inputFiles())
        assert sorted((r[0] or "") for r in ids.collect()) == ["", "P1", "P2"]
        assert sorted(tuple(r) for r in country.collect()) == [("X", "R"), ("Y", "R"), ("Z", "R")]


def test_major_sectors_by_themselves_store_no_sectors(spark, tmp_path):
    from finmesh.session import scratch, scratch_root
    path = tmp_path / "pages"
    path.mkdir()
    majors = '[{"major_sector":{"major_sector_code":"A","major_sector_name":"a","sectors":[{"sector_code":"s","sector_percent":"5"}]}}]'
    (path / "p.json").write_text('{"source":"projects","seq":0,"offset":0,"body":{"projects":{"a":{"id":"P1","major_sectors":%s}}}}\n' % majors)
    for name, rows, columns in (("project_major_sectors", [(1, "P1", "A")], [{"majors"}]),
                                ("project_sectors", [(1, "P1", 1, "s", 5)], [{"majors", "sectors"}])):
        with scratch(spark):
            t = normalize.build_project_tables(P.project_records(P.read_pages(spark, str(path))), shared=False)
            assert [tuple(r) for r in t[name].collect()] == rows
            folder = scratch_root(spark).replace("file:", "")
            lists = [spark.read.parquet(f"{folder}/{m}").columns for m in os.listdir(folder) if m.startswith("project-lists")]
            assert [set(c) & {"majors", "sectors"} for c in lists] == columns


def test_a_list_of_major_sectors_is_parsed_once(spark):
    """Exploding a parsed list puts no filters below it that parse it again; entries without a major sector keep their place."""
    from finmesh.operators.generators import explode_major_sectors
    rows = [("P1", '{"id":"P1","major_sectors":[{"x":1},{"major_sector":{"major_sector_code":"A","major_sector_name":"a"}},null]}'),
            ("P2", '{"id":"P2","major_sectors":"n/a"}'), ("P3", '{"id":"P3","major_sectors":[]}'), ("P4", '{"id":"P4"}')]
    records = spark.createDataFrame(rows, "key string, record string").selectExpr(
        "0L AS landing_seq", "int(null) AS page_year", "0L AS page_offset", "0 AS pos", "record")
    out = explode_major_sectors(normalize.flatten_projects(records), "major_sectors", keep=["id"])
    assert [tuple(r) for r in out.collect()] == [("P1", 1, "A", "a")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(ArrayType") == 1


def test_documents_are_stored_on_their_pages_only(spark, tmp_path):
    """What numbered the documents is gone, texts and all; pages are whole and in order of the ids."""
    from finmesh.plans.landed import land_documents_table
    from finmesh.session import scratch, scratch_root
    spark.range(250).selectExpr("id * 3 AS doc_id", "'a,b' AS text", "'en' AS lang", "'s' AS source", "3L AS n_chars").repartition(3).write.parquet(
        f"{tmp_path}/documents.parquet")
    with scratch(spark):
        path = land_documents_table(spark, str(tmp_path), page_size=2)
        made = [m for m in os.listdir(scratch_root(spark).replace("file:", "")) if not m.startswith(".")]
        assert len(made) == 1 and made[0].startswith("documents-table-pages")
        records = P.document_records(P.read_pages(spark, path)).collect()
    assert sorted((r.page_offset, r.record_key) for r in records) == sorted((i // 2 * 2, f"D{3 * i}") for i in range(250))
    assert {r.total for r in records} == {250}


def test_document_tables_by_themselves_equal_those_built_together(spark, tmp_path):
    """Each takes the fields that it needs: no whole record is stored, and the rows are those of one build."""
    from finmesh.session import scratch, scratch_root
    pages = P.read_pages(spark, write_pages(str(tmp_path / "pages.jsonl")))
    projects = normalize.build_project_tables(P.project_records(pages))
    with scratch(spark):
        build = lambda shared: normalize.build_document_tables(P.document_records(pages), projects["projects"], projects["country"], shared)
        for name in normalize.DocumentTables.names:
            alone, rows = build(False), lambda df: sorted(tuple(map(str, r)) for r in df.collect())
            got = rows(alone[name])
            folder = scratch_root(spark).replace("file:", "")
            assert not os.path.exists(folder) or not [m for m in os.listdir(folder) if m.startswith("document-kept")], name
            with scratch(spark):
                assert got == rows(build(True)[name]), name


def test_only_used_fields_of_an_entry_are_got(spark, tmp_path):
    """Of a struct with more than one field taken, Spark gets every field."""
    flat = normalize.flatten_projects(P.project_entries(P.read_pages(spark, write_pages(str(tmp_path / "pages.jsonl")))))
    plan = flat.select("id", "countryshortname")._jdf.queryExecution().optimizedPlan().toString()
    assert "$.countryshortname" in plan and "$.project_name" not in plan
    whole = normalize.flatten_projects(P.project_records(P.read_pages(spark, str(tmp_path / "pages.jsonl"))))
    assert sorted(map(str, flat.collect())) == sorted(map(str, whole.collect()))


def test_document_bridges_of_one_build_read_their_lists_as_stored(spark, tmp_path):
    """A text is split, joined to its number and shuffled once for all that is made of its record."""
    pages = P.read_pages(spark, write_pages(str(tmp_path / "pages.jsonl")))
    tables = normalize.build_all(P.project_records(pages), P.document_records(pages))
    for name in ("doc_theme", "doc_sector", "doc_sub_sector"):
        plan = tables[name]._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan, name
    assert "theme" not in tables["doc_country"].columns and tables["doc_theme"].count() == tables["doc_theme"].select("doc_theme_id").distinct().count() > 0
