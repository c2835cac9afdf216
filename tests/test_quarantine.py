"""A record that is none costs its neighbours nothing."""
import json

from pyspark.sql import functions as F

from finmesh.operators.generators import explode_keyed_records
from finmesh.plans import normalize, pageplan
from finmesh.schemas import DOCUMENT_RECORD
from finmesh.sources import pages as P
from finmesh.streaming import ingest_pages
from finmesh.streaming.landing import read_bronze


def _record(i, **more):
    return {"id": str(i), "projectid": "P1", **more}


def _land(path):
    page = lambda source, offset, body, **more: {"source": source, "year": 2020, "offset": offset, "body": body, **more}
    lines = [
        json.dumps(page("documents", 0, {"total": "500", "documents": {
            "D1": _record(1), "X1": "oops", "D2": _record(2), "X2": 7, "X3": None, "X4": [1, {"a": 2}], "D3": _record(3), "facets": "none"}})),
        json.dumps(page("projects", 0, {"projects": {"P1": {"id": "P1"}, "P2": "text", "P3": {"id": "P3", "major_sectors": "x"}}})),
        json.dumps(page("documents", 100, {"total": "500", "documents": [1, 2]})),                # the map is a list
        json.dumps(page("documents", 200, "no object")),
        json.dumps(page("documents", 300, {"total": "500"})),                                     # no records at all
        json.dumps(page("documents", 400, {"total": "500", "documents": {}})),
        json.dumps(page("loans", 0, {"loans": {"L1": {"id": "1"}}})),
        json.dumps(page("documents", 0, {"documents": {"D9": _record(9)}}))[:-25],                # torn
        '[1, 2]',
        # a field that is repeated: the last one counts, the page is kept
        '{"source":"documents","year":2021,"offset":0,"body":{"documents":{"D4":{"id":"4","id":"44","projectid":"P1"}}}}',
    ]
    path.write_text("\n".join(lines) + "\n")
    return str(path), lines


def test_records_beside_bad_ones(spark, tmp_path):
    pages = P.read_pages(spark, _land(tmp_path / "p.jsonl")[0])
    docs = {r.record_key: r for r in P.document_records(pages).collect()}
    assert sorted((k, r.record.id, r.pos) for k, r in docs.items()) == [("D1", "1", 0), ("D2", "2", 2), ("D3", "3", 6), ("D4", "44", 0)]
    assert sorted((r.record_key, r.record.major_sectors) for r in P.project_records(pages).collect()) == [("P1", None), ("P3", "x")]
    assert normalize.kept_documents(P.document_records(pages)).count() == 4


def test_rejects(spark, tmp_path):
    path, lines = _land(tmp_path / "p.jsonl")
    rows = P.rejected_records(P.read_pages(spark, path)).collect()
    got = {(r.source, r.page_offset, r.pos, r.record_key, r.reason, r.raw) for r in rows}
    assert got == {
        ("documents", 0, 1, "X1", "not an object", '"oops"'), ("documents", 0, 3, "X2", "not an object", "7"),
        ("documents", 0, 4, "X3", "not an object", "null"), ("documents", 0, 5, "X4", "not an object", '[1,{"a":2}]'),
        ("projects", 0, 1, "P2", "not an object", '"text"'),
        ("documents", 100, None, None, "broken body", '{"total": "500", "documents": [1, 2]}'),
        ("documents", 200, None, None, "broken body", "no object"), ("documents", 300, None, None, "broken body", '{"total": "500"}'),
        ("loans", 0, None, None, "unknown source", '{"loans": {"L1": {"id": "1"}}}'),
        (None, None, None, None, "broken line", lines[7]), (None, None, None, None, "broken line", "[1, 2]")}
    assert len(rows) == len(got)


def test_every_entry_is_a_record_or_a_reject(spark, tmp_path):
    pages = P.read_pages(spark, _land(tmp_path / "p.jsonl")[0])
    inventory = P.page_inventory(pages).where("source = 'documents' and year = 2020")
    assert sorted((r.offset, r.records, r.rejected, r.total) for r in inventory.collect()) == [(0, 3, 4, 500), (400, 0, 0, 500)]
    plan = pageplan.page_plan(inventory.groupBy("year").agg(F.max("total").alias("total")), "year", 100)
    landed = inventory.withColumnRenamed("offset", "page_offset")
    # pages that cannot be read have failed; entries that are no records are not done
    assert sorted(r.page_offset for r in pageplan.missing_pages(plan, landed).collect()) == [100, 200, 300]
    row = pageplan.completeness(plan, landed).first()
    assert (row.landed_pages, row.failed_pages, row.landed_records, row.pct_done) == (2, 3, 3, 0.6)


def test_pages_without_rejects_and_empty_landing(spark, tmp_path):
    (tmp_path / "e").mkdir()
    pages = P.read_pages(spark, str(tmp_path / "e"))
    assert P.rejected_records(pages).collect() == [] == P.document_records(pages).collect()


def test_stream_keeps_the_quarantine(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    _land(tmp_path / "landing" / "p.jsonl")
    bronze = str(tmp_path / "bronze")
    ingest_pages(spark, str(tmp_path / "landing"), bronze)
    ingest_pages(spark, str(tmp_path / "landing"), bronze)
    assert sorted(r.record_key for r in read_bronze(spark, bronze, "documents").collect()) == ["D1", "D2", "D3", "D4"]
    assert sorted(r.record_key for r in read_bronze(spark, bronze, "projects").collect()) == ["P1", "P3"]
    rejected = read_bronze(spark, bronze, "rejected")
    assert rejected.count() == 11 and rejected.where("reason = 'broken line'").count() == 2


def test_numbered_maps_keep_the_order_of_their_numbers(spark, tmp_path):
    sectors = {str(i): {"sector": f"S{i}"} for i in range(12)}
    body = {"documents": {"D1": _record(1, sectr=sectors)}}
    path = tmp_path / "p.jsonl"
    path.write_text(json.dumps({"source": "documents", "year": 1, "offset": 0, "body": body}) + "\n")
    projects, country = spark.createDataFrame([("P1",)], "project_id string"), spark.createDataFrame([], "countryshortname string")
    t = normalize.build_document_tables(P.document_records(P.read_pages(spark, str(path))), projects, country)
    got = sorted((r.doc_sector_id, r.sector_name) for r in t["doc_sector"].collect())
    assert got == [(i + 1, f"S{i}") for i in range(12)]


def test_one_parse_of_each_body(spark, tmp_path):
    pages = P.read_pages(spark, _land(tmp_path / "p.jsonl")[0])
    plan = P.document_records(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    generic = explode_keyed_records(pages.where("source = 'documents'"), "body", "documents", DOCUMENT_RECORD, keep=["offset"])
    assert generic.count() == 4
