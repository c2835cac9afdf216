"""Incremental ingest: each landed page file is ingested exactly once."""
import json
import os

from pyspark.sql import functions as F

from finmesh.streaming import ingest_pages
from finmesh.streaming.landing import read_bronze
from tests.payloads import DOC_PAGE_2021_0, PROJECT_PAGE_0, PROJECT_PAGE_1


def _land(folder, name, line):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(json.dumps(line) + "\n")


def test_ingest_is_incremental_and_exactly_once(spark, tmp_path):
    landing, bronze, ckpt = str(tmp_path / "landing"), str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    _land(landing, "p0.json", {"source": "projects", "year": None, "offset": 0, "body": PROJECT_PAGE_0})
    ingest_pages(spark, landing, bronze, ckpt)
    assert read_bronze(spark, bronze, "projects").count() == 5
    ingest_pages(spark, landing, bronze, ckpt)          # nothing new: nothing appended
    assert read_bronze(spark, bronze, "projects").count() == 5
    _land(landing, "p1.json", {"source": "projects", "year": None, "offset": 1000, "body": PROJECT_PAGE_1})
    _land(landing, "d0.json", {"source": "documents", "year": 2021, "offset": 0, "body": DOC_PAGE_2021_0})
    ingest_pages(spark, landing, bronze, ckpt)
    p = read_bronze(spark, bronze, "projects")
    assert p.count() == 7
    assert sorted(r.record_key for r in p.filter(F.col("page_offset") == 1000).collect()) == ["P1", "P6"]
    d = read_bronze(spark, bronze, "documents").collect()
    assert [(r.record_key, r.total, r.page_year) for r in d] == [("D14", 1, 2021)]


def test_default_settings_resume(spark, tmp_path):
    """Without an explicit checkpoint a second run still adds what landed since."""
    landing, bronze = str(tmp_path / "landing"), str(tmp_path / "bronze")
    _land(landing, "p0.json", {"source": "projects", "year": None, "offset": 0, "body": PROJECT_PAGE_0})
    ingest_pages(spark, landing, bronze)
    _land(landing, "p1.json", {"source": "projects", "year": None, "offset": 1000, "body": PROJECT_PAGE_1})
    ingest_pages(spark, landing, bronze)
    ingest_pages(spark, landing, bronze)
    assert read_bronze(spark, bronze, "projects").count() == 7
