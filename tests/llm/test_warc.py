"""Archives: round trip, revisits, rolling, and the same bytes whatever the order of arrival."""
import hashlib
import random

from finmesh.llm import warc
from finmesh.session import scratch_path

LONG = "<html>" + "x" * 2000
ROWS = [(1, "http://a/", LONG), (2, "http://b/\n\u00e9", LONG), (3, None, "short"), (4, "u", "short"), (5, "u", None), (6, "v", ""),
        (None, "n", LONG), (9, "w", LONG), (9, "w", LONG), (7, "z", "y" * 999), (8, "z", "y" * 999), (10, "q", "\u00e9" * 500), (11, "q", "\u00e9" * 500)]
SCHEMA = "page_id long, url string, html string"


def written(spark, rows, **options):
    folder = scratch_path(spark, "warc-test")
    return warc.write(spark.createDataFrame(rows, SCHEMA).repartition(3), folder, **options), folder


def test_round_trip(spark):
    manifest, folder = written(spark, ROWS)
    got = warc.read(spark, folder).collect()
    assert len(got) == len(ROWS) == manifest.agg({"records": "sum"}).first()[0]
    for r in got:
        html = next((h or "") for i, _, h in ROWS if i == r.id)
        data = html.encode()
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == data
        assert r.url in {u for i, u, _ in ROWS if i == r.id}
    assert sum(r.record_type == "response" for r in got if r.id == 9) == 1
    assert all((r.refers_to is None) == (r.record_type == "response") for r in got)
    assert {(r.id, r.refers_to) for r in got if r.record_type == "revisit"} == {(None, 9), (1, 9), (2, 9), (9, 9), (10, 11)}


def test_urls_come_back_as_they_were(spark):
    urls = ["http://x/a%20b?q=%41", "http://x/a b", "http://x/\u00e9%C3%A9", "http://x/%", "\r\nWARC-Type: response", "", " http://x/ ", None]
    _, folder = written(spark, [(i, u, "page") for i, u in enumerate(urls)])
    assert [r.url for r in warc.read(spark, folder).orderBy("id").collect()] == urls


def test_clashing_columns(spark, clashing):
    folder = scratch_path(spark, "warc-clash")
    warc.write(clashing, folder, "doc_id", "digest", "text")
    assert sorted((r.id, r.url, bytes(r.payload)) for r in warc.read(spark, folder).collect()) == [
        (1, "k", b"Some text here"), (2, "k", b"some TEXT here"), (3, None, b"")]


def test_rolls_by_compressed_size(spark):
    rng = random.Random(1)
    rows = [(i, "u", "".join(rng.choices("abcdefgh ", k=3000))) for i in range(60)]
    manifest, folder = written(spark, rows, roll_bytes=8000)
    files = manifest.collect()
    assert len(files) > 6 and all(f.bytes < 8000 + 4000 for f in files)
    assert warc.read(spark, folder).count() == 60


def test_same_bytes_whatever_the_order(spark):
    rows = [(i, f"u{i}", LONG if i % 3 else f"page {i}") for i in range(40)]
    shas = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        manifest, _ = written(spark, rows)
        shas.append(sorted(r.sha256 for r in manifest.collect()))
    assert shas[0] == shas[1]


def test_empty_table(spark):
    _, folder = written(spark, [])
    assert warc.read(spark, folder).collect() == []
