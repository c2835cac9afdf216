"""The pipeline against a brute-force version, stage by stage."""
import corpus_pipeline as P
from finmesh.llm import secrets
from finmesh.llm.common import stored, table
from finmesh.llm.quality import RULES, Text
from tests.conftest import SF001
from tests.llm import test_exact_dedup, test_jaccard_join, test_packing


def test_stages(spark):
    docs = table(spark, SF001, "documents")
    columns, dtypes = docs.columns, docs.dtypes
    rows = {r.doc_id: r.text for r in docs.collect()}
    ranks = None
    for name, stage in P.STAGES:
        before = docs
        docs = stored(stage(spark, docs, SF001), f"test-{name}")
        if name == "packing":
            break
        assert docs.columns == columns and docs.dtypes == dtypes
        got = {r.doc_id: r.text for r in docs.collect()}
        if name == "quality_rules":
            rows = {i: t for i, t in rows.items() if not any(f(Text(t)) for f in RULES.values())}
        elif name == "exact_dedup":
            keep = {i for i, _ in test_exact_dedup.brute(rows.items()).values()}
            rows = {i: t for i, t in rows.items() if i in keep}
        elif name == "near_duplicates":
            rows = {i: rows[i] for i, (_, c) in test_jaccard_join.brute(rows.items(), 5, 80).items() if i == c}
        else:
            ranks, patterns = secrets.word_ranks(before), secrets.compiled()
            for i, t in rows.items():
                base, added = secrets.scan(t, ranks, patterns)
                for _, s, e in sorted(base + added, key=lambda x: -x[1]):
                    if not any(s2 < e and s < e2 and (s2, e2) != (s, e) and s2 <= s for _, s2, e2 in base + added):
                        t = t[:s] + "[SECRET]" + t[e:]
                rows[i] = t
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        assert got == rows, name
    packed = docs.collect()
    test_packing.check(packed, 2048)
    lengths = {}
    for r in packed:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == {i: len(test_packing.ids_of(t)) + 1 for i, t in rows.items()}


def test_run_and_odd_rows(spark, documents, clashing, tmp_path):
    assert P.run(spark, SF001).columns[:1] == ["doc_id"]
    for docs in (documents, clashing, documents.limit(0)):
        for name, stage in P.STAGES:
            docs = stored(stage(spark, docs, SF001), f"odd-{name}")


def test_near_duplicates_of_repeated_ids(spark):
    words = [f"w{i}" for i in range(200)]
    x, y = " ".join(words), " ".join(f"v{i}" for i in range(200))
    rows = [(7, x + " end"), (7, y), (3, x), (None, x + " tail"), (9, y + " z"), (9, y + " q"), (None, x + " tail")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for frame in (docs, stored(docs.repartition(3), "test-near")):
        got = sorted((r.doc_id or 0, r.text) for r in P.near_duplicates(spark, frame, SF001).collect())
        assert got == sorted([(0, x + " tail"), (0, x + " tail"), (3, x), (7, y)])
