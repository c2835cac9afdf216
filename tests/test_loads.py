"""Loads that fail, repeat or replace (S6, S10, S12), keyed merge (A7, U1), collated audits (K2, K3), mergeable profile."""
import json
import random

import pytest
from pyspark.sql import functions as F

from finmesh.operators import audit, merge
from finmesh.plans import normalize
from finmesh.sources import commit, sinks
from finmesh.sources import pages as P
from tests.payloads import DOC_PAGE_2020_0, DOC_PAGE_2020_1, DOC_PAGE_2021_0


class Broken(Exception):
    pass


def failing(spark, n=5):
    """A frame whose tasks fail."""
    return spark.range(n).select(F.when(F.col("id") >= 0, F.raise_error(F.lit("stopped"))).cast("long").alias("id"))


def ids(spark, base, name):
    return sorted(r.id for r in sinks.read_back(spark, base, name).collect())


# ------------------------------------------------------------------ S10
def test_a_refresh_that_fails_between_two_tables_changes_nothing(spark, tmp_path):
    base = str(tmp_path / "db")
    sinks.full_refresh({"country": spark.range(3), "projects": spark.range(4)}, base)
    with pytest.raises(Exception, match="stopped"):
        sinks.full_refresh({"country": spark.range(10, 12), "projects": failing(spark)}, base)
    assert ids(spark, base, "country") == [0, 1, 2] and ids(spark, base, "projects") == [0, 1, 2, 3]
    sinks.full_refresh({"country": spark.range(10, 12), "projects": spark.range(1)}, base)
    assert ids(spark, base, "country") == [10, 11] and ids(spark, base, "projects") == [0]


def test_a_refresh_that_fails_before_the_pointer_changes_nothing(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "db")
    sinks.full_refresh({"t": spark.range(3)}, base)
    real = commit.commit_json

    def stop(spark, path, content, replace):
        if path.endswith(sinks.POINTER):
            raise Broken
        real(spark, path, content, replace)
    monkeypatch.setattr(commit, "commit_json", stop)
    with pytest.raises(Broken):
        sinks.full_refresh({"t": spark.range(9)}, base)
    assert ids(spark, base, "t") == [0, 1, 2]


def test_a_reader_that_has_begun_keeps_its_version(spark, tmp_path):
    base = str(tmp_path / "db")
    sinks.full_refresh({"t": spark.range(3)}, base)
    begun = sinks.read_back(spark, base, "t")
    sinks.full_refresh({"t": spark.range(7)}, base)
    assert begun.count() == 3 and len(ids(spark, base, "t")) == 7


def test_tables_that_are_not_refreshed_stay(spark, tmp_path):
    base = str(tmp_path / "db")
    sinks.append_load({"a": spark.range(2), "b": spark.range(3)}, base, "one")
    sinks.append_load({"a": spark.range(2, 4)}, base, "two")
    sinks.full_refresh({"b": spark.range(1)}, base)
    assert ids(spark, base, "a") == [0, 1, 2, 3] and ids(spark, base, "b") == [0]
    assert sinks.remove_replaced(spark, base) == 1
    assert ids(spark, base, "a") == [0, 1, 2, 3] and ids(spark, base, "b") == [0]
    assert {(r.table_name, r.row_count) for r in sinks.load_ledger(spark, base).collect()} == {("a", 4), ("b", 1)}


# ------------------------------------------------------------------ S6, S12
def test_a_batch_that_runs_twice_counts_once(spark, tmp_path):
    base = str(tmp_path / "db")
    assert sinks.append_load({"country": spark.range(3), "projects": spark.range(5)}, base, "2020/05")
    assert not sinks.append_load({"country": spark.range(3), "projects": spark.range(5)}, base, "2020/05")
    assert sinks.append_load({"country": spark.range(3, 4)}, base, "2020/06")
    assert ids(spark, base, "country") == [0, 1, 2, 3] and len(ids(spark, base, "projects")) == 5
    assert {tuple(r) for r in sinks.load_ledger(spark, base).collect()} == {
        ("2020/05", "country", 3), ("2020/05", "projects", 5), ("2020/06", "country", 1)}


def test_a_batch_that_fails_leaves_no_rows_and_may_be_repeated(spark, tmp_path):
    base = str(tmp_path / "db")
    sinks.append_load({"country": spark.range(3)}, base, "one")
    with pytest.raises(Exception, match="stopped"):
        sinks.append_load({"country": spark.range(10, 20), "projects": failing(spark)}, base, "two")
    assert ids(spark, base, "country") == [0, 1, 2]
    assert sinks.append_load({"country": spark.range(10, 12), "projects": spark.range(2)}, base, "two")
    assert ids(spark, base, "country") == [0, 1, 2, 10, 11] and ids(spark, base, "projects") == [0, 1]
    assert sinks.remove_replaced(spark, base) == 2                    # what the failed run left, written or begun


def test_of_two_runs_of_one_batch_one_wins(spark, tmp_path, monkeypatch):
    """Both begin before either has committed."""
    base = str(tmp_path / "db")
    sinks.append_load({"t": spark.range(1)}, base, "zero")
    real = commit.exists
    monkeypatch.setattr(commit, "exists", lambda s, p: False if p.endswith("one.json") else real(s, p))
    sinks.append_load({"t": spark.range(1, 3)}, base, "one")
    with pytest.raises(Exception, match="exists"):
        sinks.append_load({"t": spark.range(1, 3)}, base, "one")
    monkeypatch.undo()
    assert ids(spark, base, "t") == [0, 1, 2]


def test_empty_tables_and_batches(spark, tmp_path):
    base = str(tmp_path / "db")
    assert not sinks.append_load({}, base, "none")
    sinks.append_load({"t": spark.range(0)}, base, "empty")
    assert ids(spark, base, "t") == []
    assert [tuple(r) for r in sinks.load_ledger(spark, base).collect()] == [("empty", "t", 0)]


def test_a_rerun_of_the_whole_build_adds_nothing(spark, tmp_path):
    from tests.payloads import write_pages
    base, pages = str(tmp_path / "db"), P.read_pages(spark, write_pages(str(tmp_path / "pages.jsonl")))
    first = {k: v.count() for k, v in normalize.store_all(P.project_records(pages), P.document_records(pages), base).items()}
    again = {k: v.count() for k, v in normalize.store_all(P.project_records(pages), P.document_records(pages), base).items()}
    assert first == again
    assert {r.table_name: r.row_count for r in sinks.load_ledger(spark, base).collect()} == first


# ------------------------------------------------------------------ A7, U1
def plain(rows):
    """key -> (newest at, value of it, first at)."""
    out = {}
    for key, at, value in rows:
        old = out.get(key, (-1, None, 10 ** 9))
        out[key] = (max(at, old[0]), value if at > old[0] else old[1], min(at, old[2]))
    return out


def test_merge_equals_a_rebuild(spark, tmp_path):
    rng, path, rows = random.Random(2), str(tmp_path / "m"), []
    times = list(range(400))
    rng.shuffle(times)
    for landing in range(4):
        new = [(rng.choice(["hot", None, f"k{rng.randrange(60)}"]), times[landing * 100 + i], f"v{landing}-{i}") for i in range(100)]
        rows += new
        df = spark.createDataFrame(new, "k string, at long, v string").repartition(3)
        merge.merge_by_key(df, path, ["k"], ["at"], buckets=8)
        got = {r.k: (r.newest["at"], r.v, r.first_seen["at"]) for r in merge.read_merged(spark, path).collect()}
        assert got == plain(rows)
    before = merge.read_merged(spark, path).count()
    assert merge.remove_replaced(spark, path) > 0
    assert merge.read_merged(spark, path).count() == before


def test_untouched_buckets_are_not_written(spark, tmp_path):
    path = str(tmp_path / "m")
    merge.merge_by_key(spark.range(1000).select("id", F.lit(1).alias("at"), F.lit("a").alias("v")), path, ["id"], ["at"], buckets=32)
    before = commit.read_json(spark, f"{path}/_current")["folders"]
    assert merge.merge_by_key(spark.range(5, 6).select("id", F.lit(2).alias("at"), F.lit("b").alias("v")), path, ["id"], ["at"]) == 1
    after = commit.read_json(spark, f"{path}/_current")["folders"]
    assert len(before) == 32 and sum(before[b] != after[b] for b in after) == 1
    assert merge.read_merged(spark, path).where("v = 'b'").count() == 1 and merge.read_merged(spark, path).count() == 1000


def test_a_merge_that_fails_or_repeats_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    rows = spark.range(50).select("id", F.lit(1).alias("at"), F.lit("a").alias("v"))
    merge.merge_by_key(rows, path, ["id"], ["at"], buckets=4)
    new = spark.range(20).select("id", F.lit(2).alias("at"), F.lit("b").alias("v"))

    def stop(*_, **__):
        raise Broken
    with monkeypatch.context() as m:
        m.setattr(commit, "commit_json", stop)
        with pytest.raises(Broken):
            merge.merge_by_key(new, path, ["id"], ["at"])
    assert merge.read_merged(spark, path).where("v = 'b'").count() == 0
    for _ in range(2):
        merge.merge_by_key(new, path, ["id"], ["at"])
        assert merge.read_merged(spark, path).count() == 50 and merge.read_merged(spark, path).where("v = 'b'").count() == 20
    merge.merge_by_key(new.limit(0), path, ["id"], ["at"])
    assert merge.read_merged(spark, path).count() == 50


def test_merged_documents_equal_a_rebuild(spark, tmp_path):
    bodies = [(2020, 1000, DOC_PAGE_2020_1), (2021, 0, DOC_PAGE_2021_0), (2020, 0, DOC_PAGE_2020_0)]
    path, files = str(tmp_path / "m"), []
    for i, (year, offset, body) in enumerate(bodies):
        files.append(tmp_path / f"{i}.jsonl")
        files[-1].write_text(json.dumps({"source": "documents", "seq": i, "year": year, "offset": offset, "body": body}) + "\n")
        normalize.merge_documents(P.document_records(P.read_pages(spark, str(files[-1]))), path)
        rebuilt = normalize.kept_documents(P.document_records(P.read_pages(spark, [str(f) for f in files])))
        key = lambda r: r.record_key
        assert sorted(normalize.merged_documents(spark, path).collect(), key=key) == sorted(rebuilt.collect(), key=key)


# ------------------------------------------------------------------ K2, K3 under a collation
def test_names_that_differ_by_case(spark):
    df = spark.createDataFrame([("Other Industry", 1), ("Other industry", 1), ("Power", 1), ("Power", 2), (None, 1), ("Énergie", 1), ("énergie", 1), ("Water", 3)],
                               "name string, n1 int")
    assert {(r.name, r.n, r.n_spellings) for r in audit.pk_audit(df, ["name"], "UTF8_LCASE").collect()} == {
        ("Other Industry", 2, 2), ("Power", 2, 1), (None, 1, 1), ("Énergie", 2, 2)}
    # several columns, one of them a number: Power 1 and Power 2 are two keys
    assert {r.name for r in audit.pk_audit(df, ["name", "n1"], "UTF8_LCASE").collect()} == {"Other Industry", None, "Énergie"}
    accents = spark.createDataFrame([("Energie",), ("énergie",)], "name string")
    assert audit.pk_audit(accents, ["name"], "UTF8_LCASE").count() == 0
    assert audit.pk_audit(accents, ["name"], "UNICODE_CI_AI").count() == 1


def test_references_that_differ_by_case(spark):
    child = spark.createDataFrame([(1, "power"), (2, "POWER"), (3, "Roads"), (4, None)], "k int, name string")
    parent = spark.createDataFrame([("Power",), ("power",), ("Water",), (None,)], "title string")
    assert sorted(r.k for r in audit.fk_audit(child, parent, ["name"], ["title"]).collect()) == [2, 3]
    assert sorted(r.k for r in audit.fk_audit(child, parent, ["name"], ["title"], "UTF8_LCASE").collect()) == [3]


# ------------------------------------------------------------------ A9
def test_profile_of_batches_without_their_rows(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(20_000).select("id", (F.col("id") % 700).cast("string").alias("s"), F.when(F.col("id") % 4 == 0, F.col("id").cast("double")).alias("d"),
                                    F.lit(None).cast("date").alias("empty"))
    for batch in (0, 1, 1):                                            # the second batch is loaded twice
        audit.append_profile(df.where(F.col("id") % 2 == batch), path, f"b{batch}")
    got = {r.column_name: r for r in audit.stored_profile(spark, path, df.dtypes).collect()}
    want = {r.column_name: r for r in audit.column_profile(df, exact=True).collect()}
    assert set(got) == set(want)
    for c, w in want.items():
        g = got[c]
        assert (g.data_type, g.row_count, g.null_count, g.min_value, g.max_value) == (w.data_type, w.row_count, w.null_count, w.min_value, w.max_value)
        assert abs(g.distinct_count - w.distinct_count) <= 0.05 * w.distinct_count
