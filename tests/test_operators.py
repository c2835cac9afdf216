"""Keys, dedup, page plan and the fan-out report on small inputs vs brute force."""
from pyspark.sql import functions as F

from finmesh.operators.dedup import keep_first, keep_last, last_write_wins
from finmesh.operators.keys import fanout_report, resolve_parent_key, with_surrogate_key
from finmesh.plans import pageplan


def test_surrogate_key_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"), F.col("id").alias("v"))
    got = with_surrogate_key(df, ["k", "v"], "sid", num_partitions=7).toPandas()
    exp = got.sort_values(["k", "v"]).reset_index(drop=True)
    assert list(exp["sid"]) == list(range(1, 5001))


def test_surrogate_key_start_and_empty_partitions(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "k int")
    got = sorted((r.k, r.sid) for r in with_surrogate_key(df, ["k"], "sid", start=10, num_partitions=8).collect())
    assert got == [(1, 10), (2, 11), (3, 12)]


def test_keep_first_last(spark):
    rows = [("a", 2, "x2"), ("a", 1, "x1"), ("b", 5, None), ("b", 6, "y6"), ("a", 3, "x3")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    assert sorted(tuple(r) for r in keep_first(df, ["k"], ["o"]).collect()) == [("a", 1, "x1"), ("b", 5, None)]
    assert sorted(tuple(r) for r in keep_last(df, ["k"], ["o"]).collect()) == [("a", 3, "x3"), ("b", 6, "y6")]
    lw = {r.k: (r.first_seen.o, r.v) for r in last_write_wins(df, ["k"], ["o"], first_seen_as="first_seen").collect()}
    assert lw == {"a": (1, "x3"), "b": (5, "y6")}


def test_hot_key_keep_first(spark):
    # a third of the rows on one key: reduced per task by partial aggregation
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("o"))
    got = keep_first(df, ["k"], ["o"])
    assert got.count() == 20001
    assert got.filter("k = 0").first().o == 0


def test_resolve_and_fanout(spark):
    parents = spark.createDataFrame([("p", "A", 1), ("p", "B", 2), ("p", "A", 3), ("q", "A", 4)],
                                    "project_id string, code string, pid long")
    children = spark.createDataFrame([("p", "A", "s1"), ("p", "A", "s2"), ("q", "A", "s3"), ("r", "A", "s4")],
                                     "project_id string, code string, sector string")
    uniq = resolve_parent_key(children, parents, ["project_id", "code"], "pid")
    assert sorted((r.sector, r.pid) for r in uniq.collect()) == [("s1", 1), ("s2", 1), ("s3", 4), ("s4", None)]
    rep = fanout_report(children, parents.drop("pid"), ["project_id", "code"]).first()
    assert rep.child_rows == 4 and rep.all_mode_rows == 6
    assert rep.children_with_repeated_parent == 2 and rep.repeated_parent_keys == 1


def test_page_plan_and_completeness(spark):
    totals = spark.createDataFrame([(2000, 2500), (2001, 0), (2002, 250_000)], "year int, total long")
    plan = pageplan.page_plan(totals)
    per_year = {r.year: r.n for r in plan.groupBy("year").agg(F.count("*").alias("n")).collect()}
    assert per_year == {2000: 3, 2002: 250}          # every page is planned
    inv = plan.filter(~((F.col("year") == 2000) & (F.col("page_offset") == 1000))).select(
        "year", "page_offset", F.least(F.lit(1000).cast("long"), F.col("total") - F.col("page_offset")).alias("records"))
    c = {r.year: r for r in pageplan.completeness(plan, inv).collect()}
    assert (c[2000].planned_pages, c[2000].landed_pages, c[2000].failed_pages) == (3, 2, 1)
    assert c[2000].landed_records == 1500 and c[2000].pct_done == 60.0
    assert c[2002].records_beyond_cap == 150_000 and c[2002].pct_done == 100.0
    missing = pageplan.missing_pages(plan, inv).collect()
    assert [(r.year, r.page_offset) for r in missing] == [(2000, 1000)]


def test_append_with_keys_continues_after_loaded_max(spark):
    from finmesh.operators.keys import append_with_keys
    loaded = spark.createDataFrame([(10, 1), (20, 2), (30, 7)], "k int, sid long")
    new = spark.createDataFrame([(5,), (40,)], "k int")
    got = sorted((r.k, r.sid) for r in append_with_keys(loaded, new, ["k"], "sid").collect())
    assert got == [(5, 8), (40, 9)]
    empty = spark.createDataFrame([], "k int, sid long")
    got = sorted((r.k, r.sid) for r in append_with_keys(empty, new, ["k"], "sid").collect())
    assert got == [(5, 1), (40, 2)]


def test_per_key_limit_audit(spark):
    from finmesh.operators.audit import per_key_limit_audit
    df = spark.range(0, 120).select((F.col("id") % 2).alias("p"))   # 60 rows per key
    df = df.unionByName(spark.range(0, 3).select(F.lit(7).cast("long").alias("p")))
    got = sorted(tuple(r) for r in per_key_limit_audit(df, "p", 50, "n_documents").collect())
    assert got == [(0, 60), (1, 60)]


def test_list_offsets_match_running_sums(spark, monkeypatch):
    from finmesh.operators import keys
    monkeypatch.setattr(keys, "ROWS_PER_PARTITION", 40)
    rows = [(i * 7919 % 503, i, ["x"] * (i % 4), None if i % 5 == 0 else ["y"] * (i % 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, v long, a array<string>, b array<string>").repartition(5)
    got = keys.with_list_offsets(df, ["k", "v"], ["a", "b"]).collect()
    a = b = 0
    for r in sorted(got, key=lambda r: (r.k, r.v)):
        assert (r.a_before, r.b_before) == (a, b)
        a, b = a + len(r.a), b + len(r.b or [])
    assert len(got) == 300


def test_list_offsets_by_page_match_running_sums(spark):
    """Pages out of order, some with null columns, and a list that is null."""
    from finmesh.operators import keys
    rows = [(i * 7 % 3, None if i % 2 else 2000 + i % 5, i * 7919 % 503, i, ["x"] * (i % 4), None if i % 5 == 0 else ["y"] * (i % 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "seq long, year int, pos long, v long, a array<string>, b array<string>").repartition(5)
    got = keys.with_list_offsets_by_page(df, ["seq", "year"], ["pos", "v"], ["a", "b"])
    assert got.columns == [*df.columns, "a_before", "b_before"]
    a = b = 0
    for r in sorted(got.collect(), key=lambda r: (r.seq, r.year is not None, r.year, r.pos, r.v)):
        assert (r.a_before, r.b_before) == (a, b)
        a, b = a + len(r.a), b + len(r.b or [])
    assert a == sum(len(r[4]) for r in rows) and b == sum(len(r[5] or []) for r in rows)


def test_surrogate_key_evaluates_its_input_once(spark):
    """Rows that a task makes are counted where they are made; the partition count is bounded."""
    from finmesh.operators import keys
    seen = spark.sparkContext.accumulator(0)

    def each(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    df = spark.range(1000).mapInArrow(each, "id long")
    out = keys.with_surrogate_key(df, [F.desc("id")], "k").collect()
    assert sorted((r.k, r.id) for r in out) == [(i + 1, 999 - i) for i in range(1000)]
    assert seen.value == 1000
    assert keys.partitions_for(0) == 1 and keys.partitions_for(10 ** 12) == keys.MAX_PARTITIONS


def test_item_numbers_follow_rows_and_positions(spark, monkeypatch):
    from finmesh.operators import keys
    monkeypatch.setattr(keys, "ROWS_PER_PARTITION", 40)
    rows = [(i * 7919 % 503, i, None if i % 5 == 0 else [f"{i}.{j}" for j in range(i % 4)]) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, v long, a array<string>").repartition(5)
    got = keys.with_item_numbers(df, ["k", "v"], "a", "n", "item", ["v"]).collect()
    expected = [(v, x) for _, v, a in sorted(rows, key=lambda r: r[:2]) for x in a or []]
    assert [(r.v, r.item) for r in sorted(got, key=lambda r: r.n)] == expected
    assert sorted(r.n for r in got) == list(range(1, len(expected) + 1))


def test_totals_before(spark, monkeypatch):
    from finmesh.operators import keys
    monkeypatch.setattr(keys, "ROWS_PER_PARTITION", 10)
    df = spark.createDataFrame([(i * 37 % 101, i % 4) for i in range(100)], "k long, n long").repartition(4)
    out, total = keys.with_totals_before(df, ["k"], ["n"])
    before = 0
    for r in sorted(out.collect(), key=lambda r: r.k):
        assert r.n_before == before
        before += r.n
    assert before == total == sum(i % 4 for i in range(100))
    empty, none = keys.with_totals_before(df.limit(0), ["k"], ["n"])
    assert (empty.count(), none) == (0, 0)


def test_blocks_hold_whole_pages(spark):
    """A block begins where a key's rows begin a page; keys with many rows and gaps between keys move none of that."""
    from finmesh.operators import keys
    counts = {k * k - 50: [1, 2, 3, 40][k % 4] for k in range(200)}
    df = spark.createDataFrame(list(counts.items()), "k long, n long").repartition(4)
    totals, _ = keys.with_totals_before(df, ["k"], ["n"])
    blocks = keys.blocks_of(totals, "k", "n_before", 10, 100)
    got = totals.select("k", "n_before", blocks.of(F.col("k")).alias("block"), blocks.before(blocks.of(F.col("k"))).alias("first")).collect()
    rows = sorted((r.n_before, r.k, r.block, r["first"]) for r in got)
    assert [r[2] for r in rows] == sorted(r[2] for r in rows) and {r[2] for r in rows} == set(range(len(blocks))) and len(blocks) > 5
    for block in range(len(blocks)):
        first = next(r for r in rows if r[2] == block)
        assert first[0] == first[3] and first[0] % 10 == 0
    one = keys.blocks_of(totals.limit(0), "k", "n_before", 10, 100)
    assert len(one) == 1 and spark.range(1).select(one.of(F.col("id"))).first()[0] == 0


def test_stored_frames_leave_no_shuffle_files(spark):
    from finmesh.operators import keys
    bus = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {n for n in bus.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in n and n.endswith(".data")}
    before = shuffles()
    stored = keys._stored(spark.range(1000).repartition(3, "id").groupBy("id").count(), "freed")
    assert not shuffles() - before
    assert stored.count() == 1000
