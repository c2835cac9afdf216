"""Fingerprints bit by bit, links against all pairs."""
import random

import pytest
import xxhash

from finmesh.llm import simhash as S
from finmesh.llm.common import ASCII_LOWER, table
from tests.conftest import SF001


def slow_print(text):
    words = (text or "").encode().translate(ASCII_LOWER).split()
    if not words:
        return 0
    k = min(3, len(words))
    h = [xxhash.xxh64(b" ".join(words[i:i + k]), seed=42).intdigest() for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, distance=2):
    """rows (id, print) -> the least id reachable of each print."""
    prints = sorted({p for _, p in rows})
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, x in enumerate(prints):
        for y in prints[i + 1:]:
            if (x ^ y).bit_count() <= distance:
                parent[root(x)] = root(y)
    least = {}
    for key, p in rows:
        if key is not None:
            least[root(p)] = min(key, least.get(root(p), key))
    return {p: least.get(root(p)) for p in prints}


def test_hash_is_sparks(spark):
    """Spark's xxhash64 is the same function."""
    text = "naïve ΑΣ 日本語"
    row = spark.createDataFrame([(text,)], "t string").selectExpr("xxhash64(t) AS h").first()
    assert row.h % (1 << 64) == xxhash.xxh64(text.encode(), seed=42).intdigest()


def check(got, rows):
    want = brute(rows)
    assert sorted((r.doc_id is None, r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted(
        (k is None, k, f"{p:016x}", want[p]) for k, p in rows) if all(k is not None for k, _ in rows) else {
        (r.doc_id, r.fingerprint, r.component_id) for r in got} == {(k, f"{p:016x}", want[p]) for k, p in rows}
    assert len(got) == len(rows)


def test_documents(documents):
    rows = [(r.doc_id, slow_print(r.text)) for r in documents.collect()]
    check(S.components(documents).collect(), rows)


def test_query(spark):
    import __spark_entry__ as E
    rows = [(r.doc_id, slow_print(r.text)) for r in table(spark, SF001, "documents").select("doc_id", "text").collect()]
    got = E.queries()["op12_simhash"](spark, SF001)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    check(got.collect(), rows)


def groups(seed, count=6, members=60):
    """Prints around a few centres, with up to five bits turned, in all places."""
    rng, out = random.Random(seed), set()
    for _ in range(count):
        centre = rng.getrandbits(64)
        where = rng.choice([range(64), range(32), range(32, 64), range(4)])
        for _ in range(members):
            x = centre
            for b in rng.sample(list(where), min(len(where), rng.randrange(0, 6))):
                x ^= 1 << b
            out.add(x)
    return out | {0, (1 << 64) - 1, 1 << 63, 3 << 62, 1}


@pytest.mark.parametrize("distance, segments, matches", [(2, 2, 64), (2, 2, 0), (2, 2, 10 ** 9), (3, 2, 64), (3, 2, 0), (3, 4, 20), (1, 1, 64), (4, 2, 64), (0, 1, 64), (2, 3, 64)])
def test_links(spark, distance, segments, matches):
    """Components by tables, by balls and by both are those of all pairs."""
    from finmesh.llm.components import connected
    prints = groups(distance * 10 + segments)
    signed = {p - (1 << 64) if p >> 63 else p: p for p in prints}
    df = spark.createDataFrame([(p,) for p in signed], "print long").repartition(3)
    links = S.links(df, distance, segments, matches)
    assert all((signed[r.a] ^ signed[r.b]).bit_count() <= distance for r in links.collect())
    comp = {r.v: r.c for r in connected(links).collect()}
    got, want = {}, brute([(k, p) for k, p in enumerate(prints)], distance)
    for s, p in signed.items():
        got.setdefault(comp.get(s, s), set()).add(p)
    parts = {}
    for p, k in want.items():
        parts.setdefault(k, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, parts.values()))


def test_a_large_group_lists_no_pairs(spark):
    """Two thousand prints that share a half: the links stay linear."""
    rng = random.Random(4)
    prints = [(p,) for p in {rng.getrandbits(11) for _ in range(1500)}]
    assert S.links(spark.createDataFrame(prints, "print long")).count() < 70 * len(prints)


def test_empty_table_and_clashing_columns(documents, spark):
    assert S.components(documents.limit(0)).collect() == []
    rows = [(1, "same text of words", 7, "x", 1), (2, "SAME text of words", 8, None, 2), (None, "same Text of words", 0, "", 3), (3, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, print long, fingerprint string, component_id long")
    assert sorted((str(r.doc_id), r.component_id) for r in S.components(df).collect()) == [("1", 1), ("2", 1), ("3", 3), ("None", 1)]
