"""Runs against a search of all stretches; extensions against a loop."""
import hashlib
import random
import zlib

import numpy as np
import pytest

from finmesh.llm import periodic as P
from finmesh.llm.common import table
from tests.conftest import SF001


def slow_runs(words, min_length=12):
    """For each period the maximal stretches of equal words; of equal stretches the least period."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(min_length, 2 * q):
                out.setdefault((start, i + q - start), q)
    return sorted(((s, length, q) for (s, length), q in out.items()), key=lambda r: (r[0], r[2]))


def numbers(words):
    ids = {}
    return np.array([ids.setdefault(w, len(ids)) for w in words], np.int32)


def planted(key, words):
    h = 1 if key is None else zlib.crc32(str(key).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def brute(key, text):
    words = planted(key, (text or "").encode().split())
    runs = slow_runs(words) if len(set(words)) > 1 or len(words) < 12 else [(0, len(words), 1)]
    dropped = set()
    for s, length, q in runs:
        dropped.update(range(s + q, s + length))
    best = min(((-length, s, q) for s, length, q in runs), default=None)
    top = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (key, len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("n, letters", [(0, 1), (1, 1), (30, 1), (200, 1), (40, 2), (300, 2), (300, 3), (700, 40), (2500, 2)])
def test_extensions(n, letters):
    rng = np.random.default_rng(n + letters)
    words = rng.integers(0, letters, n).astype(np.int32)
    if n > 100:
        words[n // 2:] = words[:n - n // 2]
    own = P.Extensions(words)
    i, j = rng.integers(0, n + 1, 3000), rng.integers(0, n + 1, 3000)
    i, j = np.minimum(i, j)[i != j], np.maximum(i, j)[i != j]

    def slow(a, b):
        k = 0
        while b + k < n and words[a + k] == words[b + k]:
            k += 1
        return k
    assert own.query(i, j).tolist() == [slow(a, b) for a, b in zip(i.tolist(), j.tolist())]


def test_runs():
    rng = random.Random(3)
    for _ in range(300):
        words = [rng.choice("ab" if rng.random() < 0.3 else "abcdefgh") for _ in range(rng.randrange(0, 90))]
        for _ in range(rng.randrange(0, 3)):
            at, part = rng.randrange(len(words) + 1), [rng.choice("abcd") for _ in range(rng.randrange(1, 9))]
            words[at:at] = part * rng.randrange(2, 8)
        for least in (12, 2, 5):
            assert [tuple(r) for r in P.runs(numbers(words), least).tolist()] == slow_runs(words, least)


def test_long_texts():
    """Beyond the grid that is looked up, over several blocks of it."""
    rng = random.Random(5)
    words = [rng.randrange(50) for _ in range(3000)]
    words[500:500] = words[100:400] * 4
    words[2000:2000] = [7, 8, 9] * 300
    assert [tuple(r) for r in P.runs(numbers(words)).tolist()] == slow_runs(words)
    same = P.runs(np.zeros(60_000, np.int32))
    assert same.tolist() == [[0, 60_000, 1]]


def rows_of(df):
    return {tuple(r) for r in df.collect()}


def test_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = P.digests(P.detect(documents, rewrite=P.repeated_stretch))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert got.count() == len(rows)
    assert rows_of(got) == {brute(k, t) for k, t in rows}


def test_query(spark):
    import __spark_entry__ as E
    rows = table(spark, SF001, "documents").select("doc_id", "text").collect()
    assert rows_of(E.queries()["op13_periodic_runs"](spark, SF001)) == {brute(r.doc_id, r.text) for r in rows}


def test_collapsed_text(spark):
    text = "start " + "one two three " * 5 + "end"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    got = {r.doc_id: ([tuple(x) for x in r.runs], r.collapsed) for r in P.detect(df).collect()}
    assert got == {1: ([(1, 15, 3)], "start one two three end"), 2: ([], ""), 3: ([], "")}


def test_empty_table_and_clashing_columns(documents, spark):
    assert P.detect(documents.limit(0)).collect() == []
    df = spark.createDataFrame([(1, "a b", 1, "x"), (None, "a " * 12, None, None)], "doc_id long, text string, runs long, collapsed string")
    assert {(r.doc_id, r.collapsed, len(r.runs)) for r in P.detect(df).collect()} == {(1, "a b", 0), (None, "a", 1)}
