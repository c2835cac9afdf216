"""Spelling variants against all pairs of words."""
import random
import zlib
from collections import Counter

import pytest

from finmesh.llm import spelling as S
from finmesh.llm.common import LOWER, UPPER, table
from tests.conftest import SF001

LOWERED = str.maketrans(UPPER, LOWER)


def is_letter(c):
    return "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ"


def runs_of(text):
    out, own = [], ""
    for c in (text or "") + " ":
        if is_letter(c):
            own += c
        elif own:
            out.append(own.translate(LOWERED))
            own = ""
    return out


def brute_words(rows):
    counts = Counter()
    for key, text in rows:
        for run in runs_of(text):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            at = h % len(run)
            counts[run if h % 97 else run[:at] + run[at + 1:]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def is_near(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    return len(y) == len(x) + 1 and any(y[:k] + y[k + 1:] == x for k in range(len(y)))


def brute(words):
    out, by_size = {}, {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    for w, n in words.items():
        near = [v for size in (len(w) - 1, len(w), len(w) + 1) for v in by_size.get(size, []) if is_near(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form = best if best and words[best] >= 2 * n else None
        out[w] = [form, None, n, len(near), words[form] if form else None]
    for w, row in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        row[1] = root
    return {w: tuple(r) for w, r in out.items()}


def found(vocab, limit=S.LIMIT):
    rows = S.variants(vocab, limit).select("word", "form", "root", "n", "n_near", "form_n").collect()
    out = {r[0]: tuple(r[1:]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_documents(documents):
    """Odd rows too: null ids and texts, long words, letters beyond ASCII, repeated rows."""
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    words = brute_words(rows)
    vocab = S.vocabulary(documents, rewrite=S.misspelt)
    assert {r.word: r.n for r in vocab.collect()} == words
    assert found(vocab) == brute(words)


def test_query(spark):
    import __spark_entry__ as E
    rows = [(r.doc_id, r.text) for r in table(spark, SF001, "documents").select("doc_id", "text").collect()]
    got = E.queries()["op11_spelling_variants"](spark, SF001)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == brute(brute_words(rows))


@pytest.mark.parametrize("seed, alphabet, limit", [(1, "ab", 2), (2, "abc", 5), (3, "abéñ", 40), (4, "ab", 2048)])
def test_dense_words(spark, seed, alphabet, limit):
    """Few letters, so that near all words are near many; holes are halved to the last position."""
    rng = random.Random(seed)
    words = {"".join(rng.choice(alphabet) for _ in range(rng.randrange(5, 10))): rng.randrange(3, 400) for _ in range(500)}
    words |= {"a" * k: 3 + k for k in range(5, 40)}
    vocab = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert found(vocab, limit) == brute(words)


def test_lookup_finds_each_pair_in_one_hole():
    rng = random.Random(8)
    for _ in range(300):
        size = rng.randrange(5, 9)
        base = [rng.choice("abc") for _ in range(size)]
        other = list(base)
        at = rng.randrange(size)
        if rng.random() < 0.5:
            other[at] = rng.choice("abc")
        else:
            other.insert(at, rng.choice("abc"))
        x, y = "".join(base), "".join(other)
        if x == y:
            continue
        s, met = min(len(x), len(y)), []
        for lo, hi in ((0, s // 2), (s // 2, s)):
            if x[:lo] == y[:lo] and x[len(x) - (s - hi):] == y[len(y) - (s - hi):]:
                bits = S.lookup([x, y], s, lo, hi)
                assert bits in ([0, 0], [2, 1])
                met += [1] if bits[0] else []
        assert met == [1]


def test_chain_of_forms(spark):
    words = {"abcde": 3, "abcdex": 6, "abcdexy": 12, "abcdexyz": 24, "zbcdexyz": 24, "qqqqq": 3, "qqqqr": 5}
    got = found(spark.createDataFrame(list(words.items()), "word string, n long"))
    assert got == brute(words)
    assert got["abcde"][1] == "abcdexyz" and got["qqqqq"] == (None, "qqqqq", 3, 1, None)


def test_empty_table_and_clashing_columns(documents, spark):
    assert S.vocabulary(documents.limit(0)).collect() == []
    assert found(spark.createDataFrame([], "word string, n long")) == {}
    rows = [(1, "Kleine kleine kleine", "x", 5), (None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string, n long")
    assert [tuple(r) for r in S.vocabulary(df).collect()] == [("kleine", 3)]
