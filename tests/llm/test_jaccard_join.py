"""Parity-sketch join against all pairs."""
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from finmesh.llm import jaccard_join as J
from finmesh.llm.common import ASCII_LOWER
from finmesh.llm.components import connected


def shingles(text, width):
    words = (text or "").encode().translate(ASCII_LOWER).split()
    k = min(width, len(words))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set()


def brute(rows, width, percent):
    sets, holds = {}, defaultdict(list)
    for i, t in rows:
        sets[i] = shingles(t, width)
        for s in sets[i]:
            holds[s].append(i)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, own in sets.items():
        if i is None:
            continue
        for j, n in Counter(j for s in own for j in holds[s] if j is not None and j > i).items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def found(df, width, percent):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in J.components(df, width, percent).collect()}


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_documents(documents, width, percent):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want, got = brute(rows, width, percent), found(documents, width, percent)
    assert got == want


def near_copies(seed, groups=3, per_group=40, words=120):
    """Groups around a base text with a few words changed: chains and stars, with pairs on either side of the threshold."""
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(rng.choice([4, 12, words]))]
        for c in range(per_group):
            text = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 25))):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10 ** 6)}"
            rows.append((g * 1000 + c, " ".join(text[:len(text) - rng.randrange(0, 2)])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, width, percent, rounds", [(1, 3, 90, 4), (2, 5, 80, 0), (3, 3, 80, 4), (4, 3, 80, 0)])
def test_near_copies(spark, seed, width, percent, rounds, monkeypatch):
    """Keys meet across tasks; without rounds all pairs left are listed at once."""
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(J, "MAX_ROUNDS", rounds)
    assert found(df, width, percent) == brute(rows, width, percent)


def test_shared_passages(spark):
    """Documents that share little but a passage do not link; a common passage inside copies does no harm."""
    rng, passage, rows = random.Random(6), " ".join(f"p{i}" for i in range(60)), []
    for i in range(300):
        own = [f"{i // 3}w{k}" for k in range(80)]
        own[rng.randrange(80)] = f"x{i}"
        rows.append((i, " ".join(own) + " " + passage))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(df, 3, 90) == brute(rows, 3, 90)


def test_sparse_edits_in_a_large_group(spark):
    """Copies of one base with up to eight changes each: those with many changes drop out by themselves."""
    rng, base = random.Random(9), [f"w{i}" for i in range(150)]
    rows = []
    for i in range(400):
        text = list(base)
        for _ in range(rng.randrange(0, 9)):
            text[rng.randrange(150)] = f"x{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(df, 3, 90) == brute(rows, 3, 90)


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_key(percent):
    """No link is lost: sets at the threshold share a key, whatever their sizes."""
    rng, bands = np.random.default_rng(5), J.Bands(percent)
    for size in [1, 2, 5, 8, 9, 10, 17, 33, 60, 150, 700]:
        for _ in range(40):
            pool = rng.integers(0, 1 << 63, 3 * size + 4, dtype=np.uint64)
            keep = size
            while True:                                   # the smallest intersection that still links
                other = (100 * keep - percent * size) // percent
                if other < 0 or 100 * (keep - 1) < percent * (size + 0):
                    break
                keep -= 1
            extra = int(100 * keep / percent) - size
            a = np.unique(pool[:size])
            b = np.unique(np.concatenate([a[:keep], pool[size:size + max(0, extra)]]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= percent * (len(a) + len(b) - both) and len(b):
                for share in (0, 0.3, 0.9, 1):
                    common = np.sort(rng.permutation(np.union1d(a, b))[:int(share * len(a))])
                    whole = [J.sketch_keys(x, bands, common).view(np.uint64) for x in (a, b)]
                    assert len(np.intersect1d(*whole))
                    # whichever keys come last, the prefixes still meet
                    for part in (0.2, 0.7, 1):
                        every = np.union1d(*[all_keys(x, bands, common) for x in (a, b)])
                        frequent = np.sort(rng.permutation(every)[:int(part * len(every))])
                        prefix = [J.sketch_keys(x, bands, common, frequent) for x in (a, b)]
                        assert len(np.intersect1d(*prefix))
                        assert all(len(x) <= sum(3 * (bands.prepare(s)[1] + 1) for s in bands.schemes(len(y))) for x, y in zip(prefix, (a, b)))


def all_keys(hashes, bands, common):
    rare = hashes[~np.isin(hashes, common)]
    return np.concatenate([J._chunk_keys(part, bands.prepare(s)[0], s + extra)[1] for s in bands.schemes(len(hashes)) for part, extra in ((rare, 0), (hashes, 100))])


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 200 + i) for i in range(300)] + [(7, 7)]
    got = {r.v: r.c for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {100: 100} | {200 + i: 100 for i in range(300)}


def test_empty_table_and_clashing_columns(documents, clashing):
    assert found(documents.limit(0), 3, 90) == {}
    assert found(clashing, 3, 90) == {1: (1, 1), 2: (1, 1), 3: (0, 3)}


def test_packed_keys_come_back():
    rng = np.random.default_rng(8)
    for n in (1, 2, 3000):
        for shift in (J.KEY_BITS - 4, J.KEY_BITS - 9):
            keys = np.sort(rng.integers(0, 1 << J.KEY_BITS, n, dtype=np.uint64))
            keys[-1] = (1 << J.KEY_BITS) - 1
            ids = rng.integers(-(1 << 63), (1 << 63) - 1, n, dtype=np.int64)
            ids[0] = -(1 << 63)
            small = rng.integers(5, 9, n, dtype=np.int64)
            parts = list(J._packed(keys, [ids, small], shift))
            back = [J._unpacked(place, bases, count, planes, shift) for place, bases, count, planes in parts]
            assert [p for p, *_ in parts] == sorted({int(k) >> shift for k in keys})
            for want, got in zip((keys, ids, small), map(np.concatenate, zip(*back))):
                assert np.array_equal(want, got)
    assert list(J._packed(np.empty(0, np.uint64), [np.empty(0, np.int64)], 40)) == []


@pytest.mark.parametrize("slice_rows, block", [(64, 500), (1 << 20, 1 << 20)])
def test_many_slices_and_blocks(spark, slice_rows, block, monkeypatch):
    """Neither the number of slices nor where blocks end changes the result."""
    rows = near_copies(12, groups=4, per_group=25)
    monkeypatch.setattr(J, "SLICE", slice_rows)
    monkeypatch.setattr(J, "BLOCK", block)
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), 5, 80) == brute(rows, 5, 80)


def test_an_id_with_a_long_and_a_short_text(spark):
    """An id that repeats is one node: its short text still links, whatever the size of its long one."""
    rng, passage = random.Random(4), [f"p{i}" for i in range(40)]
    rows = [(1, " ".join(passage)), (1, " ".join(f"l{i}" for i in range(900)))]
    for i in range(2, 40):
        text = list(passage)
        for _ in range(rng.randrange(1, 4)):
            text[rng.randrange(40)] = f"x{i}y{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(text)))
    parent = {i: i for i, _ in rows}
    sets = [(i, shingles(t, 3)) for i, t in rows]
    for _ in range(len(rows)):
        for i, x in sets:
            for j, y in sets:
                if 100 * len(x & y) >= 80 * len(x | y):
                    parent[i] = parent[j] = min(parent[i], parent[j])
    got = {(r.doc_id, r.component_id) for r in J.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 3, 80).collect()}
    assert got == set(parent.items())


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    """Documents that pass the bitmap by collision, empty ones included, get no link from that."""
    rows = near_copies(21, groups=2, per_group=20) + [(9001, ""), (9002, None), (9003, " "), (9004, "one two"), (9005, "three")]
    monkeypatch.setattr(J, "_bitmap", lambda ids: ids.sparkSession.sparkContext.broadcast(b"\xff" * (1 << J.FILTER_BITS - 3)))
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), 5, 80) == brute(rows, 5, 80)


def test_what_a_task_holds_in_memory():
    """Word hashes start anew, the frequent among them come back at once; hashes do not depend on what is remembered."""
    memo = J._Hashes()
    first = memo[b"word 1"]
    for i in range(200_000):
        memo[b"word %d" % i]
    assert len(memo) <= 1 << 17 and memo[b"word 1"] == first
    assert J.BLOCK <= 1 << 19
