"""Streaming exact dedup against grouping on the driver."""
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from finmesh.llm import exact_dedup
from finmesh.llm.common import UPPER, LOWER

FOLD = str.maketrans(UPPER, LOWER)


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(FOLD)].append(doc_id)
    return {t: (max((i for i in g if i is not None), default=None), len(g)) for t, g in groups.items()}


@pytest.mark.parametrize("digest", [exact_dedup.digest_of, lambda t: F.unhex(F.substring(F.sha2(t, 256), 1, 2))], ids=["sha256", "one byte"])
def test_groups(documents, digest):
    """With a digest of one byte nearly every hit is a collision: full bytes decide."""
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want, text_of = brute(rows), defaultdict(set)
    for i, t in rows:
        text_of[i].add((t or "").translate(FOLD))
    got = exact_dedup.dedup(documents, digest=digest).collect()
    assert len(got) == len(rows)
    kept = defaultdict(int)
    for r in got:
        text, = text_of[r.doc_id]
        assert (r.keep_id, r.group_size) == want[text]
        kept[text] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}


def test_small_batches_keep_state(spark, documents):
    """A stream of many micro-batches gives the same groups as one."""
    one = {(r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.dedup(documents).collect()}
    many = {(r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.dedup(documents, max_bytes_per_trigger=20_000).collect()}
    assert one == many


def test_drop_duplicates(documents, clashing):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert exact_dedup.drop_duplicates(documents).count() == len(brute(rows))
    out = exact_dedup.drop_duplicates(clashing)
    assert out.columns == clashing.columns
    assert sorted(r.doc_id for r in out.collect()) == [2, 3]


def test_empty_table(documents):
    assert exact_dedup.dedup(documents.limit(0)).collect() == []
    assert exact_dedup.drop_duplicates(documents.limit(0)).collect() == []
