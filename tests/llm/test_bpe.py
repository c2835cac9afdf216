"""Byte-level BPE against the tiktoken library."""
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from finmesh.llm import bpe

RANKS = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def encoded(df):
    ids = bpe.encode(df, RANKS, public_tokenizers.PATTERN)
    return ids.select("doc_id", "ids", "ids_sha256", bpe.decode(F.col("ids"), RANKS).alias("bytes")).collect()


def test_ids_and_round_trip(documents):
    want = sorted((r.doc_id or 0, r.text or "") for r in documents.collect())
    got = sorted(((r.doc_id or 0, bytes(r["bytes"]).decode(), r.ids, r.ids_sha256) for r in encoded(documents)), key=lambda r: r[:2])
    assert [(r[0], r[1]) for r in got] == want
    for _, text, ids, sha in got:
        assert ids == LIBRARY.encode_ordinary(text)
        assert sha == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_few_frequent_words(documents):
    """Words beyond the broadcast dictionary are folded where they are used."""
    for frequent in (0, 300):
        ids = bpe.encode(documents, RANKS, public_tokenizers.PATTERN, frequent=frequent).select("ids", bpe.decode(F.col("ids"), RANKS).alias("bytes"))
        assert all(r.ids == LIBRARY.encode_ordinary(bytes(r["bytes"]).decode()) for r in ids.collect())


def test_dictionary_starts_anew(documents, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_WORDS", 50)
    assert all(r.ids == LIBRARY.encode_ordinary(bytes(r["bytes"]).decode()) for r in encoded(documents.limit(60)))


def test_empty_table_and_clashing_columns(documents, clashing):
    assert encoded(documents.limit(0)) == []
    assert len(encoded(clashing)) == 3


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcdefst \n'éß日", max_size=60))
def test_long_words_merge_as_the_library(text):
    for word in LIBRARY._core_bpe and [w for w in text.split(" ") if w]:
        ids = LIBRARY._encode_single_piece(word)
        assert bpe.merge_long(word.encode(), RANKS) == ids


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=255, categories=None, exclude_categories=["Cs"]) | st.sampled_from(" '\n\tstremvldA1"), max_size=16))
def test_latin_1_texts_split_alike(text):
    import regex
    assert bpe.PUBLIC == public_tokenizers.PATTERN
    assert bpe.splitter(bpe.PUBLIC)(text) == regex.findall(public_tokenizers.PATTERN, text)


def test_rank_table_knows_its_pairs_only():
    pairs = {1 << 16 | 2: 5, 2 << 16 | 1: 6, 7 << 16 | 7: 9, 300 << 16 | 50_000: 11} | {i << 16 | i + 1: i for i in range(100, 3000)}
    table = bpe.RankTable(pairs)
    look = lambda left, right: int(table.entries[table.displacement[left] + right]) ^ left << 16
    assert all(look(k >> 16, k & 65535) == v for k, v in pairs.items())
    assert all(look(left, right) >= bpe.NONE for left in (0, 1, 2, 7, 300, 65535) for right in range(65536) if left << 16 | right not in pairs)
    with pytest.raises(ValueError):
        bpe.merge_pairs({b"a": 65535})
