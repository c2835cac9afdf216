"""Pieces against the tokenizers library; packing rules; waste against the lower bound."""
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from finmesh.llm import packing

JSON = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
LIBRARY = Tokenizer.from_str(JSON)
SPECIALS, FOLDS = packing.rules_of(LIBRARY)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def via_parts(text):
    chunks = packing.chunks_of(text, SPECIALS, FOLDS)
    parts = [p for c in chunks for p in packing.parts_of(c)]
    return packing.encode_parts(LIBRARY, parts)[0].tolist() if parts else []


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="abST'.,!_-5² \n\t\x00\x1c\x85\xa0\u2028ß́éΣÇİ日😀ﬁ", max_size=30))
def test_parts_are_tokenized_as_the_whole(text):
    assert via_parts(text) == ids_of(text)


def test_parts_of_chunks():
    """A chunk with white space of any kind is a whole text and stays whole; finding that out takes no pass in Python over its characters."""
    import sys
    for c in filter(str.isspace, map(chr, range(sys.maxunicode + 1))):
        assert all(packing.parts_of(chunk) == (chunk, "") for chunk in (c, f"a{c}b.", f"{c}a.", f"a.{c}"))
    assert [packing.parts_of(c) for c in ("", "a.", "a.).", "...", "<a.", "İ.", "a.b")] == [
        ("", ""), ("a", "."), ("a", ".)."), ("...", ""), ("<a.", ""), ("İ.", ""), ("a.b", "")]
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event.endswith("call") else None)
    packing.parts_of("a" * 500)
    sys.setprofile(None)
    assert len(calls) < 20


PIECES = st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "endoftext", " ", "\n", "x", "It's", "É", "<", ">", "a.", "\x00", "\x1c"])


@settings(max_examples=600, deadline=None)
@given(st.lists(PIECES, max_size=8).map("".join))
def test_strings_of_special_tokens(text):
    """By default the library takes them as the tokens."""
    assert via_parts(text) == ids_of(text)


def test_contract_of_a_special_string():
    assert len(ids_of("x <|endoftext|> y")) == 3 and via_parts("x <|endoftext|> y") == ids_of("x <|endoftext|> y")


def check(rows, size):
    fill = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values(), default=0) <= size
    return len(fill)


def test_documents(documents):
    rows = packing.pack(packing.pieces(documents, JSON)).collect()
    n = check(rows, 2048)
    assert n <= 1.05 * -(-sum(r.length for r in rows) // 2048) + 1
    want = []
    for r in documents.collect():
        ids = np.array([*ids_of(r.text), 0], "<u4")
        want += [(r.doc_id or 0, k, at, len(ids[at:at + 2048]), zlib.crc32(ids[at:at + 2048].tobytes())) for k, at in enumerate(range(0, len(ids), 2048))]
    assert sorted((r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)


def test_many_packers_and_rounds(documents):
    rows = packing.pack(packing.pieces(documents, JSON, size=256), size=256, pieces_per_packer=200).collect()
    assert check(rows, 256) <= 1.1 * -(-sum(r.length for r in rows) // 256) + 1


def test_rule_is_the_sum_of_squares():
    """Every place is the one that a search over all gaps finds."""
    rng, size = np.random.default_rng(2), 30
    lengths = rng.integers(1, size, 300)
    where, offset, fill = packing.sum_of_squares(lengths, size)
    gaps = {}
    for s, at, off in zip(lengths.tolist(), where.tolist(), offset.tolist()):
        def cost(bin_id):
            g = dict(gaps)
            g[bin_id] = g.get(bin_id, size) - s
            counts = np.bincount([x for x in g.values() if 0 < x < size], minlength=size)
            return int((counts ** 2).sum())
        best = min(cost(b) for b in [*(b for b, g in gaps.items() if g >= s), "new"])
        assert cost(at if at in gaps else "new") == best and off == size - gaps.get(at, size)
        gaps[at] = gaps.get(at, size) - s
    assert fill.tolist() == [size - gaps[i] for i in range(len(fill))]


def test_empty_table_and_clashing_columns(documents, clashing):
    assert packing.pack(packing.pieces(documents.limit(0), JSON)).collect() == []
    assert packing.pieces(clashing, JSON).count() == 3
