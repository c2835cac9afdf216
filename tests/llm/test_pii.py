"""Base spans against the plain patterns; the weak supervision on planted cases."""
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from finmesh.llm import pii

PATTERNS = pii.compiled()


def brute(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="ab@.-_+ ()0123459", max_size=50))
def test_base_spans(text):
    assert pii.base_spans(text, PATTERNS) == brute(text)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_reliabilities_recover_a_good_and_a_bad_labeler():
    import numpy as np
    rng, counts = np.random.default_rng(3), {}
    for _ in range(20_000):
        truth = rng.random() < 0.4
        votes = tuple(int(truth) if rng.random() < good else int(not truth) for good in (0.95, 0.9, 0.9, 0.85, 0.55))
        counts[votes] = counts.get(votes, 0) + 1
    found, posterior = pii.reliabilities([("email", v, n) for v, n in sorted(counts.items())])
    sens = [found[name][0] for name in pii.LABELERS]
    assert abs(sens[0] - 0.95) < 0.03 and abs(sens[4] - 0.55) < 0.05
    assert posterior["email", (1, 1, 1, 1, 1)] > 0.99 > 0.01 > posterior["email", (0, 0, 0, 0, 0)]


def test_query_keeps_base_and_adds(spark, documents):
    planted = "Dear Dr. Maria Lopez, phone (030) 555-1234, IBAN DE89 3704 0044 0532 0130 00, mail a.b@example.com. Order 111111111111."
    df = documents.unionByName(spark.createDataFrame([(1_000_000, planted)], "doc_id long, text string"))
    texts = {}
    for r in df.collect():
        texts.setdefault(r.doc_id, r.text or "")
    out = pii.spans_of(df).collect()
    assert len(out) == df.count()
    for r in out:
        spans = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)]
        base = [s for s in spans if s[0] in pii.BASE]
        if r.doc_id != 900_005:
            assert base == brute(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(b[0] == k for b in base) for k in pii.BASE)
        assert r.base_sha256 == pii.hex_sha256(pii.joined(base).encode())
        if r.doc_id == 1_000_000:
            kinds = {k: planted[s:e] for k, s, e in spans}
            assert kinds["name"] == "Dr. Maria Lopez" and kinds["iban"].startswith("DE89") and "local_phone" in kinds and "long_number" not in kinds


def test_empty_table(documents):
    assert pii.spans_of(documents.limit(0)).collect() == []


def test_long_digit_runs():
    """Parts of an address with thousands of digits: no limit of int() is met."""
    zeros, ones = "0" * 5000, "1" * 5000
    patterns = pii.compiled()
    assert [s[0] for s in pii.base_spans(f"{zeros}.{zeros}7.1.2", patterns)] == ["ip"]
    assert pii.base_spans(f"{ones}.1.1.1", patterns) == [] == pii.base_spans(f"1.2.3.{ones}", patterns)


def test_many_candidates_in_one_text(spark):
    """A text of a megabyte full of candidates is swept once per kind; spans do not overlap."""
    import time
    text = "Dear Mr John Smith, call (030) 1234 567 or 123-45-6789, mail a.b@c.example or x at y dot com; " * 11_000
    df = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    start = time.time()
    rows = {r.doc_id: r for r in pii.spans_of(df).collect()}
    assert time.time() - start < 120
    assert rows[1].n_email == 11_000 and rows[2].spans == ""
    spans = sorted(tuple(map(int, s.split(":")[1:])) for s in rows[1].spans.split(","))
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "mail a@b.example", "x", 5, None), (None, None, None, None, None)],
                               "doc_id long, text string, spans string, n_email long, votes string")
    assert {(r.doc_id, r.n_email) for r in pii.spans_of(df).collect()} == {(1, 1), (None, 0)}
