"""Statistics against plain loops; the cascade's order never changes its verdict."""
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from finmesh.llm import quality
from finmesh.llm.common import table
from tests.conftest import SF001


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="ab #é\n\t\x1c\x85", max_size=80))
def test_statistics(text):
    own = quality.Text(text)
    assert tuple(getattr(own, f) for f in quality.FEATURES) == brute(text)


def test_rows(documents):
    texts = {}
    for r in documents.collect():
        texts.setdefault(r.doc_id, r.text)
    out = quality.judge(documents).collect()
    assert len(out) == documents.count()
    for r in out:
        n_words, chars, symbols, dup, repeat = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n_words, chars, symbols, dup, repeat)
        assert r.base_failed == (n_words < 50 or 100 * repeat > 50 * n_words)
        assert not (r.base_failed and r.kept)


def test_any_order_keeps_the_same(documents):
    orders = [list(quality.RULES), list(quality.RULES)[::-1], quality.cascade_order(documents)]
    kept = [sorted((r.doc_id or 0) for r in quality.keep(documents, o).collect()) for o in orders]
    assert kept[0] == kept[1] == kept[2]
    assert kept[0] == sorted((r.doc_id or 0) for r in quality.judge(documents, orders[0]).where("kept").collect())


def test_measure(documents):
    rows = {r.rule: r for r in quality.measure(documents, sample_rows=10_000).collect()}
    assert set(rows) == set(quality.RULES)
    few = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) < 50 for r in documents.collect())
    assert abs(rows["few_words"].selectivity - few / documents.count()) < 1e-9
    assert all(r.cost > 0 for r in rows.values())


def test_labelled_documents(spark):
    """On the labelled documents the verdict is the label, but for short texts, which the base rule rejects."""
    docs = table(spark, SF001, "documents").join(table(spark, SF001, "labels"), "doc_id")
    for r in docs.join(quality.judge(docs), "doc_id").collect():
        assert r.kept == (r.quality == 1) or r.n_words < 50 or r.base_failed


def test_empty_table_and_clashing_columns(documents, clashing):
    assert quality.judge(documents.limit(0)).collect() == [] == quality.keep(documents.limit(0)).collect()
    assert quality.keep(clashing).columns == clashing.columns


def test_keep_takes_texts_in_modest_batches(spark):
    """The text goes to the workers once, in batches of a bounded number of rows; the stage sets that by itself."""
    import corpus_pipeline
    from pyspark.sql import functions as F
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.unset(key)
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(
        F.sequence(F.lit(1), F.lit(60)), lambda i: F.concat(F.lit("word"), i.cast("string")))).alias("text"))
    kept = dict(corpus_pipeline.STAGES)["quality_rules"](spark, docs, "")
    assert int(spark.conf.get(key)) <= 1024
    assert kept.count() == 40 and kept.columns == ["doc_id", "text"]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "judged_text" not in plan
