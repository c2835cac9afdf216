"""Registered queries of this subpackage: each applies one operator to its whole table, with production parameters."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmesh.llm import bpe, exact_dedup, html_main, jaccard_join, packing, periodic, pii, quality, secrets, simhash, spelling, url_filters, warc
from finmesh.llm.common import table
from finmesh.session import scratch_path


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every text of documents by the ranks of a public byte-level tokenizer."""
    import public_tokenizers
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    ids = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256",
                      F.sha2(bpe.decode(F.col("ids"), ranks), 256).alias("decoded_sha256"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts of documents; the row of the greatest doc_id stays."""
    return exact_dedup.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text of documents: base spans, and further ones by weak supervision."""
    return pii.spans_of(table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of 3-word shingles are at least 90 % alike."""
    return jaccard_join.components(table(spark, sf_dir, "documents"), width=3, percent=90)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write pages as WARC archives and read them back."""
    folder = scratch_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder).select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every text of documents and the verdict of the rule cascade."""
    return quality.judge(table(spark, sf_dir, "documents"))


def op7_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, with scores learned from the labelled pages of the table."""
    return html_main.extract(table(spark, sf_dir, "pages"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the fixed host and path rules on every URL of pages."""
    return url_filters.judge(table(spark, sf_dir, "pages"), url_filters.rules_frame(spark))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack the pieces of all documents into sequences of 2048 tokens."""
    import public_tokenizers
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        pieces = packing.pieces(table(spark, sf_dir, "documents"), f.read())
    return packing.pack(pieces)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text of documents: base spans, and credential values by guess cost."""
    return secrets.spans_of(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, one letter less where the contract says so, with their near words, forms and roots."""
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents"), rewrite=spelling.misspelt))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, and their components under a distance of at most two bits."""
    return simhash.components(table(spark, sf_dir, "documents"), width=3, distance=2)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every text of documents, after the repetitions that the contract plants."""
    return periodic.digests(periodic.detect(table(spark, sf_dir, "documents"), min_length=12, rewrite=periodic.repeated_stretch))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py over documents."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_byte_bpe, op2_exact_dedup, op3_pii, op4_jaccard_join, op5_warc, op6_quality, op7_html_main,
                                   op8_url_filters, op9_packing, op10_secrets, op11_spelling_variants, op12_simhash, op13_periodic_runs, pipeline)}

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE = {
    "op2_exact_dedup": f"""
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), {_LOWER}) AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM d""",
    "op4_jaccard_join": rf"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                                                  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
        l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 90 * (na.n + nb.n - i)),
        e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        r(v, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.v, e.b FROM r JOIN e ON e.a = r.c)
        SELECT doc_id, coalesce(n.n, 0) AS n_shingles, min(c) AS component_id FROM d JOIN r ON r.v = d.doc_id LEFT JOIN n USING (doc_id) GROUP BY doc_id, n.n""",
    "op5_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
             g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS last, strlen(h) AS n FROM p)
        SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
               CASE WHEN n >= 1000 AND last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND last <> page_id THEN last END AS refers_to FROM g""",
    "op6_quality": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        v AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d),
        c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM v),
        r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM c WHERE n > 1) GROUP BY doc_id),
        x AS (SELECT doc_id, t, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda z: length(z))), 0) AS BIGINT) AS word_chars,
                     length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                     list_filter(string_split(t, chr(10)), lambda z: regexp_matches(z, '[^\x20\x09-\x0D]')) AS l,
                     length(regexp_replace(t, '[^A-Z]', '', 'g')) AS up, length(regexp_replace(t, '[^a-z]', '', 'g')) AS low FROM d),
        y AS (SELECT x.*, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                     n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed FROM x LEFT JOIN r USING (doc_id))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT (base_failed OR 100 * n_symbols > 25 * n_words OR (up > low AND up > 20) OR 100 * n_dup_lines > 50 * len(l)
                    OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept FROM y""",
    "op8_url_filters": f"""
        WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
        v AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), {_LOWER}) AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
        rules(h, p, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
        m AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict FROM v, rules
              WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM v LEFT JOIN m USING (page_id)""",
}
