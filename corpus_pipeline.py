"""Corpus pipeline: quality rules, exact dedup, near duplicates, secret scan, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame, which ``run`` writes as Parquet and
reads again as the next stage's docs.  All stages but the last return the columns of documents.
SQL cannot express the pipeline (packing and the guess-cost scan), so ORACLE_SQL is None;
tests/llm/test_pipeline.py runs it against a brute-force version.
"""
from __future__ import annotations

from functools import wraps

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmesh.llm import exact_dedup, jaccard_join, packing, quality, secrets
from finmesh.llm.common import fresh, stored, table
from finmesh.session import configure

NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document of the greatest doc_id."""
    return exact_dedup.drop_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row of the least doc_id, of equal ids the first in file and row (rows
    without an id stay).  Rows are told apart by file and row, so rows that repeat an id are judged each by its text."""
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        docs = stored(docs, "near-input")
    own, file, index = (fresh(docs, name) for name in ("near_row", "near_file", "near_index"))
    names = sorted(r[0] for r in docs.select("_metadata.file_path").distinct().collect())
    # file number and row number in one long; the files' table is stored, so that its size is known before the joins are
    # planned: while it is short it goes to every task, and texts stay where they are
    files = stored(spark.createDataFrame(list(enumerate(names)), f"{own} long, {file} string"), "near-files")
    rows = docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(index)).join(files, file, "left").withColumn(
        own, F.when(F.col("doc_id").cast("long").isNotNull(), F.shiftleft(F.col(own), 40) + F.col(index))).drop(file, index)
    ids = rows.where(F.col(own).isNotNull()).select(F.col(own).alias("doc_id"), F.col("doc_id").cast("long").alias("id"))
    near = jaccard_join.components(rows, NEAR_WORDS, NEAR_PERCENT, id_col=own).where("doc_id is not null")
    near = stored(near.join(ids, "doc_id").select("component_id", F.struct("id", "doc_id").alias("row")), "near-groups")
    stay = near.groupBy("component_id").agg(F.min("row").alias("row")).select("row.doc_id")
    # stored, so that its size is known before the join is planned: a short list leaves the texts where they are
    gone = stored(near.select("row.doc_id").join(stay, "doc_id", "left_anti").select(F.col("doc_id").alias(own)), "near-gone")
    return rows.join(gone, own, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced; n_chars follows the text."""
    out = secrets.redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in the packed sequences."""
    import public_tokenizers
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return packing.pack(packing.pieces(docs, f.read()))


def _configured(stage):
    """A stage may be called by itself: the session's defaults hold there as well."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(configure(spark), docs, sf_dir)
    return run_stage


STAGES = [(name, _configured(stage)) for name, stage in (
    ("quality_rules", quality_rules), ("exact_dedup", exact_duplicates), ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan), ("packing", sequence_packing))]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
