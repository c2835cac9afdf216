"""Incremental page ingest (S1, S2, U1 as a stream).

The source fetches pages over hours; here each landed page file is picked up
once by a file-source stream and its records are appended to a bronze
Parquet table partitioned by source.  The transformation is stateless (parse
and explode), the file sink is exactly-once through the stream's checkpoint,
and the checkpoint lies inside the bronze table's folder, so a restarted or
re-run job resumes where it stopped.  Deduplication (last write wins, first
row per key) happens in batch over the bronze table, where the order of
pages is known.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from finmesh.operators.generators import is_object
from finmesh.schemas import BROKEN_LINE, DOCUMENT_RECORD, NESTED_RECORD, PAGE_ENVELOPE, PROJECT_RECORD
from finmesh.sources.pages import page_entries, record_of


REJECTED = "rejected"


def page_records(pages: DataFrame) -> DataFrame:
    """Records of both page kinds in one frame and one pass (works on batch and streaming frames), kept as JSON text,
    which the builders accept.  What is no record has source ``rejected``, a reason, and its raw text in ``record``."""
    e, document = page_entries(pages).where(is_object("entry") | F.col("reason").isNotNull()), F.col("source") == "documents"
    record = (F.when(F.col("reason").isNotNull(), F.coalesce("unread", F.to_json("entry")))
               .when(document, F.to_json(record_of(DOCUMENT_RECORD))).otherwise(F.to_json(record_of(PROJECT_RECORD))))
    return e.select(F.when(F.col("reason").isNotNull(), F.lit(REJECTED)).otherwise(F.col("source")).alias("source"),
                    "landing_seq", "page_year", "page_offset", "pos", F.col("entry_key").alias("record_key"), record.alias("record"),
                    F.when(document & F.col("reason").isNull(), F.to_json(record_of(NESTED_RECORD))).alias("nested"),
                    F.when(document, F.col("total").try_cast("long")).alias("total"), "reason")


def ingest_pages(spark: SparkSession, landing_dir: str, bronze_dir: str,
                 checkpoint: str | None = None, max_files_per_trigger: int = 1000) -> None:
    """Append the records of every page file not yet ingested, then stop
    (available-now trigger: all files present at start, in bounded batches)."""
    # One checkpoint per table: the file sink counts a new query's batches as already written.
    checkpoint = checkpoint or f"{bronze_dir.rstrip('/')}/_ingest-checkpoint"
    pages = (spark.readStream.schema(PAGE_ENVELOPE).option("columnNameOfCorruptRecord", BROKEN_LINE)
             .option("maxFilesPerTrigger", max_files_per_trigger).json(landing_dir))
    q = (page_records(pages).writeStream.format("parquet")
         .option("path", bronze_dir).option("checkpointLocation", checkpoint)
         .partitionBy("source").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


def read_bronze(spark: SparkSession, bronze_dir: str, source: str) -> DataFrame:
    """The bronze records of one source (partition-pruned); ``rejected``: the quarantine."""
    return spark.read.parquet(bronze_dir).filter(F.col("source") == F.lit(source))
