"""Exact deduplication (operator 2): a stateful stream keyed by the digest of the text.

1. Every row becomes a narrow record (digest, id, content locator) in the shared folder.
2. A Structured Streaming query reads those records.  Its state (RocksDB on disk, no
   watermark, so nothing expires) keeps for each digest the greatest (id, locator) and
   the number of rows.  Each micro-batch aggregates before its shuffle, so a digest that
   a third of all rows share costs one record per task; ``foreachBatch`` stores the
   groups that changed.
3. Hits (groups of more than one row) are checked on full bytes: the content is fetched by
   locator and compared with the content of the row that stays.  Rows whose bytes differ
   (a digest collision) are grouped again by the whole text.

Texts are equal when identical after lower-casing A-Z only; null counts as empty.  Of
equal texts the row of the greatest id stays (null ids lowest); rows that repeat an id
are told apart by their locator, so exactly one row of a group stays.  A frame that does
not come straight from files is stored first, since locators are file and row.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmesh.llm.common import ascii_lower, fresh, stored
from finmesh.session import scratch_path

#: State on disk; no space is set aside ahead for the many small stores of a wide shuffle.
STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}


def digest_of(text):
    return F.unhex(F.sha2(text, 256))


def located(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text normalised, file, row): file and row locate the content."""
    def take(frame):
        return frame.select(F.col(id_col).cast("long").alias("doc_id"),
                            ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text"),
                            F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    try:
        return take(df)
    except AnalysisException:
        return take(stored(df.select(id_col, text_col), "dedup-content"))


def _stream_groups(records: DataFrame, path: str, max_bytes_per_trigger: int | None) -> DataFrame:
    """Latest state of each digest: (digest, keep, n)."""
    spark = records.sparkSession
    out, checkpoint = scratch_path(spark, "dedup-groups"), scratch_path(spark, "dedup-stream")
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        reader = spark.readStream.schema(records.schema)
        if max_bytes_per_trigger:
            reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
        groups = reader.parquet(path).groupBy("digest").agg(
            F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count(F.lit(1)).alias("n"))

        def save(batch: DataFrame, batch_id: int) -> None:
            # one folder per batch, overwritten: a batch that is run again leaves no second copy
            batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/b{batch_id}")

        groups.writeStream.outputMode("update").foreachBatch(save).trigger(availableNow=True).option(
            "checkpointLocation", checkpoint).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    schema = f"digest binary, keep {records.select(F.struct('doc_id', 'file', 'row')).schema[0].dataType.simpleString()}, n long, batch int"
    batches = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(out)
    return batches.groupBy("digest").agg(F.max_by("keep", "batch").alias("keep"), F.max("n").alias("n"))


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=digest_of,
          max_bytes_per_trigger: int | None = None) -> DataFrame:
    """One row per row of ``df``: doc_id, file, row, keep_id, group_size, kept, text_sha256.

    ``digest`` may be any function of the normalised text: a weak one costs checks, not results."""
    docs = located(df, id_col, text_col)
    spark = df.sparkSession
    if df.isEmpty():
        return docs.select("doc_id", "file", "row", F.col("doc_id").alias("keep_id"), F.lit(0).cast("long").alias("group_size"),
                           F.lit(True).alias("kept"), F.lit("").alias("text_sha256"))
    path = scratch_path(spark, "dedup-records")
    docs.select(digest(F.col("text")).alias("digest"), "doc_id", "file", "row",
                F.sha2("text", 256).alias("text_sha256")).write.parquet(path)
    records = spark.read.parquet(path)
    groups = _stream_groups(records.drop("text_sha256"), path, max_bytes_per_trigger)
    marked = records.join(groups, "digest")
    single = marked.where("n = 1").select("doc_id", "file", "row", F.col("doc_id").alias("keep_id"),
                                          F.col("n").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    # full bytes of the hits, fetched by locator
    hits = stored(marked.where("n > 1").select("digest", "doc_id", "file", "row", "keep", "text_sha256").join(
        docs.select("file", "row", "text"), ["file", "row"]), "dedup-hits")
    stays = hits.where("doc_id <=> keep.doc_id and file = keep.file and row = keep.row").select("digest", F.col("text").alias("kept_text"))
    checked = hits.join(stays, "digest").select(
        "digest", "doc_id", "file", "row", "text_sha256",
        F.when(F.col("text") != F.col("kept_text"), F.col("text")).alias("other"))   # null: same bytes as the row that stays
    classes = checked.groupBy("digest", "other").agg(
        F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    left, right = checked.alias("a"), classes.alias("b")
    grouped = left.join(right, (F.col("a.digest") == F.col("b.digest")) & F.col("a.other").eqNullSafe(F.col("b.other"))).select(
        "a.doc_id", "a.file", "a.row", F.col("keep.doc_id").alias("keep_id"), "group_size",
        ((F.col("a.file") == F.col("keep.file")) & (F.col("a.row") == F.col("keep.row"))).alias("kept"), "text_sha256")
    return single.unionByName(grouped)


def drop_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, all columns.  ``df`` is stored first if it does not come straight from files."""
    try:
        df.select("_metadata.row_index")
    except AnalysisException:
        df = stored(df, "dedup-input")
    file, row = fresh(df, "dedup_file"), fresh(df, "dedup_row")
    gone = dedup(df, id_col, text_col).where(~F.col("kept")).select(F.col("file").alias(file), F.col("row").alias(row))
    rows = df.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
    return rows.join(gone, [file, row], "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])
