"""Keyed merge into a stored table (A7, U1): newest value per key, without a rebuild.

The stored table is dealt into buckets by the hash of its key.  A merge reads and writes only the
buckets that hold a key of the updates; which folder holds a bucket is said by a manifest that
replaces the old one at the end (``sources.commit``), so a failed merge changes nothing and a repeated one changes
nothing further.  Every row keeps its order (``newest``) and the first place of its key
(``first_seen``); both sides are aggregated together, combined before the shuffle, so a key with any number of
updates is never gathered in one task.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from finmesh.session import delete_folder, scratch_path
from finmesh.sources import commit

BUCKETS = 64
_BUCKET, _MANIFEST = "key_bucket", "_current"


def _manifest(spark: SparkSession, path: str) -> dict:
    return commit.read_json(spark, f"{path}/{_MANIFEST}") or {}


def merge_by_key(updates: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], buckets: int = BUCKETS) -> int:
    """Merge ``updates`` into the table at ``path`` (made if it does not exist); the number of buckets written anew.

    Of equal keys the row with the greatest ``order`` stays, at the first-seen place of its key.  ``buckets``
    counts when the table is made: choose it so that a bucket is a few hundred MB.  Null keys are one key."""
    spark = updates.sparkSession
    held = _manifest(spark, path)
    buckets = held.get("buckets", buckets)
    payload = [c for c in updates.columns if c not in keys and c not in order]
    place, row = F.struct(*order), F.struct(*payload)
    fresh = updates.groupBy(*keys).agg(F.max_by(row, place).alias("row"), F.max(place).alias("newest"), F.min(place).alias("first_seen"))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    fresh = fresh.withColumn(_BUCKET, bucket)
    staged = scratch_path(spark, "merge-updates")
    fresh.write.parquet(staged)
    fresh = spark.read.schema(fresh.schema).parquet(staged)
    touched = sorted(r[0] for r in fresh.select(_BUCKET).distinct().collect())          # at most ``buckets`` numbers
    old = [f"{path}/{held['folders'][str(b)]}" for b in touched if str(b) in held.get("folders", {})]
    both = fresh
    if old:
        stored = spark.read.schema(fresh.drop(_BUCKET).schema).parquet(*old).withColumn(_BUCKET, bucket)
        both = fresh.unionByName(stored.select(*fresh.columns)).groupBy(*keys, _BUCKET).agg(
            F.max_by("row", "newest").alias("row"), F.max("newest").alias("newest"), F.min("first_seen").alias("first_seen"))
    run = f"merge-{uuid.uuid4().hex}"
    if touched:
        both.select(*fresh.columns).repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(f"{path}/{run}")
    folders = {**held.get("folders", {}), **{str(b): f"{run}/{_BUCKET}={b}" for b in touched}}
    commit.commit_json(spark, f"{path}/{_MANIFEST}", {"buckets": buckets, "folders": folders, "schema": fresh.drop(_BUCKET).schema.json()}, replace=True)
    delete_folder(spark, staged)
    return len(touched)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """``keys..., first_seen, newest, payload...`` of a merged table."""
    held = _manifest(spark, path)
    schema = StructType.fromJson(json.loads(held["schema"]))
    folders = [f"{path}/{f}" for f in held["folders"].values()]
    df = spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
    return df.select(*[c for c in df.columns if c not in ("row", "newest", "first_seen")], "first_seen", "newest", "row.*")


def remove_replaced(spark: SparkSession, path: str) -> int:
    """Delete bucket folders that the manifest no longer names (once no reader of an older one is left); how many."""
    live = set(_manifest(spark, path).get("folders", {}).values())
    gone = [f"{run}/{b}" for run in commit.names(spark, path) if run.startswith("merge-")
            for b in commit.names(spark, f"{path}/{run}") if b.startswith(_BUCKET) and f"{run}/{b}" not in live]
    for folder in gone:
        delete_folder(spark, f"{path}/{folder}")
    return len(gone)
