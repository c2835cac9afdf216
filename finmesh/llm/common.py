"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmesh.session import scratch_path

# ASCII white space: words are what is left between these (bytes.split() splits at exactly them).
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared scratch folder and read it back: cuts lineage, and a lost executor rereads files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that does not clash with any column of ``df``."""
    taken = {c.lower() for c in df.columns}
    return name if name.lower() not in taken else f"{name}_{uuid.uuid4().hex[:8]}"


def ascii_lower(column):
    return F.translate(column, UPPER, LOWER)


def hex_sha256(data: bytes) -> str:
    import hashlib
    return hashlib.sha256(data).hexdigest()
