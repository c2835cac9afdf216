"""Table and file reads."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet table, optionally only some columns (S7).  Column pruning and
    filter pushdown reach the scan through Catalyst."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType, null: str = "\\N") -> DataFrame:
    """Typed CSV scan with header, comma, UTF-8 (S9).  Never infers.  Reads
    doubled quotes and line breaks inside quotes; ``null`` is the text that
    stands for null (exports of other tools often use the empty value)."""
    return (spark.read.schema(schema).option("header", True).option("sep", ",")
            .option("encoding", "UTF-8").option("mode", "PERMISSIVE").option("multiLine", True)
            .option("quote", '"').option("escape", '"').option("nullValue", null).option("emptyValue", "")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .csv(path))
