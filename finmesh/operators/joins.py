"""Semi-joins to known parents.

No broadcast hints: Catalyst and AQE broadcast a side after measuring it
against ``spark.sql.autoBroadcastJoinThreshold`` and otherwise use a shuffled
sort-merge or hash join; AQE's skew-join splitting handles hot keys.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def keep_known(df: DataFrame, known: DataFrame, cols: Sequence[str],
               known_cols: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``df`` whose ``cols`` exist in ``known`` (``left_semi``); a
    null never matches."""
    known_cols = list(known_cols or cols)
    k = known.select(*[F.col(a).alias(b) for a, b in zip(known_cols, cols)])
    return df.join(k, list(cols), "left_semi")
