"""Page plan and completeness audit.

The source fetches pages of ``page_size`` records per year, offsets below the
year's ``total``.  Here the plan is a DataFrame derived from the per-year
totals, and the audit compares it with the inventory of landed pages: no
driver loop, no fetch.  Every page is planned; how many records lie beyond
the number the source's interface serves is only reported.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from finmesh.functions.coerce import percent_complete

# Fixed values of the source fetch: records per page and records served per year at most.
PAGE_SIZE = 1000
MAX_RECORDS_PER_YEAR = 100_000


def page_plan(totals: DataFrame, group: str = "year", page_size: int = PAGE_SIZE) -> DataFrame:
    """``group, total, offset`` for every page to fetch.  Groups with a zero
    total get no pages (an empty ``sequence`` range would fail)."""
    return totals.filter(F.col("total") > 0).select(
        group, "total",
        F.explode(F.sequence(F.lit(0).cast("long"), (F.col("total") - 1).cast("long"),
                             F.lit(page_size).cast("long"))).alias("page_offset"))


def missing_pages(plan: DataFrame, inventory: DataFrame, group: str = "year") -> DataFrame:
    """Planned pages that did not land: ``group, page_offset``."""
    return plan.select(group, "page_offset").join(inventory.select(group, "page_offset"),
                                             [group, "page_offset"], "left_anti")


def completeness(plan: DataFrame, inventory: DataFrame, group: str = "year",
                 served: int = MAX_RECORDS_PER_YEAR) -> DataFrame:
    """Per group: planned/landed/failed pages, landed records, percent done
    (rounded to one decimal), records beyond the ``served`` ones."""
    planned = plan.groupBy(group).agg(F.max("total").alias("total"),
                                      F.count(F.lit(1)).alias("planned_pages"))
    landed = (inventory.join(plan.select(group, "page_offset"), [group, "page_offset"], "left_semi")
              .groupBy(group).agg(F.count(F.lit(1)).alias("landed_pages"),
                                  F.sum("records").cast("long").alias("landed_records")))
    out = planned.join(landed, group, "left").fillna(0, ["landed_pages", "landed_records"])
    return out.select(
        group, F.col("total").cast("long").alias("total"),
        F.col("planned_pages").cast("long").alias("planned_pages"),
        F.col("landed_pages").cast("long").alias("landed_pages"),
        (F.col("planned_pages") - F.col("landed_pages")).cast("long").alias("failed_pages"),
        F.col("landed_records").cast("long").alias("landed_records"),
        percent_complete("landed_records", "total").alias("pct_done"),
        F.greatest(F.col("total") - F.lit(served), F.lit(0)).cast("long").alias("records_beyond_cap"))
