"""Marts and analytic results (R1-R9) over the normalised tables.

Every function takes the tables it needs as DataFrames, so the same code
runs on freshly built tables, on tables read back from storage, or on the
stand-in model of the driver tables.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from finmesh.functions.coerce import allocated_amount
from finmesh.operators.filters import OTHER_REGION, exclude_members, repair_region


def project_document_dates(projects: DataFrame, documents: DataFrame) -> DataFrame:
    """Approval date next to each document's date."""
    p = projects.select("project_id", "countryshortname", "boardapprovaldate")
    d = documents.select("project_id", "docdt", "document_type", "document_id")
    return p.join(d, "project_id").select(
        "project_id", "countryshortname", "boardapprovaldate", "docdt", "document_type", "document_id")


def project_sector_percent(projects: DataFrame, project_sectors: DataFrame,
                           proj_sector_lookup: DataFrame) -> DataFrame:
    """R2: project -> sector name and percent."""
    p = projects.select("project_id")
    ps = project_sectors.select("project_id", "sector_code", "sector_percent")
    sl = proj_sector_lookup.select("sector_code", "sector_name")
    return p.join(ps, "project_id").join(sl, "sector_code").select(
        "project_id", "sector_name", "sector_percent")


def project_major_sector(projects: DataFrame, project_major_sectors: DataFrame,
                         major_sector_lookup: DataFrame) -> DataFrame:
    """Project -> major sector name."""
    p = projects.select("project_id")
    pms = project_major_sectors.select("project_id", "major_sector_code")
    msl = major_sector_lookup.select("major_sector_code", "major_sector_name")
    return p.join(pms, "project_id").join(msl, "major_sector_code").select(
        "project_id", "major_sector_name")


def project_sector_detail(projects: DataFrame, project_major_sectors: DataFrame,
                          major_sector_lookup: DataFrame, project_sectors: DataFrame,
                          proj_sector_lookup: DataFrame, ordered: bool = True) -> DataFrame:
    """Five-table join through the bridge's surrogate key (J4), sorted (O1)."""
    out = _detail(projects.select("project_id"), project_major_sectors, major_sector_lookup,
                  project_sectors, proj_sector_lookup)
    return out.orderBy("project_id", "major_sector_code", "sector_code") if ordered else out


def _detail(p: DataFrame, project_major_sectors: DataFrame, major_sector_lookup: DataFrame,
            project_sectors: DataFrame, proj_sector_lookup: DataFrame) -> DataFrame:
    """The five-table join; columns of ``p`` beyond the id are carried along."""
    pms = project_major_sectors.select("project_major_sector_id", "project_id", "major_sector_code")
    msl = major_sector_lookup.select("major_sector_code", "major_sector_name")
    ps = project_sectors.select("project_major_sector_id", "sector_code", "sector_percent")
    sl = proj_sector_lookup.select("sector_code", "sector_name")
    return (p.join(pms, "project_id").join(msl, "major_sector_code")
             .join(ps, "project_major_sector_id").join(sl, "sector_code")
             .select(*p.columns, "major_sector_code", "major_sector_name",
                     "sector_code", "sector_name", "sector_percent"))


def sector_mart(projects: DataFrame, project_major_sectors: DataFrame,
                major_sector_lookup: DataFrame, project_sectors: DataFrame,
                proj_sector_lookup: DataFrame) -> DataFrame:
    """The 9-column ``project_sector_details`` mart (R4 + country + total +
    allocated amount, F12)."""
    detail = _detail(projects.select("project_id", "countryshortname", "totalamt"), project_major_sectors,
                     major_sector_lookup, project_sectors, proj_sector_lookup)
    return detail.select(
        "project_id", "countryshortname", "totalamt", "major_sector_code", "major_sector_name",
        "sector_code", "sector_name", "sector_percent",
        allocated_amount("totalamt", "sector_percent").alias("allocated_amount"))


def sector_coverage(project_sectors: DataFrame) -> DataFrame:
    """Projects with sector data, with a non-zero / a zero percent (A1, A2).

    Two levels: two flags per project (combined on the map side), then counts;
    three distinct counts would expand every row three times."""
    pct = F.col("sector_percent")
    flags = project_sectors.where(F.col("project_id").isNotNull()).groupBy("project_id").agg(
        F.max(pct != 0).alias("nonzero"), F.max(pct == 0).alias("zero"))
    return flags.agg(
        F.count(F.lit(1)).alias("projects_with_sector_data"),
        F.count_if("nonzero").alias("projects_with_nonzero_percent"),
        F.count_if("zero").alias("projects_with_zero_percent"))


def sector_coverage_total(projects: DataFrame, project_sectors: DataFrame) -> DataFrame:
    """R5 plus the total number of projects as a scalar subquery."""
    total = projects.agg(F.count(F.lit(1))).scalar()
    return sector_coverage(project_sectors).select(
        total.alias("total_projects"), "projects_with_sector_data",
        "projects_with_nonzero_percent", "projects_with_zero_percent")


def top_sectors(allocations: DataFrame, country: str, k: int = 10,
                exclude: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """The ``k`` sectors of one country with the largest allocated amount
    (P8, P9, A4, O2, O3); ties broken by name.

    ``allocations`` needs ``countryshortname, sector_name, allocated_amount``
    (the mart, or ``allocation_rows``).
    """
    rows = allocations.filter(F.col("countryshortname") == F.lit(country))
    if exclude is not None:
        rows = exclude_members(rows, "sector_name", exclude)
    summed = rows.groupBy("sector_name").agg(
        F.sum("allocated_amount").cast("decimal(38,8)").alias("allocated_amount"))
    return summed.orderBy(F.desc("allocated_amount"), F.asc("sector_name")).limit(k)


def top_sectors_preaggregated(projects: DataFrame, project_sectors: DataFrame,
                              proj_sector_lookup: DataFrame, country: str, k: int = 10,
                              exclude: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """R8 planned for scale.

    The allocated amount is summed per sector *code* right after the
    project/bridge join (map-side partial aggregation collapses the bridge
    to at most one row per code and task before any further shuffle), and
    only then joined to the sector names, filtered and re-summed by name.
    Same result as ``top_sectors`` over the mart whenever every bridge row
    has its parent and lookup rows (the foreign-key audits check that).
    """
    p = projects.filter(F.col("countryshortname") == F.lit(country)).select("project_id", "totalamt")
    ps = project_sectors.select("project_id", "sector_code", "sector_percent")
    per_code = p.join(ps, "project_id").groupBy("sector_code").agg(
        F.sum(allocated_amount("totalamt", "sector_percent")).alias("allocated_amount"))
    named = per_code.join(proj_sector_lookup.select("sector_code", "sector_name"), "sector_code")
    if exclude is not None:
        named = exclude_members(named, "sector_name", exclude)
    summed = named.groupBy("sector_name").agg(
        F.sum("allocated_amount").cast("decimal(38,8)").alias("allocated_amount"))
    return summed.orderBy(F.desc("allocated_amount"), F.asc("sector_name")).limit(k)


def repaired_country(country: DataFrame, placeholder: str = OTHER_REGION) -> DataFrame:
    """Region := country where missing or the placeholder."""
    return country.select("countryshortname",
                          repair_region("countryshortname", "regionname", placeholder).alias("regionname"))
