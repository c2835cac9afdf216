"""The driver tables seen as the normalised model.

Stand-ins: project = ``orders`` (country through ``customer``/``nation``),
sector bridge row = ``lineitem`` (percent = discount x 100, zeros exist),
sector lookup = ``part`` (name = ``p_name``), major sector = ``p_type``,
document = ``lineitem`` (date = ship date, type = return flag),
country/region = ``nation``/``region``.

Join strategies are left to AQE, which measures the sides.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

class DriverTables:
    """Lazy access to ``{sf_dir}/{name}.parquet`` with explicit column pruning.

    Every use selects its columns, so Catalyst prunes the scan per branch.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __call__(self, name: str, *cols: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return df.select(*cols) if cols else df


def percent_of_discount(c="l_discount"):
    """Discount 0.07 -> sector percent 7.00, exactly (decimal before scaling)."""
    col = F.col(c) if isinstance(c, str) else c
    return (col.cast("decimal(4,2)") * F.lit(100)).cast("decimal(5,2)")


def customer_country(t: DriverTables) -> DataFrame:
    """``c_custkey, n_name``: each customer's country."""
    c = t("customer", "c_custkey", "c_nationkey")
    n = t("nation", "n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select("c_custkey", "n_name")


def projects(t: DriverTables) -> DataFrame:
    o = t("orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    # customer x nation first: a country filter on the result is pushed into the
    # nation side and reduces customers before they meet orders.
    cn = customer_country(t)
    j = o.join(cn, o.o_custkey == cn.c_custkey, "left")
    return j.select(F.col("o_orderkey").alias("project_id"),
                    F.col("n_name").alias("countryshortname"),
                    F.col("o_totalprice").cast("decimal(20,2)").alias("totalamt"),
                    F.col("o_orderdate").cast("date").alias("boardapprovaldate"))


def _sector_rows(t: DriverTables) -> DataFrame:
    li = t("lineitem", "l_orderkey", "l_partkey", "l_discount")
    p = t("part", "p_partkey", "p_type")
    return li.join(p, li.l_partkey == p.p_partkey)


def bridge_id(project_id, major_sector_code):
    """Stand-in surrogate of the project x major-sector bridge: the natural
    key itself (unique by construction), so no global numbering is needed."""
    return F.concat_ws("|", F.col(project_id).cast("string"), F.col(major_sector_code))


def project_sectors(t: DriverTables) -> DataFrame:
    r = _sector_rows(t)
    return r.select(F.col("l_orderkey").alias("project_id"),
                    bridge_id("l_orderkey", "p_type").alias("project_major_sector_id"),
                    F.col("l_partkey").alias("sector_code"),
                    percent_of_discount().alias("sector_percent"))


def project_sectors_lean(t: DriverTables) -> DataFrame:
    """Bridge rows without the parent id (no join with ``part``)."""
    li = t("lineitem", "l_orderkey", "l_partkey", "l_discount")
    return li.select(F.col("l_orderkey").alias("project_id"),
                     F.col("l_partkey").alias("sector_code"),
                     percent_of_discount().alias("sector_percent"))


def project_major_sectors(t: DriverTables) -> DataFrame:
    r = _sector_rows(t).select("l_orderkey", "p_type").distinct()
    return r.select(bridge_id("l_orderkey", "p_type").alias("project_major_sector_id"),
                    F.col("l_orderkey").alias("project_id"),
                    F.col("p_type").alias("major_sector_code"))


def proj_sector_lookup(t: DriverTables) -> DataFrame:
    return t("part", "p_partkey", "p_name").select(
        F.col("p_partkey").alias("sector_code"), F.col("p_name").alias("sector_name"))


def major_sector_lookup(t: DriverTables) -> DataFrame:
    return t("part", "p_type").distinct().select(
        F.col("p_type").alias("major_sector_code"), F.lower("p_type").alias("major_sector_name"))


def documents(t: DriverTables) -> DataFrame:
    li = t("lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")
    return li.select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("document_id"),
                     F.col("l_orderkey").alias("project_id"),
                     F.col("l_shipdate").cast("date").alias("docdt"),
                     F.col("l_returnflag").alias("document_type"))


def project_ids(t: DriverTables) -> DataFrame:
    """Projects where only the id is wanted: a left join that adds no column still runs."""
    return t("orders", "o_orderkey").select(F.col("o_orderkey").alias("project_id"))


def model(t: DriverTables) -> dict[str, DataFrame]:
    return {
        "projects": projects(t),
        "project_sectors": project_sectors(t),
        "project_major_sectors": project_major_sectors(t),
        "proj_sector_lookup": proj_sector_lookup(t),
        "major_sector_lookup": major_sector_lookup(t),
        "documents": documents(t),
    }


def country_rows(t: DriverTables) -> DataFrame:
    """Per-project (country, region) rows in page order, with planted cases:
    region equal to the country, region 'Other', region missing, a country
    named 'Other' (every 97th customer's)."""
    o = t("orders", "o_orderkey", "o_custkey", "o_orderpriority")
    c = t("customer", "c_custkey", "c_nationkey")
    n = t("nation", "n_nationkey", "n_name", "n_regionkey")
    r = t("region", "r_regionkey", "r_name")
    j = (o.join(c, o.o_custkey == c.c_custkey, "left")
          .join(n, F.col("c_nationkey") == n.n_nationkey, "left")
          .join(r, F.col("n_regionkey") == r.r_regionkey, "left"))
    pr = F.col("o_orderpriority")
    name = F.when(F.pmod("c_custkey", F.lit(97)) == 0, F.lit("Other")).otherwise(F.col("n_name"))
    region = (F.when(pr == "1-URGENT", name)
               .when(pr == "2-HIGH", F.lit("Other"))
               .when(pr == "3-MEDIUM", F.lit(None).cast("string"))
               .otherwise(F.col("r_name")))
    return j.select(F.lit(0).cast("long").alias("landing_seq"), F.lit(None).cast("int").alias("page_year"),
                    F.lit(0).cast("long").alias("page_offset"),
                    F.col("o_orderkey").alias("pos"),
                    name.alias("countryshortname"),
                    region.alias("regionname"))
