"""Physical-plan properties that matter at scale."""
import __spark_entry__ as E
from tests.conftest import SF001


def _formatted(spark, df):
    import io
    import contextlib
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_id_only_marts_do_not_read_customers(spark):
    for name in ("project_sector_percent", "project_major_sector"):
        text = _formatted(spark, E.queries()[name](spark, SF001))
        assert "customer.parquet" not in text and "nation.parquet" not in text


def test_coverage_has_no_expand(spark):
    assert "Expand" not in _formatted(spark, E.queries()["sector_coverage"](spark, SF001))


def test_mart_joins_projects_once(spark):
    text = _formatted(spark, E.queries()["sector_mart"](spark, SF001))
    assert text.count("orders.parquet") == 1


def test_keyed_records_parse_pages_once_without_self_join(spark):
    text = _formatted(spark, E.queries()["keyed_records"](spark, SF001))
    assert "Join" not in text


def test_column_read_back_prunes(spark):
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in _formatted(spark, E.queries()["column_read_back"](spark, SF001))


def test_length_audit_scans_once(spark):
    assert _formatted(spark, E.queries()["length_audit"](spark, SF001)).count("Scan parquet") <= 2      # listed in the tree and below it


def test_flagship_pushes_filter_and_prunes_columns(spark):
    text = _formatted(spark, E.queries()["top_sectors_for_country"](spark, SF001))
    assert "EqualTo(n_name,NATION_7)" in text                       # country filter reaches the scan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_discount:double>" in text
    assert "partial_sum" in text                                    # pre-aggregated before the exchange


def test_keep_first_combines_before_the_shuffle(spark):
    text = _formatted(spark, E.queries()["keep_first"](spark, SF001))
    assert "partial_min_by" in text


def test_preaggregated_flagship_equals_mart_based_top_sectors(spark):
    q = E.queries()
    a = [tuple(r) for r in q["top_sectors_for_country"](spark, SF001).collect()]
    b = [tuple(r) for r in q["top_sectors_from_mart"](spark, SF001).collect()]
    assert a == b and len(a) > 0
