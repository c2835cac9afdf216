"""Column functions F1-F13 against Python's own behaviour on the same strings."""
import re

import pytest

from finmesh.functions import (
    clean_items, first_nested_value, parse_date, parse_decimal, parse_int_id, parse_int_number,
    percent_complete, split_comma_nospace, split_plain, strip_ws,
)

SAMPLES = [
    "Roads, Bridges,Ports",
    "a,,b",
    "trailing,",
    "\tTabbed , nbsp ,x",
    "Governance, School-Based Management,Finance, Audit, and Control,Health",
    ", leading",
    "",
    "no delimiter",
    "x ,y, z,\n,w",
]


def py_plain(s):
    return [t.strip() for t in s.split(",") if t.strip()]


def py_nospace(s):
    return [t.strip() for t in re.split(r",(?! )", s) if t.strip()]


@pytest.mark.parametrize("s", SAMPLES)
def test_split_rules_match_python(spark, s):
    df = spark.createDataFrame([(s,)], "s string")
    r = df.select(clean_items(split_plain("s")).alias("a"),
                  clean_items(split_comma_nospace("s")).alias("b")).first()
    assert r.a == py_plain(s)
    assert r.b == py_nospace(s)
    assert len(r.a) >= len(r.b)          # invariant: plain split never gives fewer pieces


def test_strip_matches_python(spark):
    vals = [" a ", "\t\nb\r\f", " c ", "\x1cd\x1f", "e", "   ", "​z"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(strip_ws("s")).collect()]
    assert got == [v.strip() for v in vals]


def test_parse_date_in_any_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("2026-12-31T23:30:00Z",), ("2026-12-31T05:00:00Z",),
                                    ("2032-07-31",), ("junk",), ("",), (None,), ("2032-07-31Tjunk",),
                                    ("2032-07-31 xyz",), ("2032-07-31 10:00:00",), ("2032-13-31",), ("2032",)], "s string")
        got = [r[0] for r in df.select(parse_date("s")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    import datetime as dt
    assert got == [dt.date(2026, 12, 31), dt.date(2026, 12, 31), dt.date(2032, 7, 31), None, None, None,
                   None, None, dt.date(2032, 7, 31), None, None]


def test_numbers(spark):
    from decimal import Decimal
    df = spark.createDataFrame([("1",), ("1.5",), ("2.5",), ("x",), (None,), ("1.005",)], "s string")
    got = df.select(parse_int_number("s").alias("i"), parse_decimal("s").alias("d"),
                    parse_int_id("s").alias("k")).collect()
    assert [r.i for r in got] == [1, 2, 3, None, None, 1]
    assert [r.d for r in got] == [Decimal("1.00"), Decimal("1.50"), Decimal("2.50"), None, None, Decimal("1.01")]
    assert [r.k for r in got] == [1, None, None, None, None, None]
    odd = spark.createDataFrame([(v,) for v in ("3d", "2f", "0x1p3", "1e2", " 7 ", "-.5", "NaN", "Infinity", "99999999999", "1,5")], "s string")
    assert [r.i for r in odd.select(parse_int_number("s").alias("i")).collect()] == [None, None, None, 100, 7, -1, None, None, None, None]


def test_first_nested_value(spark):
    vals = ['{"0":{"docna":"A"}}', '{"0":{"a":"B","b":"C"}}', "plain", '{"1":{"x":"y"}}',
            '{"0":"scalar"}', '{"0":{}}', None]
    records = ["{}" if v is None else '{"f":' + (v if v.startswith("{") else f'"{v}"') + "}" for v in vals]
    records.append(r'''{"f": "{\"0\": {\"a\": \"b\"}}"}''')        # a string, not a map
    df = spark.createDataFrame([(v,) for v in records], "s string")
    got = [r[0] for r in df.select(first_nested_value("s", "f")).collect()]
    assert got == ["A", "B", "plain", '{"1":{"x":"y"}}', '{"0":"scalar"}', '{"0":{}}', None, '{"0": {"a": "b"}}']


def test_percent_complete(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (1, 8), (0, 5), (5, 0), (7, 7), (49, 400), (51, 400)], "l long, t long")
    got = [r[0] for r in df.select(percent_complete("l", "t")).collect()]
    assert got == [33.3, 66.7, 12.5, 0.0, None, 100.0, 12.2, 12.8]
