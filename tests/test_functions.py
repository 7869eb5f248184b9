"""Column functions against the goldens (period, month, number, flow)."""

import pytest
from pyspark.sql import functions as F

from tierlake.functions.flows import is_export, is_import, is_production, matches
from tierlake.functions.periods import month_to_int, period_struct, year_to_int
from tierlake.functions.text import blank_to_null, parse_number, upper_text

PERIODS = {
    "2023-06": (2023, 6), "2023-6": (2023, 6), "2023/06": (2023, 6), "2023.06": (2023, 6),
    "2023 06": (2023, 6), " 2023-07 ": (2023, 7), "202306": (2023, 6), "20236": (2023, 6),
    "2023M06": (2023, 6), "202312": (2023, 12), "202313": None, "2023-06-15": (2023, 6),
    "2023/6/5": (2023, 6), "2023-06-15 10:00:00": (2023, 6), "2023-06-15T10:00:00.123Z": (2023, 6),
    "2023-13-01": None, "2023-02-30": None, "Jun 2023": (2023, 6), "JUN 2023": (2023, 6),
    "June 2023": (2023, 6), "2023 Jun": (2023, 6), "2023 June": (2023, 6), "Jun-2023": None,
    "Jun/2023": None, "2023.1": (2023, 1), "15/06/2023": None, "06-2023": None, "06/2023": None,
    "20230615": None, "1899-05": None, "": None, "Q2 2023": None, "Sept 2023": None,
    "2024-02-29": (2024, 2), "2023-02-29": None, "1995-1-2": (1995, 1),
}


def _eval(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_periods(spark):
    keys = list(PERIODS) + [None]
    got = _eval(spark, keys, period_struct)
    for k, g in zip(keys, got):
        exp = PERIODS.get(k)
        assert (None if g is None else (g["year"], g["month"])) == exp, k


def test_month_to_int(spark):
    vals = ["JAN", " january ", "Sept", "07", "6.0", "foo", "0", "13", "dec", None]
    assert _eval(spark, vals, month_to_int) == [1, 1, 9, 7, None, None, 0, 13, 12, None]


def test_year_to_int(spark):
    assert _eval(spark, ["2023", " 2023 ", "2023.0", "x", None, ""], year_to_int) == [2023, 2023, 2023, None, None, None]


def test_parse_number(spark):
    vals = ["1,234", " 12.5 ", "-3", "1e3", "-", "", "x", "(3)", "NaN", "Infinity", "12d", None, ".5", "+7."]
    assert _eval(spark, vals, parse_number) == [1234.0, 12.5, -3.0, 1000.0, None, None, None, None, None, None,
                                                None, None, 0.5, 7.0]


def test_text(spark):
    assert _eval(spark, ["  a b ", "", "   ", None], blank_to_null) == ["a b", None, None, None]
    assert _eval(spark, [" imports ", ""], upper_text) == ["IMPORTS", None]


FLOWS = {
    "Production": (True, False, False), "Products transferred": (True, False, False),
    "Imports": (False, True, False), "Implied demand": (False, True, False), "SIMPLE BLEND": (False, True, False),
    "Exports": (False, False, True), "Expected stock": (False, False, True),
    "Import/Export balance": (False, True, True), "Refinery output": (False, False, False),
}


def test_flows(spark):
    df = spark.createDataFrame([(k,) for k in FLOWS], "flow string").select("flow", upper_text("flow").alias("u"))
    rows = df.select("flow", is_production("u"), is_import("u"), is_export("u")).collect()
    for r in rows:
        assert tuple(r[1:]) == FLOWS[r[0]], r[0]


@pytest.mark.parametrize("pattern", ["PROD|PRODUCTION", "IMPORT|IMP", "EXPORT|EXP", "^IMP.*", "X|Y"])
def test_literal_alternation_equals_rlike(spark, pattern):
    df = spark.createDataFrame([(k.upper(),) for k in FLOWS] + [(None,)], "u string")
    a = df.select(matches("u", pattern).alias("m")).collect()
    b = df.select(F.col("u").rlike(pattern).alias("m")).collect()
    assert a == b


def test_is_number_matches_parse(spark):
    from tierlake.functions.text import is_number
    vals = ["1,234", " 12.5 ", "-3", "1e3", "-", "", "x", "(3)", "NaN", "Infinity", "12d", None, ".5", "+7.", "1e400"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    rows = df.select(is_number("v").alias("a"), parse_number("v").isNotNull().alias("b")).collect()
    assert all(r["a"] == r["b"] for r in rows)
