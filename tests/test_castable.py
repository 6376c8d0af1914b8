"""A cast is a finding when it changes the value, compared in the type the value comes in."""

from decimal import Decimal

import pytest

from ledgerstar.operators.quality import Castable, _finer_decimal

NAN = float("nan")


def findings(spark, source, target, values, ansi="true"):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, raw {source}")
        rows = df.select("k", Castable("r", "raw", target, source).violation().alias("bad")).collect()
        return [r.bad for r in sorted(rows)]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("source, target, kept, lost", [
    ("float", "double", [0.1, -34271.02, 3.4e38, NAN, float("inf"), None], []),
    ("int", "double", [2**31 - 1, -(2**31), 0], []),
    ("smallint", "float", [32767, -32768], []),
    ("int", "float", [2**24, 2**24 + 2], [2**24 + 1]),
    ("bigint", "double", [2**53, 2**53 + 2, -(2**53), 2**62], [2**53 + 1, 2**63 - 1, -(2**53) - 1]),
    ("double", "bigint", [12.0, -0.0, 9007199254740992.0], [12.7, 1e19, NAN, float("inf")]),
    ("double", "float", [0.5, 3.0, NAN], [0.1, 1e300]),
    ("bigint", "int", [2**31 - 1], [2**31]),
    ("decimal(38,18)", "double", [Decimal("12.34"), Decimal("-0.1"), Decimal(0)], [Decimal("12.340000000000000001"), Decimal("12345678901234567.8")]),
    ("decimal(10,2)", "bigint", [Decimal("12.00")], [Decimal("12.01")]),
    ("double", "decimal(10,2)", [12.34, -1.0], [12.345, 1e9]),
    ("string", "bigint", ["12", "-7", "9007199254740993"], ["12.5", "x", "", "1e30"]),
    ("string", "double", ["0.1", "1e5", "-3"], ["12,5", "abc"]),
    ("string", "float", ["0.1", "34271.02"], ["abc"]),
    ("string", "decimal(10,2)", ["1.25", "3"], ["1.255", "1e12"]),
    ("double", "string", [0.1, NAN], []),
    ("boolean", "int", [True, False], []),
])
def test_only_changed_values_are_findings(spark, source, target, kept, lost, ansi):
    got = findings(spark, source, target, [*kept, *lost], ansi)
    assert got == [False] * len(kept) + [True] * len(lost)


def test_finer_decimal():
    assert _finer_decimal("int") == "decimal(38,18)" and _finer_decimal("decimal(10,2)") == "decimal(38,30)"


def test_float_bronze_stays(spark):
    from ledgerstar.checks.queries import typed_bronze_clean, typed_bronze_report

    report = {(r.kind, r.rule): r for r in typed_bronze_report(spark, "/root/testdata/sf0.001").collect()}
    assert report["float", "bookg_amt_parses"].unexpected_count == 0
    for kind, column in (("float", "bookg_amt_nmrc"), ("decimal", "bookg_amt"), ("bigint", "bookg_amt")):
        r = report[kind, f"{column}_parses"]
        assert 0 < r.unexpected_count < r.element_count // 5
    kept = {r.kind: r["count"] for r in typed_bronze_clean(spark, "/root/testdata/sf0.001").groupBy("kind").count().collect()}
    assert min(kept.values()) > report["float", "bookg_amt_parses"].element_count // 3
