"""Bronze derivation and data-quality rules (expected counts from FIXTURES.md)."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF01
from ledgerstar.checks import queries as QQ
from ledgerstar.operators import quality as Q


@pytest.fixture(scope="module")
def bronze(spark):
    return QQ.bronze(spark, SF01).cache()


def test_bronze_counts_match_fixture_doc(bronze):
    agg = bronze.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("bookg_amt") < 0).alias("neg"),
        F.count_if(F.col("bookg_amt_nmrc") < 0).alias("neg_cents"),
        F.sum("bookg_amt_nmrc").alias("cents"),
        F.count_if(F.col("acct_ccy") == "CHF").alias("bad_ccy"),
        F.count_if(F.col("acct_ccy").isNull()).alias("null_ccy"),
        F.count_if(F.col("bookg_dt_tm_cet").isNull()).alias("null_cet"),
        F.count_if(F.col("bookg_dt_tm_gmt").isNull()).alias("null_gmt"),
        F.count_if(F.col("dtld_tx_tp") == 9999).alias("unknown_code"),
    ).first()
    assert agg.asDict() == dict(rows=60000, neg=427, neg_cents=427, cents=313775488059, bad_ccy=8662,
                                null_ccy=8598, null_cet=1202, null_gmt=1170, unknown_code=1244)


def test_suite_report_and_split(bronze):
    report = {r["rule"]: r for r in Q.evaluate_suite(bronze, Q.DEFAULT_SUITE).collect()}
    assert report["currency_known"]["missing_count"] == 8598
    assert report["currency_known"]["unexpected_count"] == 8662
    assert report["currency_known"]["unexpected_percent"] == pytest.approx(8662 * 100 / (60000 - 8598))
    assert report["booked_cet_present"]["unexpected_percent"] == pytest.approx(1202 * 100 / 60000)
    assert not any(r["success"] for r in report.values())
    good, bad = Q.split_rows(bronze, Q.DEFAULT_SUITE)
    assert (good.count(), bad.count()) == (48947, 11053)
    # report counts equal the quarantine counts per rule
    per_rule = {r["rule"]: r["n"] for r in bad.select(F.explode(F.split("failed_rules", ",")).alias("rule"))
                .groupBy("rule").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per_rule == {k: v["unexpected_count"] for k, v in report.items()}


def test_category_rule_is_defined_but_not_in_default_suite(bronze):
    assert Q.CATEGORY_KNOWN not in Q.DEFAULT_SUITE
    [row] = Q.evaluate_suite(bronze, [Q.CATEGORY_KNOWN]).collect()
    assert row["unexpected_count"] == 1244


SCHEMA = T.StructType([T.StructField("amt", T.DoubleType()), T.StructField("ccy", T.StringType()),
                       T.StructField("ts", T.StringType())])
RULES = [Q.Between("amt_min", "amt", min_value=0), Q.InSet("ccy_set", "ccy", ("EUR", "USD")),
         Q.NotNull("ts_present", "ts")]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.floats(-5, 5, allow_nan=False)),
                          st.one_of(st.none(), st.sampled_from(["EUR", "USD", "CHF"])),
                          st.one_of(st.none(), st.just("2024-01-01"))), max_size=25))
def test_split_is_complete_and_report_agrees(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    good, bad = Q.split_rows(df, RULES)
    assert good.count() + bad.count() == len(rows)
    expected_bad = sum(1 for a, c, t in rows
                       if (a is not None and a < 0) or (c is not None and c not in ("EUR", "USD")) or t is None)
    assert bad.count() == expected_bad
    report = {r["rule"]: r for r in Q.evaluate_suite(df, RULES).collect()}
    assert report["amt_min"]["missing_count"] == sum(1 for a, _, _ in rows if a is None)
    assert report["ts_present"]["missing_count"] == 0
    assert report["ccy_set"]["unexpected_count"] == sum(1 for _, c, _ in rows if c == "CHF")
    if all(a is None for a, _, _ in rows):
        assert report["amt_min"]["unexpected_percent"] is None


def test_bad_casts_are_quarantined_not_fatal(spark):
    """Raw strings that do not parse become violations, not job failures."""
    from ledgerstar.functions.columns import conform

    raw = spark.createDataFrame([("2024-01-02 10:00:00", "5411"), ("31/02/2024", "x9"), (None, None)],
                                "bookg_dt_tm_cet string, dtld_tx_tp string")
    rules = [Q.Castable("cet_parses", "bookg_dt_tm_cet", "timestamp_ntz"),
             Q.Castable("code_parses", "dtld_tx_tp", "int")]
    _, bad = Q.split_rows(raw, rules)
    assert [r["failed_rules"] for r in bad.collect()] == ["cet_parses,code_parses"]
    typed = conform(raw, {"bookg_dt_tm_cet": T.TimestampNTZType(), "dtld_tx_tp": T.IntegerType()})
    assert [r["dtld_tx_tp"] for r in typed.collect()] == [5411, None, None]


def test_unexpected_values_lists_every_value(bronze):
    uv = Q.unexpected_values(bronze, [Q.CURRENCY_KNOWN])
    assert [(r["value"], r["unexpected_n"]) for r in uv.collect()] == [("CHF", 8662)]


def test_report_path_rule():
    assert Q.report_path_for("raw_2024_bronze.parquet", "/cfg") == "/cfg/raw_2024__validation.json"


def test_string_typed_bronze_is_validated_not_fatal(spark, wh):
    """H13 end to end: text columns with malformed values reach quarantine."""
    from ledgerstar.plans.medallion import bronze_to_silver, validate

    typed = QQ.bronze(spark, "/root/testdata/sf0.001")
    raw = typed.select(*[F.col(c).cast("string").alias(c) for c in typed.columns])
    broken = raw.limit(3).withColumn("bookg_amt", F.lit("12,50")).withColumn("bookg_dt_tm_cet", F.lit("31-02-2024"))
    bronze = raw.unionByName(broken)
    v = validate(bronze)
    report = {r["rule"]: r["unexpected_count"] for r in v.report.collect()}
    assert report["bookg_amt_parses"] == 3 and report["bookg_dt_tm_cet_parses"] == 3
    silver = bronze_to_silver(bronze, f"{wh.root}/silver")
    assert silver.count() == Q.clean_rows(typed).count()
    assert dict(silver.dtypes)["bookg_amt"] == "double" and not any(c.startswith("_raw_") for c in silver.columns)
