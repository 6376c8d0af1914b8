"""The silver step: one read of the input, both sides stored, the report counted on the way."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.checks.queries import bronze, text_bronze
from ledgerstar.operators import quality as Q
from ledgerstar.plans.medallion import (bronze_to_silver, read_quarantine, read_report, read_report_detail, read_silver,
                                        read_statistics, split_to_silver, validate, write_report)

SF = "/root/testdata/sf0.001"


def counted(spark, df):
    """``df`` through a function that counts every row it hands on."""
    rows = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), rows


@pytest.fixture()
def stored(spark, wh):
    path = f"{wh.root}/bronze"
    bronze(spark, SF).withColumn("tx_tp", F.concat(F.lit("t"), "booking_id")).write.parquet(path)
    return spark.read.parquet(path)


def test_the_input_is_read_once(spark, wh, stored):
    total = stored.count()
    rows, seen = counted(spark, stored)
    silver = split_to_silver(rows, f"{wh.root}/silver")
    assert seen.value == total
    assert silver.clean.count() + silver.quarantine.count() == total and silver.quarantine.count() > 0
    want = {r.rule: r for r in Q.evaluate_suite(stored, Q.DEFAULT_SUITE).collect()}
    assert {r.rule: r for r in silver.report.collect()} == want
    assert seen.value == total


def test_both_sides_equal_the_split(spark, wh, stored):
    path = f"{wh.root}/silver"
    silver = split_to_silver(stored, path)
    good, bad = Q.split_rows(stored, Q.DEFAULT_SUITE)
    for got, want in ((silver.clean, Q.clean_rows(stored)), (silver.quarantine, bad), (read_silver(spark, path), Q.clean_rows(stored)), (read_quarantine(spark, path).select(bad.columns), bad)):
        assert got.columns == want.columns or set(got.columns) >= set(want.columns)
        got = got.select(want.columns)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert good.count() == silver.clean.count() and silver.clean.filter("tx_tp IS NOT NULL").isEmpty()
    assert silver.quarantine.filter("tx_tp IS NULL").isEmpty()  # quarantined rows keep what they came with


def test_the_writer_setting_is_put_back(spark, wh, stored):
    from ledgerstar.plans.medallion import OPEN_WRITERS

    before = spark.conf.get(OPEN_WRITERS)
    split_to_silver(stored, f"{wh.root}/silver")
    assert spark.conf.get(OPEN_WRITERS) == before


def test_a_passing_input_stays_as_it_is(spark, wh, stored):
    good, _ = Q.split_rows(stored, Q.DEFAULT_SUITE)
    silver = split_to_silver(good, f"{wh.root}/silver")
    assert silver.clean.columns == good.columns and silver.quarantine.isEmpty()
    assert silver.clean.exceptAll(good).isEmpty() and silver.clean.count() == good.count()
    plain, seen = counted(spark, good.drop("tx_tp"))  # no free text: nothing to write again
    assert split_to_silver(plain, f"{wh.root}/plain").clean.columns == plain.columns
    assert seen.value == good.count()
    assert split_to_silver(good, f"{wh.root}/always", always_clean=True).clean.filter("tx_tp IS NOT NULL").isEmpty()


def test_raw_values_of_failed_casts_are_kept_in_quarantine(spark, wh):
    path = f"{wh.root}/silver"
    silver = split_to_silver(text_bronze(spark, SF), path)
    bad = silver.quarantine.filter(F.col("failed_rules").contains("bookg_amt_parses"))
    assert bad.count() > 0 and bad.filter("_raw_bookg_amt LIKE '%,%'").count() == bad.count()
    assert not [c for c in read_silver(spark, path).columns if c.startswith("_raw_") or c == "failed_rules"]


def test_a_stored_report_decides(spark, wh, stored):
    path = f"{wh.root}/report.json"
    assert not validate(stored, result_path=path).success
    got = bronze_to_silver(stored, f"{wh.root}/silver", result_path=path)
    assert got.count() == Q.clean_rows(stored).count()
    failed = {r.rule for r in read_report(spark, path).filter("NOT success").collect()}
    names = read_quarantine(spark, f"{wh.root}/silver").select(F.explode(F.split("failed_rules", ",")).alias("n")).distinct()
    assert {r.n for r in names.collect()} == failed
    good, _ = Q.split_rows(stored, Q.DEFAULT_SUITE)
    validate(good, result_path=path)
    copied = bronze_to_silver(good, f"{wh.root}/copied", result_path=path)
    assert copied.columns == good.columns and copied.exceptAll(good).isEmpty()


def test_empty_input_and_missing_columns(spark, wh, stored):
    path = f"{wh.root}/silver"
    silver = split_to_silver(stored.limit(0), path)
    assert silver.clean.count() == silver.quarantine.count() == 0 and read_silver(spark, path).count() == 0
    assert {r.unexpected_percent for r in silver.report.collect()} == {None}
    with pytest.raises(ValueError):
        split_to_silver(stored.drop("acct_ccy"), path)


def test_report_document(spark, wh, stored):
    path = f"{wh.root}/doc.json"
    report = Q.evaluate_suite(stored, Q.DEFAULT_SUITE)
    write_report(report, path)
    document = spark.read.json(path)
    assert document.columns == ["results", "statistics", "success"] and document.count() == 1
    stats = read_statistics(spark, path).first()
    assert (stats.evaluated_expectations, stats.successful_expectations + stats.unsuccessful_expectations) == (5, 5)
    assert stats.success_percent == stats.successful_expectations * 100.0 / 5
    detail = {r.rule: r for r in read_report_detail(spark, path).collect()}
    currency = detail["currency_known"]
    assert currency.missing_percent == currency.missing_count * 100.0 / currency.element_count
    assert currency.unexpected_percent_total < currency.unexpected_percent_nonmissing == currency.unexpected_percent
    assert read_report(spark, path).schema.names == report.columns


def test_stream_keeps_its_quarantine(spark, wh, stored):
    from ledgerstar.streaming.ingest import ingest_bronze, read_quarantine as stream_quarantine, read_silver as stream_silver

    landing = f"{wh.root}/landing"
    stored.repartition(3, "booking_id").write.parquet(landing)
    ingest_bronze(spark, landing, f"{wh.root}/out", f"{wh.root}/reports", f"{wh.root}/_check", max_files_per_trigger=1).awaitTermination()
    good, bad = Q.split_rows(stored, Q.DEFAULT_SUITE)
    assert stream_silver(spark, f"{wh.root}/out").count() == good.count()
    got = stream_quarantine(spark, f"{wh.root}/out").select(bad.columns)
    assert got.exceptAll(bad).isEmpty() and got.count() == bad.count()
    reports = spark.read.schema(T.StructType.fromDDL("statistics struct<evaluated_expectations: bigint>")).json(f"{wh.root}/reports")
    assert {r[0].evaluated_expectations for r in reports.select("statistics").collect()} == {5}
