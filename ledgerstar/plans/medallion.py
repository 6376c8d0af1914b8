"""Bronze to gold in one call: validate, clean, stage, load the star schema.

The silver step reads its input once. One job writes every row, clean ones and
quarantined ones into partitions of one folder, and counts what the report
needs on the way (observed metrics of the writing pass).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar import schemas
from ledgerstar.constants import BLANKED_COLUMNS
from ledgerstar.functions.columns import typed_null
from ledgerstar.operators.quality import (DEFAULT_SUITE, RAW_PREFIX, Rule, active_rules, check_suite,
                                          clean_rows, conform_with_checks, drop_raw, evaluate_suite, failed_rule_names,
                                          report_detail, report_from_counts, suite_counts, suite_statistics,
                                          suite_summary, violation_flag)
from ledgerstar.plans.gold import load_gold
from ledgerstar.plans.staging import write_staging
from ledgerstar.session import shared_root
from ledgerstar.sinks import Warehouse, write_json
from ledgerstar.sources.files import read_json

QUARANTINED = "quarantined"
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def write_report(report: DataFrame, path: str) -> None:
    """Store a report as one JSON document ``{"success": ..., "statistics": {...}, "results": [...]}``.

    The results array has one entry per rule (a bounded list), with every
    percentage, sorted by rule name so the document is the same on every run.
    """
    detail, totals = report_detail(report), suite_statistics(report)
    results = detail.agg(F.bool_and("success").alias("success"),
                         F.array_sort(F.collect_list(F.struct(*detail.columns))).alias("results"))
    doc = results.crossJoin(totals.select(F.struct(*totals.columns).alias("statistics")))  # one row each
    write_json(doc.select("success", "statistics", "results"), path)  # one row, one partition, one file


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The per-rule rows of a stored report document."""
    schema = T.StructType([T.StructField("success", T.BooleanType()),
                           T.StructField("results", T.ArrayType(schemas.VALIDATION_REPORT))])
    return read_json(spark, path, schema).select(F.inline("results"))


def read_report_detail(spark: SparkSession, path: str) -> DataFrame:
    """The per-rule rows of a stored report with every percentage."""
    schema = T.StructType([T.StructField("results", T.ArrayType(schemas.VALIDATION_DETAIL))])
    return read_json(spark, path, schema).select(F.inline("results"))


def read_statistics(spark: SparkSession, path: str) -> DataFrame:
    """The statistics block of a stored report: one row."""
    schema = T.StructType([T.StructField("statistics", schemas.VALIDATION_STATISTICS)])
    return read_json(spark, path, schema).select("statistics.*")


@dataclass
class Validation:
    success: bool
    report: DataFrame
    result_path: str | None


def validate(bronze: DataFrame, rules: Sequence[Rule] = DEFAULT_SUITE,
             result_path: str | None = None) -> Validation:
    """Evaluate the suite; optionally store the report as JSON at ``result_path``.

    Raw columns of an unexpected type are cast at this boundary; a value that
    does not cast is reported by a ``<column>_parses`` rule.
    """
    conformed, cast_rules = conform_with_checks(bronze, schemas.BRONZE_TYPES)
    report = evaluate_suite(conformed, [*cast_rules, *rules])
    if result_path:
        write_report(report, result_path)
        report = read_report(bronze.sparkSession, result_path)
    else:
        # One row per rule: store it so the data is scanned once, not once
        # for the success flag and again by whoever reads the report.
        shared_root(bronze.sparkSession)
        report = report.checkpoint(eager=True)
    success = suite_summary(report).first()["success"]
    return Validation(bool(success), report, result_path)


@dataclass
class Silver:
    clean: DataFrame
    quarantine: DataFrame
    report: DataFrame


def split_to_silver(bronze: DataFrame, silver_path: str, rules: Sequence[Rule] = DEFAULT_SUITE,
                    decided: bool = False, always_clean: bool = False) -> Silver:
    """Write clean and quarantined rows in one job and report what the rules found in the same pass.

    ``silver_path`` holds two partitions, ``quarantined=false`` (``read_silver``) and ``quarantined=true`` (the rows
    as they came, raw values of casts included, with ``failed_rules``). Free-text columns of clean rows are blank
    unless every rule passed; an input that passes and holds free text is copied once more, unchanged. With
    ``decided`` the rules given are known to have failed (none given: every row stays), whatever this pass counts;
    with ``always_clean`` free text goes in any case.
    """
    spark = bronze.sparkSession
    conformed, cast_rules = conform_with_checks(bronze, schemas.BRONZE_TYPES)
    suite = list(rules) if decided else [*cast_rules, *rules]
    if suite:
        check_suite(conformed, suite)
    flag = violation_flag(suite) if suite else F.lit(False)
    raw = [c for c in conformed.columns if c.startswith(RAW_PREFIX)]
    given = [c for c in conformed.columns if c not in raw]
    free_text = [c for c in BLANKED_COLUMNS if c in given]
    blank = bool(suite)
    only_flagged = {**{c: F.col(f"`{c}`") for c in raw},
                    **{c: F.col(f"`{c}`").cast("string") for c in free_text if blank}}
    # The counts are observed on the input rows, in the writing stage itself: nothing is shuffled in between.
    seen = Observation(f"silver-{uuid.uuid4().hex[:8]}")
    texts = [F.count(f"`{c}`").alias(f"_ls_text{i}") for i, c in enumerate(free_text)]
    counts = [*(suite_counts(suite) if suite else [F.count(F.lit(1)).alias("_ls_n")]), *texts]
    rows = conformed.observe(seen, *counts).withColumn(QUARANTINED, F.when(flag, "true").otherwise("false"))
    bad = F.col(QUARANTINED) == "true"
    out = rows.select(
        *[F.when(bad, only_flagged[c]).alias(c) if c in only_flagged else F.col(f"`{c}`") for c in [*given, *raw]],
        *([typed_null().alias(c) for c in BLANKED_COLUMNS if c not in given] if blank else []),
        (F.when(bad, failed_rule_names(suite)) if suite else typed_null()).alias("failed_rules"), QUARANTINED)
    _write_partitions(out, silver_path)
    found = seen.get
    passed = bool(suite) and not any(found[f"_ls_u{i}"] for i in range(len(suite)))
    clean = [c for c in out.columns if c not in (*raw, "failed_rules", QUARANTINED)]
    if passed and not decided and not always_clean:
        clean = given
        if any(found[t] for t in (f"_ls_text{i}" for i in range(len(free_text)))):
            out = conformed.select(*[f"`{c}`" for c in given]).withColumns({"failed_rules": typed_null(), QUARANTINED: F.lit("false")})
            _write_partitions(out, silver_path)
    if not found["_ls_n"]:  # no row, no file: keep the columns on record
        out.limit(0).drop(QUARANTINED).write.mode("overwrite").parquet(f"{silver_path}/{QUARANTINED}=false")
    stored = spark.read.schema(out.schema).parquet(silver_path)
    report = report_from_counts(spark, found, suite) if suite else spark.createDataFrame([], schemas.VALIDATION_REPORT)
    return Silver(stored.filter(F.col(QUARANTINED) == "false").select(*[f"`{c}`" for c in clean]),
                  stored.filter(F.col(QUARANTINED) == "true").select(*[f"`{c}`" for c in given], *[c for c in raw if c in stored.columns], "failed_rules"),
                  report)


def bronze_to_silver(bronze: DataFrame, silver_path: str, rules: Sequence[Rule] = DEFAULT_SUITE,
                     result_path: str | None = None, report_path: str | None = None) -> DataFrame:
    """Write silver: rows unchanged when every rule passes, else cleaned rows; quarantined rows beside them.

    Whether rules failed is read from the report at ``result_path``, or found out while the rows are written (the
    report of that pass is stored at ``report_path``, if given). Returns the clean rows.
    """
    if result_path is not None:
        conformed, cast_rules = conform_with_checks(bronze, schemas.BRONZE_TYPES)
        failed = active_rules(read_report(bronze.sparkSession, result_path), [*cast_rules, *rules])
        return split_to_silver(bronze, silver_path, failed, decided=True).clean
    silver = split_to_silver(bronze, silver_path, rules)
    if report_path is not None:
        write_report(silver.report, report_path)
    return silver.clean


def _write_partitions(out: DataFrame, path: str) -> None:
    """Partitioned write without a sort: a task keeps both files open."""
    spark = out.sparkSession
    before = spark.conf.get(OPEN_WRITERS, None)
    spark.conf.set(OPEN_WRITERS, "4")
    try:
        out.write.mode("overwrite").partitionBy(QUARANTINED).parquet(path)
    finally:
        spark.conf.unset(OPEN_WRITERS) if before is None else spark.conf.set(OPEN_WRITERS, before)


def read_silver(spark: SparkSession, silver_path: str) -> DataFrame:
    """The clean rows of a silver folder."""
    rows = spark.read.option("basePath", silver_path).parquet(silver_path)
    if QUARANTINED not in rows.columns:
        return rows
    kept = [c for c in rows.columns if not c.startswith(RAW_PREFIX) and c not in (QUARANTINED, "failed_rules")]
    return rows.filter(F.col(QUARANTINED).cast("string") == "false").select(*[f"`{c}`" for c in kept])


def read_quarantine(spark: SparkSession, silver_path: str) -> DataFrame:
    """The quarantined rows of a silver folder, with the names of the rules they break."""
    rows = spark.read.option("basePath", silver_path).parquet(silver_path)
    return rows.filter(F.col(QUARANTINED).cast("string") == "true").drop(QUARANTINED)


def run_medallion(spark: SparkSession, bronze: DataFrame, categories: DataFrame, rates: DataFrame,
                  wh: Warehouse, rules: Sequence[Rule] = DEFAULT_SUITE,
                  result_path: str | None = None) -> dict[str, int]:
    """Full batch: silver parquet, five staging tables, gold merge and fact append."""
    silver = bronze_to_silver(bronze, f"{wh.root}/silver/staging_parquet", rules, result_path,
                              f"{wh.root}/reports/silver_validation.json")
    names = write_staging(wh, silver, categories, rates)
    return load_gold(wh, names)


def clean_from_report(bronze: DataFrame, result_path: str, rules: Sequence[Rule] = DEFAULT_SUITE) -> DataFrame:
    """Silver rows as decided by a stored report: the rules it marks as failed
    are applied as filters (rules that passed cannot remove rows). A report
    with no failure gives every row back unchanged."""
    report = read_report(bronze.sparkSession, result_path)
    conformed, cast_rules = conform_with_checks(bronze, schemas.BRONZE_TYPES)
    failed = active_rules(report, [*cast_rules, *rules])
    return drop_raw(clean_rows(conformed, failed)) if failed else drop_raw(conformed)
