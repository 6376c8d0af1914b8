"""Counts and extremes of stored tables from their Parquet footers.

Spark's second file reader can answer ``count``, ``min`` and ``max`` from the
footers alone (``PushedAggregation`` in the plan): no column is read. The
catalog's tables use the first reader, so the table's folder is opened again.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

_FIRST_READER = "spark.sql.sources.useV1SourceList"
_PUSHDOWN = "spark.sql.parquet.aggregatePushdown"  # only the second reader looks at it
_ONE_AT_A_TIME = threading.Lock()


def from_footers(spark: SparkSession, table: str) -> DataFrame:
    """A stored Parquet table, read so that counts and extremes come from its footers.

    A table without files yet is returned as the catalog has it. An extreme of a column that is NULL throughout a
    file fails (its footer has none); ``operators.keys.stored_max_id`` looks for that first.
    """
    known = spark.table(table)
    if not known.inputFiles():
        return known
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    location = described.filter("col_name = 'Location'").first()["data_type"]
    spark.conf.set(_PUSHDOWN, "true")
    with _ONE_AT_A_TIME:  # dimensions are loaded from several threads: the setting has to come back as it was
        before = spark.conf.get(_FIRST_READER)
        spark.conf.set(_FIRST_READER, ",".join(s for s in before.split(",") if s.strip() != "parquet"))
        try:
            return spark.read.schema(known.schema).parquet(location)
        finally:
            spark.conf.set(_FIRST_READER, before)
