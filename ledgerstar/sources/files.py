"""Readers: parquet (file or glob), CSV, JSON reports, catalog tables.

Parquet reads take no CSV options (they would be ignored); CSV reads take an
explicit schema, so there is no inference pass over the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# RFC 4180 style: header row, comma, '"' quotes, '""' escapes a quote inside
# a quoted field, quoted fields may span lines.
CSV_OPTIONS = {"header": "true", "sep": ",", "quote": '"', "escape": '"', "multiLine": "true"}


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One parquet file, a folder, or a glob such as ``dir/*.parquet``."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)


def with_stored_rank(df: DataFrame, name: str) -> DataFrame:
    """A stored table with each row's rank, from 1, in the order in which the rows are stored.

    Files follow each other by name (a writer's tasks number them), rows by their place in the file. One count per
    file passes through the driver, which lists the files anyway.
    """
    placed = df.select("*", F.col("_metadata.file_name").alias("_ls_file"), F.col("_metadata.row_index").alias("_ls_at"))
    sizes = placed.groupBy("_ls_file").agg(F.count(F.lit(1)).alias("n")).collect()
    starts, start = [], 0
    for file, n in sorted((r["_ls_file"], r["n"]) for r in sizes):
        starts.append((file, start))
        start += n
    offsets = df.sparkSession.createDataFrame(starts, "_ls_file string, _ls_start bigint")
    ranked = placed.join(F.broadcast(offsets), "_ls_file").withColumn(name, F.col("_ls_start") + F.col("_ls_at") + 1)
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], name)


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             options: dict[str, str] | None = None) -> DataFrame:
    return spark.read.schema(schema).options(**{**CSV_OPTIONS, **(options or {})}).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table (or temp view) by name."""
    return spark.table(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)
