"""Sinks: parquet folders, external catalog tables, JSON reports.

Appends always resolve columns **by name** against the target table, never
by position, so a projection in a different column order cannot silently
store an amount in an id column.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.schemas import ddl
from ledgerstar.session import fresh_folder, shared_root


def overwrite_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def store(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` into a fresh folder of the shared storage and read it back: cuts lineage, survives lost executors."""
    path = fresh_folder(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def overwrite_table(df: DataFrame, name: str, path: str) -> None:
    """Replace an external (path-backed) parquet catalog table."""
    df.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)


def create_table_if_absent(spark: SparkSession, name: str, schema: T.StructType,
                           location: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(schema)}) USING parquet LOCATION '{location}'")


def align_to_table(df: DataFrame, target: DataFrame) -> DataFrame:
    """Select ``df``'s columns by name in the target's order and types.

    Fails when a target column is missing or ``df`` has columns the target
    lacks; casts are ANSI (an id out of INT range fails instead of wrapping).
    """
    missing = [c for c in target.columns if c not in df.columns]
    extra = [c for c in df.columns if c not in target.columns]
    if missing or extra:
        raise ValueError(f"column mismatch: missing {missing}, unexpected {extra}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])


def append_by_name(df: DataFrame, table: str) -> None:
    spark = df.sparkSession
    align_to_table(df, spark.table(table)).write.mode("append").format("parquet").saveAsTable(table)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


@dataclass(frozen=True)
class Warehouse:
    """Where the silver and gold layers live: folders plus catalog databases.

    ``Warehouse.default`` uses databases ``silver`` and ``gold`` under the
    shared root; ``Warehouse.fresh`` gives an isolated copy (tests, checks).
    """

    spark: SparkSession
    root: str
    prefix: str = ""

    @classmethod
    def default(cls, spark: SparkSession) -> "Warehouse":
        return cls(spark, f"{shared_root(spark)}/ledgerstar/warehouse")

    @classmethod
    def fresh(cls, spark: SparkSession, tag: str = "wh") -> "Warehouse":
        return cls(spark, fresh_folder(spark, tag), f"ls{uuid.uuid4().hex[:10]}_")

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.database(layer)}.{name}"

    def location(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def attach(self, layer: str, name: str) -> str:
        """Register an existing table folder in the catalog (schema from its files)."""
        self.ensure_database(layer)
        table = self.table(layer, name)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION '{self.location(layer, name)}'")
        return table

    def ensure_database(self, layer: str) -> str:
        db = self.database(layer)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{self.root}/{layer}'")
        return db
