"""Bronze files to silver parquet, incrementally.

The batch pipeline validates and cleans one landed file per run. Here a
parquet file source picks up every file not yet processed (tracked in the
stream's checkpoint), and ``foreachBatch`` runs the same one-pass validation
and predicate split on each micro-batch. ``trigger(availableNow=True)``
processes what has landed and stops, so it can run on a schedule; without it
the stream keeps running.

Each micro-batch overwrites its own folders (``stream=<id>/batch_id=<n>``) for
silver rows and the report, so a batch replayed after a failure replaces its
earlier output instead of duplicating it. The id belongs to the stream's
checkpoint: if that is lost, the stream takes all files again under a new id and
leaves the older output alone; ``read_silver`` takes one stream or all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerstar.operators.quality import DEFAULT_SUITE, RAW_PREFIX, Rule
from ledgerstar.plans.medallion import QUARANTINED, split_to_silver, write_report
from ledgerstar.sources.reconcile import read_reconciled


def ingest_bronze(spark: SparkSession, bronze_dir: str, silver_dir: str, report_dir: str,
                  checkpoint_location: str, rules: Sequence[Rule] = DEFAULT_SUITE,
                  schema: T.StructType | None = None, max_files_per_trigger: int = 1000,
                  available_now: bool = True) -> StreamingQuery:
    """Start the ingestion stream; returns the running query.

    ``schema`` defaults to that of the files landed so far, which may differ:
    every column of any of them is kept, types are widened, and a column of
    another type than expected is cast and checked as in the batch steps.
    """
    rules = list(rules)
    if schema is None:
        landed = read_reconciled(spark, bronze_dir)
        if landed.conflicts:
            raise ValueError(f"landed files disagree on the type of {landed.conflicts}: pass a schema or read them in batches")
        schema = landed.schema

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        stream_id = spark.read.schema("id string").json(f"{checkpoint_location}/metadata").filter("id IS NOT NULL").first()["id"]
        folder = f"stream={stream_id}/batch_id={batch_id}"
        silver = split_to_silver(batch, f"{silver_dir}/{folder}", rules, always_clean=True)  # reads the batch once
        write_report(silver.report, f"{report_dir}/{folder}")

    stream = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(bronze_dir))
    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def _rows(spark: SparkSession, silver_dir: str, stream: str | None, quarantined: bool) -> DataFrame:
    rows = spark.read.parquet(silver_dir)
    rows = rows.filter(F.col(QUARANTINED).cast("string") == str(quarantined).lower())
    return (rows if stream is None else rows.filter(F.col("stream") == stream)).drop("stream", "batch_id", QUARANTINED)


def read_silver(spark: SparkSession, silver_dir: str, stream: str | None = None) -> DataFrame:
    """Silver rows written by one stream, or by all (without the folder columns)."""
    rows = _rows(spark, silver_dir, stream, False)
    return rows.drop("failed_rules", *[c for c in rows.columns if c.startswith(RAW_PREFIX)])


def read_quarantine(spark: SparkSession, silver_dir: str, stream: str | None = None) -> DataFrame:
    """Quarantined rows written by one stream, or by all, with the names of the rules they break."""
    return _rows(spark, silver_dir, stream, True)
