"""Surrogate keys: dense ids without a single-task step, by one path for every size.

``dense_ids`` numbers rows ``base+1 .. base+n`` in key order, which equals a
global ``row_number() OVER (ORDER BY key) + base`` but is computed in
parallel:

1. the input is stored (unless it already is), so all later steps read the
   same rows, and its row count comes from the file footers;
2. its rows are range-partitioned by key into P partitions, sorted inside each,
   and written once, with the partition and the position inside it as columns;
3. the last position of each partition (two narrow columns of the written
   table, one row per partition) gives the partition's start by a running sum;
4. id = base + start + position, with the base a scalar subquery when it is
   the table's current maximum.

P comes from the row count and a target of rows per partition; there is no
other path for few rows, which are one partition. The sort includes every
column and finally the row's place in the stored input, so the numbering is
fixed once the input is stored, range bounds can split a hot key or a group of
identical rows across partitions, and a task that is recomputed after a lost
executor gives every row the partition it had.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.sinks import store
from ledgerstar.sources.footers import from_footers

ROWS_PER_PARTITION = 2_000_000
_POSITION_BITS = 33  # monotonically_increasing_id layout: partition << 33 | row


def max_id(target: DataFrame, id_col: str) -> DataFrame:
    """One row ``max_id``: the largest id, or 0 for an empty table."""
    return target.agg(F.coalesce(F.max(id_col).cast("bigint"), F.lit(0).cast("bigint")).alias("max_id"))


def stored_max_id(spark: SparkSession, table: str, id_col: str) -> DataFrame:
    """``max_id`` of a stored table from its footers. A file of NULL ids has no maximum to give: then the column is read.

    Whether there are NULL ids is a count from the footers, too.
    """
    stored = from_footers(spark, table)
    n = stored.agg(F.count(F.lit(1)).alias("rows"), F.count(id_col).alias("ids")).first()
    return max_id(stored if n["rows"] == n["ids"] else spark.table(table), id_col)


_TYPE_MAX = {"int": 2**31 - 1, "integer": 2**31 - 1, "bigint": 2**63 - 1, "long": 2**63 - 1}


def _checked(new_id: Column, id_type: str) -> Column:
    """Cast to ``id_type``, failing on overflow whatever the session's ANSI mode."""
    limit = _TYPE_MAX.get(id_type)
    if limit is None or limit == 2**63 - 1:
        return new_id.cast(id_type)
    return F.when(new_id > F.lit(limit), F.raise_error(F.lit(f"surrogate id exceeds the {id_type} range"))) \
        .otherwise(new_id).cast(id_type)


def _base(df: DataFrame, base: DataFrame | int) -> Column:
    """The base as a column: a literal, or a scalar subquery over a one-row frame."""
    if isinstance(base, DataFrame):
        return base.select(F.col(base.columns[0]).cast("bigint")).scalar()
    return F.lit(int(base)).cast("bigint")


def dense_ids(df: DataFrame, key_cols: Sequence[str], id_col: str,
              base: DataFrame | int = 0, id_type: str = "int",
              rows_per_partition: int = ROWS_PER_PARTITION, materialized: bool = False,
              total: int | None = None) -> DataFrame:
    """Append ``id_col`` = base + rank by ``key_cols`` (NULLs first), dense from base+1.

    ``base`` is an int or a one-row, one-column frame (e.g. ``max_id``); a
    frame stays in the plan as a scalar subquery instead of being collected.
    Ids that do not fit ``id_type`` fail rather than wrap, with or without
    ANSI mode. A caller whose input is read from stored files says so with
    ``materialized`` and may pass its row count as ``total``.
    """
    key_cols = list(key_cols)
    if id_col in df.columns:
        df = df.drop(id_col)
    if not materialized:
        df, total = store(df, "dense-ids-input"), None
    if total is None:
        total = df.count()
    keys = [F.col(c).asc_nulls_first() for c in key_cols]
    ties = [F.col(c).asc_nulls_first() for c in df.columns if c not in key_cols]
    order = [*keys, *ties, F.col("_ls_row").asc()]
    ranked = store(
        df.withColumn("_ls_row", F.monotonically_increasing_id())
        .repartitionByRange(max(1, -(-total // rows_per_partition)), *order)
        .sortWithinPartitions(*order)
        .withColumn("_ls_mid", F.monotonically_increasing_id())
        .withColumn("_ls_part", F.shiftright("_ls_mid", _POSITION_BITS))
        .withColumn("_ls_pos", F.col("_ls_mid").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
        .drop("_ls_row", "_ls_mid"), "dense-ids")
    new_id = _base(df, base) + F.col("_ls_start") + F.col("_ls_pos") + F.lit(1)
    numbered = ranked.join(F.broadcast(partition_starts(ranked)), "_ls_part")
    return numbered.withColumn(id_col, _checked(new_id, id_type)).select(*df.columns, id_col)


def partition_starts(ranked: DataFrame) -> DataFrame:
    """(_ls_part, _ls_start): rows before each partition. One row per partition passes through the driver, a number a task at most."""
    last = ranked.groupBy("_ls_part").agg(F.max("_ls_pos").alias("last")).collect()
    rows, start = [], 0
    for part, end in sorted((r["_ls_part"], r["last"]) for r in last):
        rows.append((part, start))
        start += end + 1
    return ranked.sparkSession.createDataFrame(rows, "_ls_part bigint, _ls_start bigint")
