"""Insert-only merge into a dimension table, and key-level deduplication.

``insert_only_merge`` is ``MERGE ... WHEN NOT MATCHED THEN INSERT`` built
from a left-anti join and an append by name: the target's files are never
rewritten, existing rows never change (matched rows are ignored), and new
rows get dense ids above the current maximum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstar.operators.keys import dense_ids, stored_max_id
from ledgerstar.sinks import append_by_name, store


def dedupe_by_key(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """One row per key (NULL keys form one group); the survivor is the row
    with the smallest remaining columns, so the choice is deterministic.

    ``min(struct)`` is a partial aggregate: a hot key is reduced inside each
    map task before the shuffle.
    """
    key_cols = list(key_cols)
    others = [c for c in df.columns if c not in key_cols]
    if not others:
        return df.select(*key_cols).distinct()
    survivors = df.groupBy(*key_cols).agg(F.min(F.struct(*others)).alias("_ls_row"))
    return survivors.select(*key_cols, *[F.col(f"_ls_row.{c}").alias(c) for c in others]).select(*df.columns)


def new_rows_only(source: DataFrame, target: DataFrame, key_cols: Sequence[str],
                  null_safe: bool = False) -> DataFrame:
    """Source rows whose key no target row has (``NOT EXISTS``).

    With ``null_safe`` a NULL key matches a NULL key in the target; without
    it (SQL ``=``), a NULL-key source row is always new.
    """
    key_cols = list(key_cols)
    renamed = target.select(*[F.col(k).alias(f"_ls_t{i}") for i, k in enumerate(key_cols)])
    src = source.alias("_ls_s")
    cond = [
        (F.col(f"_ls_s.{k}").eqNullSafe(F.col(f"_ls_t{i}")) if null_safe
         else F.col(f"_ls_s.{k}") == F.col(f"_ls_t{i}"))
        for i, k in enumerate(key_cols)
    ]
    return src.join(renamed, cond, "left_anti").select(*source.columns)


def insert_only_merge(source: DataFrame, target_table: str, key_cols: Sequence[str],
                      id_col: str | None = None, null_safe: bool = False) -> int:
    """Append source rows whose key is not in ``target_table``; return how many.

    With ``id_col``, only the new rows are numbered, densely, above the
    target's current maximum (kept in the plan, not collected).
    """
    spark = source.sparkSession
    target = spark.table(target_table)
    # Store the new rows once in the shared folder: the anti-join runs a single
    # time, and the append no longer depends on the table's lineage.
    fresh = store(new_rows_only(source, target, key_cols, null_safe), "merge")
    inserted = fresh.count()  # from the file footers
    if not inserted:
        return 0
    if id_col:
        fresh = dense_ids(fresh, key_cols, id_col, base=stored_max_id(spark, target_table, id_col), materialized=True,
                          total=inserted)
    append_by_name(fresh, target_table)
    return inserted


def build_dim(staging: DataFrame, target_table: str, key_cols: Sequence[str], id_col: str) -> int:
    """Load a dimension: one row per business key, insert new keys only,
    dense ids above the current maximum. NULL keys are one member."""
    return insert_only_merge(dedupe_by_key(staging, key_cols), target_table, key_cols,
                             id_col=id_col, null_safe=True)


def union_dedupe_by_key(existing: DataFrame, incoming: DataFrame, key_cols: Sequence[str],
                        id_col: str) -> DataFrame:
    """Union by name, keep one row per key (existing rows win), renumber 1..n.

    Every id is reassigned in key order, so this suits a full rebuild, not a
    table that facts already reference (use ``insert_only_merge`` there).
    """
    if id_col not in incoming.columns:
        incoming = incoming.withColumn(id_col, F.lit(None).cast("int"))
    both = (existing.withColumn("_ls_prio", F.lit(0))
            .unionByName(incoming.select(*existing.columns).withColumn("_ls_prio", F.lit(1))))
    others = [c for c in existing.columns if c not in key_cols and c != id_col]
    survivors = both.groupBy(*key_cols).agg(F.min(F.struct("_ls_prio", *others)).alias("_ls_row"))
    flat = survivors.select(*key_cols, *[F.col(f"_ls_row.{c}").alias(c) for c in others])
    return dense_ids(flat, key_cols, id_col).select(*existing.columns)
