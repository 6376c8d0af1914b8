"""Mixing sources to target weights by subset-sum budget fitting.

Sources share a word budget by weight, each up to a limit on repeats. Within a
source, documents are counted by exact length in words; whole passes take every
document, and what is left of the budget is fitted from the length counts:
every length first gives its proportional share, the longest lengths then fill
up coarsely, and a bounded-knapsack dynamic program fits the remainder as
closely as whole documents allow. Which documents of a length are taken follows
from a seeded hash of the document, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerstar.llm.common import store

WEIGHTS = (5.0, 2.0, 1.0)

#: The dynamic program fits this many words; what is above goes to the coarse steps.
DP_WORDS = 1 << 16

#: Ranges of the selection hash; within a length only the range at the boundary is ranked row by row.
RANGES = 1024


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with __size: the number of words (runs of anything but bytes 0x09-0x0D and 0x20); null text: 0."""
    return docs.withColumn("__size", F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long"))


def share(sizes: list[int], weights: list[float], budget: float, limit: float) -> list[float]:
    """Split ``budget`` by weight; nobody gets over ``limit`` times its size, the excess is shared again by weight."""
    target, open_, left = [0.0] * len(sizes), [k for k, s in enumerate(sizes) if s > 0], float(budget)
    while open_:
        rate = left / sum(weights[k] for k in open_)
        full = [k for k in open_ if rate * weights[k] > limit * sizes[k]]
        if not full:
            for k in open_:
                target[k] = rate * weights[k]
            break
        for k in full:
            target[k] = limit * sizes[k]
            left -= target[k]
        done = set(full)
        open_ = [k for k in open_ if k not in done]
    return target


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, budget_share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, __size): one row per source passes through the driver."""
    spark: SparkSession = sizes.sparkSession
    rows = sizes.groupBy("source").agg(F.sum("__size").alias("s")).collect()
    rows = sorted(rows, key=lambda r: (r["source"] is None, r["source"] or ""))
    total = [int(r["s"]) for r in rows]
    target = share(total, [weights[k % len(weights)] for k in range(len(rows))], budget_share * sum(total), limit)
    schema = T.StructType([T.StructField("source", T.StringType()), T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType())])
    return spark.createDataFrame([(r["source"], s, t) for r, s, t in zip(rows, total, target, strict=True)], schema)


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come as near to ``budget`` as found, never above it.

    Exact whenever the remainder after the coarse steps is reachable from the documents left.
    """
    lengths, counts = lengths.astype(object), counts.astype(object)
    take = np.zeros(len(lengths), dtype=object)
    total = int((lengths * counts).sum()) if len(lengths) else 0
    if budget >= total:
        return counts.astype(np.int64)
    if budget <= 0 or not total:
        return take.astype(np.int64)
    coarse = max(0, budget - DP_WORDS // 2)
    for k in range(len(lengths)):  # each length's share, rounded down
        take[k] = counts[k] * coarse // total
    left = budget - int((lengths * take).sum())
    for k in np.argsort(-lengths.astype(np.int64), kind="stable").tolist():
        if left <= DP_WORDS // 2:
            break
        more = min(counts[k] - take[k], max(0, (left - DP_WORDS // 2)) // lengths[k])
        take[k] += more
        left -= more * lengths[k]
    # Bounded knapsack: reach[s] is set when s words can be made up; via[s] is the item that first made it.
    items: list[tuple[int, int]] = []
    for k in np.argsort(lengths.astype(np.int64), kind="stable").tolist():
        free, step = min(counts[k] - take[k], left // lengths[k]), 1
        while free > 0:
            n = min(step, free)
            items.append((k, n))
            free, step = free - n, step * 2
    via = np.full(left + 1, -1, dtype=np.int32)
    reach = np.zeros(left + 1, dtype=bool)
    reach[0] = True
    for i, (k, n) in enumerate(items):
        words = int(lengths[k] * n)
        if words > left:
            continue
        fresh = np.zeros(left + 1, dtype=bool)
        fresh[words:] = reach[: left + 1 - words]
        fresh &= ~reach
        via[fresh] = i
        reach |= fresh
        if reach[left]:
            break
    at = int(np.flatnonzero(reach)[-1])
    while at:
        k, n = items[via[at]]
        take[k] += n
        at -= int(lengths[k] * n)
    return take.astype(np.int64)


def _plan(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """One source's length counts: whole passes over every document, and how many documents of each length once more."""
    target, size = float(rows["target"].iloc[0]), int(rows["source_size"].iloc[0])
    budget = int(np.floor(target + 0.5))
    passes = budget // size if size else 0
    rest = budget - passes * size
    extra = fit(rows["size"].to_numpy(), rows["n"].to_numpy(), rest)
    return pd.DataFrame({"source": rows["source"], "size": rows["size"], "passes": passes, "extra": extra})


def mix(docs: DataFrame, weights: tuple = WEIGHTS, budget_share: float = 1.5, limit: float = 2.0, seed: int = 42) -> DataFrame:
    """``docs`` with __size, __source_size, __target and __taken (words the mix takes of the row, repeats counted).

    ``docs`` needs doc_id, text and source; all rows and columns are kept. ``limit`` is a whole number: a document is
    taken 0 to ``limit`` times, so its source's taken words miss the target by less than the words of one document.
    A null source is a source of its own, the last one. Empty documents take nothing. Rows alike in doc_id and text
    are told apart by an arbitrary but even choice: only how many of them are taken is defined. Empty table: no rows.
    """
    rows = sized(docs).withColumn("__h", F.xxhash64("doc_id", "text", F.lit(seed)))
    narrow = store(rows.select("source", "doc_id", F.col("__h").alias("h"), F.col("__size").alias("size")), "mix-sizes")
    return _taken(rows, *_quotas(narrow, weights, budget_share, limit))


def mix_sizes(docs: DataFrame, weights: tuple = WEIGHTS, budget_share: float = 1.5, limit: float = 2.0, seed: int = 42) -> DataFrame:
    """As ``mix``, but returns doc_id and source only beside the mix's columns: texts are read once and never moved."""
    narrow = sized(docs).select("doc_id", "source", F.col("__size"), F.xxhash64("doc_id", "text", F.lit(seed)).alias("__h"))
    narrow = store(narrow, "mix-sizes")
    return _taken(narrow, *_quotas(narrow.select("source", "doc_id", F.col("__h").alias("h"), F.col("__size").alias("size")), weights, budget_share, limit))


def _bucket(h: str):
    """The hash's top 10 bits: RANGES ranges."""
    return F.shiftrightunsigned(F.col(h), 54)


def _quotas(narrow: DataFrame, weights: tuple, budget_share: float, limit: float) -> tuple[DataFrame, DataFrame]:
    """(source targets; how many documents of each source, length and hash range are taken once more)."""
    targets = source_targets(narrow.withColumnRenamed("size", "__size"), weights, budget_share, limit)
    counts = narrow.filter("size > 0").withColumn("bucket", _bucket("h")).groupBy("source", "size", "bucket").agg(F.count(F.lit(1)).alias("n"))
    counts = store(counts, "mix-counts")
    lengths = counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    named = targets.withColumnRenamed("source", "t_source")
    planned = lengths.join(named, F.col("source").eqNullSafe(F.col("t_source"))).select("source", "size", "n", "source_size", "target")
    plan = store(planned.groupBy("source").applyInPandas(_plan, "source string, size long, passes long, extra long"), "mix-plan")
    before = F.sum("n").over(Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    ranged = counts.withColumn("before", F.coalesce(before, F.lit(0)))
    plan = plan.toDF("p_source", "p_size", "passes", "extra")
    ranged = ranged.join(plan, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size")))
    quota = F.greatest(F.lit(0), F.least("n", F.col("extra") - F.col("before")))
    return targets, ranged.select(F.col("source").alias("__q_source"), F.col("size").alias("__q_size"), F.col("bucket").alias("__q_bucket"), F.col("passes").alias("__passes"), quota.alias("__quota"))


def _taken(rows: DataFrame, targets: DataFrame, quotas: DataFrame) -> DataFrame:
    columns = [c for c in rows.columns if c != "__h"]
    named = targets.toDF("__t_source", "__source_size", "__target")
    out = rows.withColumn("__bucket", _bucket("__h")).join(named, F.col("source").eqNullSafe(F.col("__t_source")))
    key = F.col("source").eqNullSafe(F.col("__q_source")) & (F.col("__size") == F.col("__q_size")) & (F.col("__bucket") == F.col("__q_bucket"))
    rank = F.row_number().over(Window.partitionBy("source", "__size", "__bucket").orderBy("__h", "doc_id"))
    times = F.coalesce("__passes", F.lit(0)) + F.when(rank <= F.col("__quota"), 1).otherwise(0)
    out = out.join(quotas, key, "left").withColumn("__taken", F.col("__size") * times)
    return out.select(*columns, "__source_size", "__target", "__taken")
