"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item is contained in a document when at least ``threshold`` of the
item's distinct word shingles occur in it, however long the document is. Items
are partitioned by their number of shingles; each partition has a signature
length: the item's smallest shingle hashes, so many that any document holding
the threshold's share must hold one of them (an item of n shingles that lacks
at most f of them keeps one of its f + 1 smallest). A document looks up its own
shingle hashes among the signatures, and every pair found is verified by exact
shingle containment on the texts. All steps are DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerstar.llm.common import store

#: Signatures are broadcast up to this many rows (16 bytes a row in memory, about 64 with overhead); beyond it they are shuffled.
BROADCAST_ROWS = 400_000

#: What separates words: anything but letters and digits.
SEPARATOR = r"[^\p{L}\p{N}]+"


def words(text: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), SEPARATOR), lambda w: w != "")


def _with_words(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), words("text").alias("w")).filter(F.size("w") > 0)


def _hashes(df: DataFrame, size: int) -> DataFrame:
    """(key, h): a 64-bit hash of every shingle; a shorter text is one shingle."""
    gram = lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(size)])
    every = F.transform(F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0))), gram)
    return df.select("key", F.explode(every).alias("h"))


def _shingles(df: DataFrame, size: int) -> DataFrame:
    """(key, s): every distinct shingle as text."""
    gram = lambda i: F.array_join(F.slice("w", i + 1, size), " ")
    every = F.transform(F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0))), gram)
    return df.select("key", F.explode(F.array_distinct(every)).alias("s")).distinct()


def signatures(items: DataFrame, size: int = 5, threshold: float = 0.8) -> DataFrame:
    """(h, item_id, n_shingles, size_class): the smallest hashes of each item, as many as its size class needs."""
    own = _hashes(_with_words(items, "item_id"), size).distinct()
    ranked = own.select(
        "key", "h", F.row_number().over(Window.partitionBy("key").orderBy("h")).alias("r"), F.count(F.lit(1)).over(Window.partitionBy("key")).alias("n")
    )
    size_class = F.floor(F.log2("n") + F.lit(1e-9)).cast("int")
    may_lack = F.floor((F.pow(F.lit(2.0), size_class + 1) - 1) * F.lit(1 - threshold) + F.lit(1e-9))
    return ranked.withColumn("size_class", size_class).filter(F.col("r") <= may_lack + 1).select("h", F.col("key").alias("item_id"), F.col("n").alias("n_shingles"), "size_class")


def contained_items(docs: DataFrame, items: DataFrame, size: int = 5, threshold: float = 0.8) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found, containment): every item contained in a document.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are ignored. Words are runs of letters
    and digits, lower-cased. Rows that share an id are one text's parts: their shingles are united. Null ids and
    null or wordless texts match nothing. An item of fewer than ``size`` words is a single shingle, matched by
    documents that consist of just these words. Empty tables: no rows.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    index = signatures(items, size, threshold).select("h", "item_id")
    if items.agg(F.sum(F.length("text"))).first()[0] is None:
        index = index.limit(0)
    elif index.count() <= BROADCAST_ROWS:
        index = F.broadcast(index)
    worded = _with_words(docs, "doc_id")
    # Used twice below; written once, so that the documents are hashed once.
    found = store(_hashes(worded, size).join(index, "h").select(F.col("key").alias("doc_id"), "item_id").distinct(), "contained-found")
    near = docs.select("doc_id", "text").join(found.select(F.col("doc_id").alias("found_id")).distinct(), F.col("doc_id") == F.col("found_id"), "left_semi")
    theirs = _shingles(_with_words(near, "doc_id"), size).select(F.col("key").alias("doc_id"), "s")
    own = _shingles(_with_words(items, "item_id"), size).select(F.col("key").alias("item_id"), "s")
    total = own.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_shingles"))
    both = found.join(own, "item_id").join(theirs, ["doc_id", "s"])
    count = both.groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("n_found"))
    need = math.nextafter(threshold, 0)
    out = count.join(total, "item_id").withColumn("containment", F.col("n_found") / F.col("n_shingles"))
    return out.filter(F.col("containment") >= need).select("doc_id", "item_id", "n_shingles", "n_found", "containment")


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that contain no item; rows with a null doc_id or text stay."""
    bad = contained_items(docs, items, size, threshold).select(F.col("doc_id").alias("__bad")).distinct()
    return docs.join(bad, F.col("doc_id") == F.col("__bad"), "left_anti")
