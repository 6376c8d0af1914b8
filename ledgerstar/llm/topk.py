"""Exact top-k by inner product with block-at-a-time pruning.

Vectors are cut into document-range blocks: a forward index (ids and integer
matrix) with the largest and smallest value of every term. A query's summed
term maxima bound all scores of a block. Queries come in blocks too. First
every query scores its best-bounded blocks, which gives it a kth score; then
every block whose bound reaches that score is scored, and all others are
skipped: nothing in them can enter the top k, ties included.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerstar.llm.common import pack, store, unpack

#: float64 products and sums of integers are exact below this.
EXACT = 2.0**53


def quantized(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, q: array<long>), floor(scale * x) for each component; vectors null or with null or non-finite components are left out.

    Rows that share a vec_id stay rows of their own. Rows without a vec_id are left out.
    """
    x = F.col("embedding")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    clean = vectors.select("vec_id", x.cast("array<double>").alias("embedding")).filter(F.col("vec_id").isNotNull() & x.isNotNull() & ~bad)
    return clean.select("vec_id", F.transform("embedding", lambda c: F.floor(c * scale)).alias("q"))


def _matrix(rows: list) -> np.ndarray:
    out = np.zeros((len(rows), max(map(len, rows))), dtype=np.int64)
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    return out


def blocks(vectors: DataFrame, size: int, tag: str, parts: int | None = None) -> DataFrame:
    """(block, payload, bounds): rows (row, vec_id, q) in order of vec_id, at most ``size`` a block; written to the shared folder.

    ``row`` is the row's own number; a block has that of its first row as its id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, size):
                piece = batch.slice(lo, size)
                rows, ids, m = piece.column(0).to_numpy(), piece.column(1).to_numpy(), _matrix(piece.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(rows[0])]), pa.array([pack(rows, ids, np.array(m.shape), m.ravel())], pa.binary()), pa.array([pack(m.max(axis=0), m.min(axis=0))], pa.binary())],
                    names=["block", "payload", "bounds"],
                )

    vectors = vectors.select("row", "vec_id", "q")
    dealt = vectors.repartitionByRange(parts, "vec_id", "row") if parts else vectors.repartitionByRange("vec_id", "row")
    return store(dealt.sortWithinPartitions("vec_id", "row").mapInArrow(run, "block long, payload binary, bounds binary"), tag)


def _load(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, vec_ids and matrix of a block."""
    rows, ids, shape, flat = unpack(payload)
    return rows, ids, flat.reshape(shape)


def _padded(a: np.ndarray, dim: int) -> np.ndarray:
    return a if a.shape[-1] == dim else np.concatenate([a, np.zeros((*a.shape[:-1], dim - a.shape[-1]), a.dtype)], axis=-1)


def products(q: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows; missing components count as zero."""
    dim = max(q.shape[1], d.shape[1])
    q, d = _padded(q, dim), _padded(d, dim)
    most = float(np.abs(q).max(initial=0)) * float(np.abs(d).max(initial=0)) * dim
    if most < EXACT:
        return (q.astype(np.float64) @ d.astype(np.float64).T).astype(np.int64)
    return q @ d.T


def upper_bounds(q: np.ndarray, top: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For each query: the sum over terms of the largest product that the block's range allows."""
    dim = max(q.shape[1], len(top))
    q, top, low = _padded(q, dim), _padded(top, dim), _padded(low, dim)
    return np.maximum(q, 0) @ top + np.minimum(q, 0) @ low


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best, ties to smaller ids."""
    if len(scores) > 4 * k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        pool = np.flatnonzero(scores >= kth)
    else:
        pool = np.arange(len(scores))
    return pool[np.lexsort((ids[pool], -scores[pool]))[:k]]


SCORED = ("query_row", "query_id", "row", "vec_id", "score")


def _scored(wanted: DataFrame, queries: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """Score (query block, block, picks: packed query positions); the k best of each query in each block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for picks, qp, dp in zip(batch["picks"], batch["q_payload"], batch["payload"], strict=True):
                (at,), (q_rows, q_ids, q), (rows, ids, d) = unpack(picks), _load(qp), _load(dp)
                scores = products(q[at], d)
                out = []
                for n, (query_row, query) in enumerate(zip(q_rows[at].tolist(), q_ids[at].tolist(), strict=True)):
                    own = scores[n]
                    free = np.flatnonzero(rows != query_row)
                    best = free[_best(own[free], ids[free], k)]
                    out.append(pd.DataFrame({"query_row": query_row, "query_id": query, "row": rows[best], "vec_id": ids[best], "score": own[best]}))
                yield pd.concat(out) if out else pd.DataFrame({c: [] for c in SCORED}, dtype="int64")

    q = queries.select(F.col("block").alias("q_block"), F.col("payload").alias("q_payload"))
    full = wanted.join(docs.select("block", "payload"), "block").join(q, "q_block")
    return full.select("picks", "q_payload", "payload").mapInPandas(run, ", ".join(f"{c} long" for c in SCORED))


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row"))
    return scores.withColumn("rank", rank).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, block_rows: int = 1024, query_rows: int = 128, first_blocks: int = 2) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other vectors of every vector for which ``is_query`` holds.

    ``vectors`` needs vec_id and embedding; other columns are ignored. See ``quantized`` for rows that take no part.
    Shorter vectors count as padded with zeros. Ties go to the smaller vec_id; fewer candidates give fewer rows.
    Every row is a candidate of all others, those of its own vec_id included; rows that share a vec_id for which
    ``is_query`` holds are queries of their own, with ranks from 1 each.
    """
    # The numbers are stored with the rows: a task that runs again must not deal them anew.
    clean = store(quantized(vectors, scale).withColumn("row", F.monotonically_increasing_id()), "topk-vectors")
    docs = blocks(clean, block_rows, "topk-blocks")
    queries = blocks(clean.filter(is_query), query_rows, "topk-queries")

    def bound(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for qb, qp, b, bp in zip(batch["q_block"], batch["q_payload"], batch["block"], batch["bounds"], strict=True):
                rows.append((qb, b, pack(upper_bounds(_load(qp)[2], *unpack(bp)))))
            yield pd.DataFrame(rows, columns=["q_block", "block", "upper"])

    pairs = queries.select(F.col("block").alias("q_block"), F.col("payload").alias("q_payload")).crossJoin(docs.select("block", "bounds"))
    bounds = store(pairs.mapInPandas(bound, "q_block long, block long, upper binary"), "topk-bounds")

    def best(uppers: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of stacked bounds (rows: blocks ``at``, one column a query, or blocks of each query's own) the highest of each query."""
        top = np.argsort(-uppers, axis=0, kind="stable")[:first_blocks]
        at = np.broadcast_to(at if at.ndim == 2 else at[:, None], uppers.shape)
        return np.take_along_axis(uppers, top, axis=0), np.take_along_axis(at, top, axis=0)

    def lead(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each query's blocks with the highest bounds in a batch."""
        for batch in batches:
            rows = []
            for q_block, frame in batch.groupby("q_block", sort=True):
                uppers, at = best(np.stack([unpack(u)[0] for u in frame["upper"]]), frame["block"].to_numpy())
                rows.append((q_block, pack(np.array(uppers.shape), uppers.ravel(), at.ravel())))
            yield pd.DataFrame(rows, columns=["q_block", "leads"])

    def seeds(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        """The blocks with each query's highest bounds of all."""
        parts = [unpack(x) for x in frame["leads"]]
        uppers, at = best(*(np.concatenate([p[k].reshape(p[0]) for p in parts]) for k in (1, 2)))
        del uppers
        rows = [(key[0], b, pack(np.flatnonzero((at == b).any(axis=0)))) for b in np.unique(at).tolist()]
        return pd.DataFrame(rows, columns=["q_block", "block", "picks"])

    leads = bounds.mapInPandas(lead, "q_block long, leads binary")
    first = leads.groupBy("q_block").applyInPandas(seeds, "q_block long, block long, picks binary")
    first = store(first, "topk-first")
    seed = store(_ranked(_scored(first, queries, docs, k), k), "topk-seed")
    kth = seed.filter(F.col("rank") == k).select("query_row", F.col("score").alias("kth"))

    def reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Queries whose bound for a block reaches their kth score, without the pairs already scored."""
        for batch in batches:
            rows = []
            for qb, b, up, kths, done, payload in zip(*(batch[c] for c in ("q_block", "block", "upper", "kths", "picks", "q_payload")), strict=True):
                at = {r["query_row"]: r["kth"] for r in kths} if kths is not None else {}
                floor = np.array([at.get(i, np.iinfo(np.int64).min) for i in unpack(payload)[0].tolist()], dtype=np.int64)
                hit = unpack(up)[0] >= floor
                if done is not None:
                    hit[unpack(done)[0]] = False
                rows.append((qb, b, pack(np.flatnonzero(hit)), int(hit.sum())))
            yield pd.DataFrame(rows, columns=["q_block", "block", "picks", "n"])

    members = queries.select(F.col("block").alias("q_block"), "payload").mapInPandas(_query_rows, "q_block long, query_row long")
    per_block = members.join(kth, "query_row").groupBy("q_block").agg(F.collect_list(F.struct("query_row", "kth")).alias("kths"))
    seen = bounds.join(first, ["q_block", "block"], "left").join(per_block, "q_block", "left")
    seen = seen.join(queries.select(F.col("block").alias("q_block"), F.col("payload").alias("q_payload")), "q_block")
    rest = seen.mapInPandas(reach, "q_block long, block long, picks binary, n long").filter("n > 0").drop("n")
    rest = store(rest, "topk-rest")
    every = _scored(rest, queries, docs, k).unionByName(seed.select(*SCORED))
    return _ranked(every, k).select("query_id", "rank", "vec_id", "score")


def _query_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for block, payload in zip(batch["q_block"], batch["payload"], strict=True):
            yield pd.DataFrame({"q_block": block, "query_row": unpack(payload)[0]})
