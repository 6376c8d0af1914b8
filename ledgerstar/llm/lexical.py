"""Ranked lexical search with geometric blocks of every posting list.

Documents are dealt into shards as they are read. In a shard, the posting list
of each term is clustered by document similarity: documents gather around the
pivot documents of that list whose impacts agree with theirs most, and small
blocks are cut from the clusters. A block's summary holds the coordinatewise
maximum of its documents' impacts, so a query's sum over it bounds the score
of all of them exactly. First, every query scores the blocks of highest bounds
in each shard, which gives it a kth score among all documents; then every
other block whose bound reaches that score is scored, and the rest is skipped.

Queries are a stated set, taken in blocks of bounded size. What a summary
holds, and which terms have postings at all, follows from what the block's
queries can ask for. All impacts, bounds and scores are integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerstar.llm.common import binary_column, pack, sliced, store, text_chunks, unpack

#: A term: ASCII letters and digits, and every character that isn't ASCII. Fixed value.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Bytes of terms, A-Z in small letters; every other byte becomes a blank.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

#: Queries are taken in blocks of about this many terms and items; an item is never split.
QUERY_TERMS, QUERY_ITEMS = 1 << 13, 1 << 9

#: Cells (documents times terms) and documents of a shard.
SHARD_CELLS, SHARD_DOCS = 1 << 23, 1 << 11

#: Sums of integers in float64 are exact below this.
EXACT = 2.0**53

INDEX = "forward binary, lists binary, bounds binary, seed binary"


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a chunk at a time."""
    for chunk in text_chunks(text.translate(FOLD)):
        yield chunk.split()


class Queries:
    """A block of queries: how often each asks for each term of the block's vocabulary."""

    def __init__(self, texts: list[bytes]):
        self.vocabulary: dict[bytes, int] = {}
        asked = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for part in terms(t) for w in part], dtype=np.int64) for t in texts]
        self.terms, self.times = zip(*(np.unique(a, return_counts=True) for a in asked), strict=True)
        self.size = len(self.vocabulary)
        ends = np.cumsum([0, *map(len, self.terms)])
        flat, query = np.concatenate(self.terms), np.repeat(np.arange(len(texts)), np.diff(ends))
        order = np.argsort(flat, kind="stable")
        cuts = np.searchsorted(flat[order], np.arange(self.size + 1))
        by_term = query[order]
        #: Of each term: the queries that ask for it, and all terms that these ask for.
        self.asking = [by_term[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        self.near = [reduce(np.union1d, (self.terms[q] for q in asking)) for asking in self.asking]

    def weights(self, queries: np.ndarray, among: np.ndarray) -> np.ndarray:
        """(term of ``among``, query): how often it is asked for."""
        out = np.zeros((len(among), len(queries)), dtype=np.int64)
        for k, q in enumerate(queries.tolist()):
            own = self.terms[q]
            at = np.searchsorted(among, own)
            ok = (at < len(among)) & (among[np.minimum(at, len(among) - 1)] == own)
            out[at[ok], k] = self.times[q][ok]
        return out

    @property
    def shard_docs(self) -> int:
        return int(min(SHARD_DOCS, max(64, SHARD_CELLS // max(self.size, 1))))


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer matrix product, in float64 where that is exact."""
    if float(a.max(initial=0)) * float(b.max(initial=0)) * a.shape[-1] < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def shards(docs: DataFrame, queries: Queries) -> DataFrame:
    """(n_docs, n_terms, payload): documents with a term, their terms, and postings of the vocabulary."""
    vocabulary, most = queries.vocabulary, queries.shard_docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts, hits, n_docs, n_terms = [], [], [], 0, 0

        def row() -> pa.RecordBatch:
            key = np.repeat(np.arange(len(ids)), [len(h) for h in hits]) * len(vocabulary)
            key, tf = np.unique(key + np.concatenate([np.zeros(0, np.int64), *hits]), return_counts=True)
            null = np.array([i is None for i in ids], dtype=bool)
            of = np.array([0 if i is None else i for i in ids], dtype=np.int64)
            payload = pack(of, null.astype(np.int8), np.array(counts, dtype=np.int64), key // max(len(vocabulary), 1), key % max(len(vocabulary), 1), tf.astype(np.int64))
            return pa.RecordBatch.from_arrays([pa.array([n_docs]), pa.array([n_terms]), pa.array([payload], pa.binary())], names=["n_docs", "n_terms", "payload"])

        for batch in sliced(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), binary_column(batch.column(1)).to_pylist(), strict=True):
                n, found = 0, []
                for words in terms(text):
                    n += len(words)
                    found += [v for v in map(vocabulary.get, words) if v is not None]
                n_docs += n > 0
                n_terms += n
                if found:
                    ids.append(doc_id)
                    counts.append(n)
                    hits.append(np.array(found, dtype=np.int64))
                if len(ids) == most:
                    yield row()
                    ids, counts, hits, n_docs, n_terms = [], [], [], 0, 0
        if n_docs:
            yield row()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "n_docs long, n_terms long, payload binary")


def document_counts(dealt: DataFrame, size: int) -> np.ndarray:
    """Of each term of the vocabulary: the documents that hold it (rows of ``dealt`` are reduced in their task)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                total += np.bincount(unpack(payload)[4], minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "df"])

    out = np.zeros(size, dtype=np.int64)
    for r in dealt.select("payload").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


def impacts(n: np.ndarray, tf: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term adds to the score of a document: of its length in terms, its occurrences, and the term's weight."""
    m = 100 - 75 + (75 * n * n_docs) // n_terms
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def clustered(rows: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of a posting list's documents (their impacts in ``rows``), and where its blocks begin.

    Documents join the pivot of the list that they agree with most; pivots are taken evenly from the list.
    """
    n = len(rows)
    if n <= block:
        return np.arange(n), np.array([0])
    pivots = np.linspace(0, n - 1, -(-n // block)).astype(np.int64)
    scaled = rows.astype(np.float32)
    scaled /= np.maximum(np.sqrt((scaled * scaled).sum(axis=1, keepdims=True)), 1)
    of = (scaled @ scaled[pivots].T).argmax(axis=1)
    order = np.lexsort((-rows.sum(axis=1), of))
    fresh = np.r_[True, of[order][1:] != of[order][:-1]]
    first = np.flatnonzero(fresh)
    place = np.arange(n) - np.repeat(first, np.diff(np.r_[first, n]))
    return order, np.flatnonzero(place % block == 0)


class Shard:
    """Forward index of a shard: impacts by document and term."""

    def __init__(self, forward: bytes, size: int):
        self.ids, self.null, doc, term, impact = unpack(forward)
        self.matrix = np.zeros((len(self.ids), size), dtype=np.int64)
        self.matrix[doc, term] = impact
        order = np.lexsort((doc, term))
        cuts = np.searchsorted(term[order], np.arange(size + 1))
        self.postings = [doc[order[a:b]] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def scores(self, docs: np.ndarray, queries: Queries, q: int) -> np.ndarray:
        return times(self.matrix[np.ix_(docs, queries.terms[q])], queries.times[q])

    def best(self, docs: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
        """Positions of the k best, ties to smaller ids, null ids last; scores of zero don't count."""
        if len(score) > 8 * k:
            least = np.partition(score, len(score) - k)[len(score) - k]
            pool = np.flatnonzero((score >= least) & (score > 0))
        else:
            pool = np.flatnonzero(score > 0)
        return pool[np.lexsort((self.ids[docs[pool]], self.null[docs[pool]], -score[pool]))[:k]]


def index(dealt: DataFrame, queries: Queries, weight: np.ndarray, n_docs: int, n_terms: int, block: int, first: int, k: int) -> DataFrame:
    """Per shard: the forward index, blocks of every posting list, bounds of each query for them, and the scores of its first blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                ids, null, counts, doc, term, tf = unpack(payload)
                if not len(ids):
                    continue
                forward = pack(ids, null, doc, term, impacts(counts[doc], tf, weight[term], n_docs, n_terms))
                shard = Shard(forward, queries.size)
                members, begins, sizes, bounds = [], [], [], []
                top = [[] for _ in queries.terms]  # (bounds, term, block) of each query's most promising blocks of each list
                for t, docs in enumerate(shard.postings):
                    if not len(docs):
                        sizes.append(0)
                        continue
                    asking, near = queries.asking[t], queries.near[t]
                    rows = shard.matrix[np.ix_(docs, near)]
                    order, begin = clustered(rows, block)
                    summary = np.maximum.reduceat(rows[order], begin, axis=0)
                    upper = times(summary, queries.weights(asking, near)).T  # by query and block
                    lead = np.argsort(-upper, axis=1, kind="stable")[:, :first]
                    for row, q in enumerate(asking.tolist()):
                        top[q] += [(-int(upper[row, b]), t, b) for b in lead[row].tolist()]
                    members.append(docs[order])
                    begins.append(begin)
                    sizes.append(len(begin))
                    bounds.append(upper.ravel())
                starts = iter(zip(members, begins, strict=True))
                lists = {t: next(starts) for t, size in enumerate(sizes) if size}
                seed = []
                for q, blocks in enumerate(top):
                    picked = [members_of(*lists[t], b) for _, t, b in sorted(blocks)[:first]]
                    if picked:
                        docs = np.unique(np.concatenate(picked))
                        score = shard.scores(docs, queries, q)
                        seed += [(q, s) for s in score[shard.best(docs, score, k)].tolist()]
                packed = pack(np.array(sizes), np.concatenate(begins), np.concatenate(members))
                pairs = np.array(seed, dtype=np.int64).reshape(-1, 2)
                columns = [forward, packed, pack(np.concatenate(bounds)), pack(pairs[:, 0], pairs[:, 1])]
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], names=[f.split()[0] for f in INDEX.split(", ")])

    return dealt.select("payload").mapInArrow(run, INDEX)


def members_of(members: np.ndarray, begin: np.ndarray, b: int) -> np.ndarray:
    return members[begin[b] : begin[b + 1] if b + 1 < len(begin) else len(members)]


def kth_scores(indexed: DataFrame, n_queries: int, k: int) -> np.ndarray:
    """Of each query: the kth score among its first blocks (1 where there are fewer). Tasks hand on k scores a query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for seed in batch.column(0).to_pylist():
                q, s = unpack(seed)
                query, score = np.r_[query, q], np.r_[score, s]
                order = np.lexsort((-score, query))
                query, score = query[order], score[order]
                first = np.searchsorted(query, query)
                keep = np.arange(len(query)) - first < k
                query, score = query[keep], score[keep]
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(score)], names=["query", "score"])

    found = indexed.select("seed").mapInArrow(run, "query long, score long")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc()))
    out = np.ones(n_queries, dtype=np.int64)
    for r in found.withColumn("place", place).filter(F.col("place") == k).collect():
        out[r["query"]] = r["score"]
    return out


def open_blocks(shard: Shard, lists: bytes, bounds: bytes, queries: Queries, kth: np.ndarray) -> tuple[np.ndarray, int, int]:
    """(query, document) cells of blocks whose bound reaches the query's kth score; the blocks, and how many of them."""
    sizes, begins, members = unpack(lists)
    (upper,) = unpack(bounds)
    marked = np.zeros((len(kth), len(shard.ids)), dtype=bool)
    at = block = member = n_open = 0
    for t in np.flatnonzero(sizes).tolist():
        n, asking = int(sizes[t]), queries.asking[t]
        begin, docs = begins[block : block + n], members[member : member + len(shard.postings[t])]
        reach = upper[at : at + n * len(asking)].reshape(len(asking), n) >= kth[asking][:, None]
        n_open += int(reach.sum())
        row, b = np.nonzero(reach)
        if len(row):
            length = np.diff(np.r_[begin, len(docs)])[b]
            inside = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            marked[np.repeat(asking[row], length), docs[np.repeat(begin[b], length) + inside]] = True
        at, block, member = at + n * len(asking), block + n, member + len(docs)
    return marked, len(upper), n_open


def search_block(docs: DataFrame, texts: list[bytes], k: int, block: int, first: int) -> tuple[DataFrame, DataFrame]:
    """((query, doc_id, score, rank) for a block of queries, numbered in order; what was skipped: blocks as score, scored ones as doc_id)."""
    queries = Queries(texts)
    dealt = store(shards(docs, queries), "lexical-shards")
    total = dealt.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("d"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("t")).first()
    n_docs, n_terms = total["d"], total["t"]
    weight = term_weights(document_counts(dealt, queries.size), n_docs)
    indexed = store(index(dealt, queries, weight, n_docs, n_terms, block, first, k), "lexical-index")
    kth = kth_scores(indexed, len(texts), k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [pd.DataFrame({"query": [], "null": [], "doc_id": [], "score": []}, dtype="int64")] * len(texts)
        n_blocks = n_open = 0
        for batch in batches:
            for forward, lists, bounds in zip(*(batch.column(c).to_pylist() for c in ("forward", "lists", "bounds")), strict=True):
                shard = Shard(forward, queries.size)
                marked, n, opened = open_blocks(shard, lists, bounds, queries, kth)
                n_blocks, n_open = n_blocks + n, n_open + opened
                for q in np.flatnonzero(marked.any(axis=1)).tolist():
                    at = np.flatnonzero(marked[q])
                    score = shard.scores(at, queries, q)
                    best = shard.best(at, score, k)
                    fresh = pd.DataFrame({"query": q, "null": shard.null[at[best]].astype("int64"), "doc_id": shard.ids[at[best]], "score": score[best]})
                    held[q] = pd.concat([held[q], fresh]).sort_values(["score", "null", "doc_id"], ascending=[False, True, True]).head(k)
        out = pd.concat(held)
        ids = pa.array(out["doc_id"].to_numpy(), mask=out["null"].to_numpy().astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array(out["query"].to_numpy()), ids, pa.array(out["score"].to_numpy())], names=["query", "doc_id", "score"])
        # How much was skipped travels as a row of its own.
        yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([n_open]), pa.array([n_blocks])], names=["query", "doc_id", "score"])

    found = store(indexed.select("forward", "lists", "bounds").mapInArrow(run, "query long, doc_id long, score long"), "lexical-found")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return found.filter("query >= 0").withColumn("rank", rank).filter(F.col("rank") <= k), found.filter("query < 0")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block: int = 8, first: int = 5) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score above 0 for every row of ``items``.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are ignored. Null texts hold no term;
    documents without a term count nowhere, items without a term get no rows. Equal scores go by ascending doc_id,
    null ids last; every row is a document and every row an item of its own, also where ids repeat.
    ``block``: documents of a block; ``first``: blocks of each shard that a query scores first.
    """
    return ranked(docs, items, k, block, first)[0]


def skipped(docs: DataFrame, items: DataFrame, k: int = 10, block: int = 8, first: int = 5) -> DataFrame:
    """(n_blocks, n_open): how many blocks the queries' posting lists have, and how many were scored."""
    return ranked(docs, items, k, block, first)[1].agg(F.sum("score").alias("n_blocks"), F.sum("doc_id").alias("n_open"))


def ranked(docs: DataFrame, items: DataFrame, k: int, block: int, first: int) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    asked = items.select(F.col("item_id"), "text", F.regexp_count("text", F.lit(TERM)).alias("n")).filter("n > 0")
    size = asked.agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    n_blocks = max(-(-size["terms"] // QUERY_TERMS), -(-size["items"] // QUERY_ITEMS))
    kind = items.schema["item_id"].dataType
    found, counts = [], []
    for b in range(n_blocks):
        part = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b) if n_blocks > 1 else asked
        rows = part.select("item_id", "text").collect()
        if not rows:
            continue
        names = spark.createDataFrame([(q, r["item_id"]) for q, r in enumerate(rows)], f"query long, item_id {kind.simpleString()}")
        best, opened = search_block(docs, [r["text"].encode() for r in rows], k, block, first)
        found.append(best.join(F.broadcast(names), "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
        counts.append(opened)
    if not found:
        none = spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
        return none, none.select(F.lit(-1).cast("long").alias("query"), "doc_id", "score")
    return reduce(DataFrame.unionByName, found), reduce(DataFrame.unionByName, counts)
