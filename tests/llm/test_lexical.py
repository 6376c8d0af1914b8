"""Ranked search against brute force; blocks are skipped, results aren't."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerstar.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, rank int, score string, query long"


def terms_of(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, k=10):
    rows = [(i, Counter(terms_of(t))) for i, t in docs]
    rows = [(i, c) for i, c in rows if c]
    n_docs, n_terms = len(rows), sum(sum(c.values()) for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in rows:
            m = 25 + 75 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms_of(text) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def found(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, 1, "x", 5) for i, t in docs], DOCS)
    q = spark.createDataFrame([(i, t, 1, "x", 5) for i, t in items], DOCS.replace("doc_id", "item_id"))
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.search(d, q, **options).collect()), key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    pool = ["the", "of", *(f"w{k}" for k in range(60)), "ñandú", "ÑANDÚ", "日本"]
    weights = [40, 30, *(60 / (k + 1) for k in range(60)), 1, 1, 1]
    text = lambda m: rng.choice([" ", ", ", "-"]).join(rng.choices(pool, weights, k=m))
    docs = [(k, text(rng.randrange(1, 60)).upper() if k % 3 else text(rng.randrange(1, 200))) for k in range(n)]
    docs += [(1000 + k, docs[5][1]) for k in range(n // 3)] + [(7, docs[8][1]), (7, docs[8][1]), (None, docs[9][1]), (None, "w3 W3 w4")]
    docs += [(900, None), (901, ""), (902, " .,;\t"), (903, "the " * 5000)]
    items = [(k, text(rng.randrange(1, 30))) for k in range(12)] + [(20, None), (21, "!!"), (22, "nowhere"), (3, "w1 w2 w2 w2"), (3, "w1 w2 w2 w2"), (None, "W3 w4")]
    return docs, items


@pytest.mark.parametrize("options", [{}, {"block": 1, "first": 1}, {"block": 3, "first": 4, "k": 3}])
def test_search_equals_brute_force(spark, options):
    docs, items = corpus(4, 150)
    assert found(spark, docs, items, **options) == brute(docs, items, options.get("k", 10))


def test_shards_and_query_blocks_change_nothing(spark, monkeypatch):
    docs, items = corpus(9, 120)
    monkeypatch.setattr(lexical, "SHARD_DOCS", 10)
    monkeypatch.setattr(lexical, "QUERY_TERMS", 60)
    assert found(spark, docs, items, block=4) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = corpus(2, 20)
    assert found(spark, [], items) == [] and found(spark, docs, []) == [] and found(spark, [(1, None)], items) == []


def test_most_blocks_are_skipped(spark):
    path = "/root/testdata/sf0.1"
    r = lexical.skipped(spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/benchmark.parquet")).first()
    assert 0 < r.n_open < r.n_blocks / 2


def test_summaries_bound_their_documents():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 50, (90, 12)) * rng.integers(0, 2, (90, 12))
    order, begin = lexical.clustered(rows, 8)
    assert sorted(order.tolist()) == list(range(90)) and np.diff(np.r_[begin, 90]).max() <= 8
    summary = np.maximum.reduceat(rows[order], begin, axis=0)
    query = rng.integers(0, 4, 12)
    bound = np.repeat(summary @ query, np.diff(np.r_[begin, 90]))
    assert (rows[order] @ query <= bound).all()
    big = np.array([[2**40, 3], [5, 2**41]])
    assert (lexical.times(big, np.array([[2**20], [1]])) == np.array([[2**60 + 3], [5 * 2**20 + 2**41]])).all()
