"""Rows that share an id, and pages that name parts of their sentences."""

import math
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerstar.llm import pages, topk


def test_every_row_is_a_candidate(spark):
    rng = np.random.default_rng(8)
    rows = [(k % 260, [float(x) for x in rng.normal(size=5).round(1)]) for k in range(600)]
    rows += [(7, rows[3][1]), (7, rows[3][1]), (100, [9.0] * 5), (100, [9.0] * 5), (260, [])]
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    want = []
    for n, (q, a) in enumerate(whole):
        if q % 100 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for m, (i, b) in enumerate(whole) if m != n)[:10]
            want += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    for size in (16, 1024):
        got = topk.top_k(frame, F.col("vec_id") % 100 == 0, block_rows=size, query_rows=4)
        assert Counter(tuple(r) for r in got.collect()) == Counter(want)


def kept(html):
    found = pages.blocks(f"<body><p>The main text of this page is longer than all else on it, by far.</p>{html}</body>")
    return [t for t, dropped, _ in found[1:] if not dropped]


@pytest.mark.parametrize(
    "html, want",
    [
        ('<p title="the hidden truth">a b</p>', ["a b"]),
        ('<p data-id="comments">a</p><p data-role="dialog">b</p>', ["a", "b"]),
        ('<article data-hidden="false"><p>x</p><p>y</p></article>', ["x", "y"]),
        ("<p>We <span class=share>share this</span> and <b id=comments>comments</b> too.</p>", ["We share this and comments too."]),
        ("<p title='it's'>text</p>", ["text"]),
        ("<p>a <span hidden>gone</span> b</p>", ["a b"]),
        ('<div><a class="share" href=x>Share</a></div>', []),
        ('<span class="ad">Buy <span>now</span> this</span><p>more</p>', ["more"]),
        ('<a class="promo" href=x><div>Deal</div><div>of the day</div></a><p>tail</p>', ["tail"]),
        ('<p hidden>z</p><p style="display : none">y</p>q', ["q"]),
        ('<p>1 < 2 and a="b" > c</p>', ['1 < 2 and a="b" > c']),
        ('<img alt="a > b" src=x>after', ["after"]),
        ('<p><i aria-hidden="true">*</i></p>', []),
    ],
)
def test_attributes_and_inline_names(html, want):
    assert kept(html) == want


def plain_length(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("bits", [1 << 28, 20])
def test_common_subsequence_whole_and_halved(monkeypatch, bits):
    monkeypatch.setattr(pages, "TRACE_BITS", bits)
    rng = np.random.default_rng(6)
    for _ in range(400):
        a, b = rng.integers(0, 5, rng.integers(0, 15)).tolist(), rng.integers(0, 6, rng.integers(0, 15)).tolist()
        got = pages.common_subsequence(a, b)
        assert len(got) == plain_length(a, b) and all(a[i] == b[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:], strict=False))


def test_pages_of_equal_lines(spark):
    start = time.time()
    assert len(pages.common_subsequence([1] * 20000, [0] + [1] * 20000 + [2])) == 20000
    assert time.time() - start < 5
    rows = [(k, f"http://h.example/a/{k}", "<p>same</p>" * 6000 + f"<p>only here {k} {'word ' * 20}</p>") for k in range(4)]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[k].startswith(f"only here {k}") for k in range(4))
