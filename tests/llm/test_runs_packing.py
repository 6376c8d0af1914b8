"""Periodic runs against brute force, packing against the tokenizer applied to whole texts."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerstar.llm import packing, periodic
from ledgerstar.llm.queries import op11_periodic_runs, op13_packing, with_planted_period

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, runs string, length int, ids string"


def brute_runs(w, min_length=6, min_exponent=4):
    out = []
    for q in range(1, len(w) // min_exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(min_length, min_exponent * q):
                if not any(all(w[i + k] == w[i + k + p] for k in range(length - p)) for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapse(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return b" ".join(x for k, x in enumerate(w) if k not in gone)


def random_words(rng, n, alphabet):
    out = []
    while len(out) < n:
        root = [rng.choice(alphabet) for _ in range(rng.randrange(1, 6))]
        out += root * (rng.randrange(1, 7) if rng.random() < 0.5 else 1)
    return out[:n]


@pytest.mark.parametrize("least", [(6, 4), (2, 2), (1, 3)])
def test_runs_equal_brute_force(least):
    rng = random.Random(11)
    for _ in range(600):
        w = random_words(rng, rng.randrange(0, 70), [b"a", b"b", b"c", b"d"][: rng.randrange(1, 5)])
        assert periodic.runs_of(w, *least) == brute_runs(w, *least)


def test_suffix_tree_compares_all_suffixes():
    rng = random.Random(5)
    for n in (1, 2, 7, 60, 300):
        s = [rng.randrange(1, 3) for _ in range(n)]
        tree = periodic.SuffixTree([*s, 0], 3)
        pairs = [(i, j) for i in range(n) for j in range(n) if i != j]
        got = tree.lce(np.array([p[0] for p in pairs] or [0]), np.array([p[1] for p in pairs] or [n])).tolist()
        for (i, j), common in zip(pairs, got, strict=False):
            want = 0
            while max(i, j) + want < n and s[i + want] == s[j + want]:
                want += 1
            assert common == want
        by_suffix = sorted(range(n + 1), key=lambda k: [*s, 0][k:])
        assert np.argsort(tree.ranks()).tolist() == by_suffix
        opposite = sorted(range(n + 1), key=lambda k: [3 - x if x else 0 for x in [*s, 0]][k:])
        assert np.argsort(tree.ranks(opposite=True)).tolist() == opposite


def test_range_minima():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 1000, 500).astype(np.int32)
    least = periodic.RangeMin(values)
    lo, hi = np.sort(rng.integers(0, 500, (2, 4000)), axis=0)
    assert least(lo, hi).tolist() == [values[a : b + 1].min() for a, b in zip(lo, hi, strict=True)]


def test_long_periodic_texts():
    w = [b"x"] * 30000
    assert periodic.runs_of(w) == [(0, 30000, 1)]
    root = [str(k).encode() for k in range(777)]
    w = root * 9 + root[:100]
    assert periodic.runs_of([b"before", *w, b"after"]) == [(1, 777 * 9 + 100, 777)]
    assert periodic.collapse(w, periodic.runs_of(w)) == root


def digest(lines):
    return hashlib.sha256(lines).hexdigest()


def test_op11_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in op11_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    planted = 0
    for doc_id, text in docs:
        w = (text or "").encode().split()
        h, n = zlib.crc32(str(doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs, r = brute_runs(w), got[doc_id]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else None
        want = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r.n_runs, (r.start, r["length"], r.period, r.exponent_milli)) == (len(runs), want)
        assert r.runs_sha256 == digest("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode())
        assert r.collapsed_sha256 == digest(brute_collapse(w, runs))
    assert planted > 5 and sum(r.n_runs for r in got.values()) > planted // 2


def test_runs_of_odd_inputs(spark):
    rows = [(1, None, "x", 1, "y"), (2, "", "x", 1, "y"), (3, " \t\n", "x", 1, "y"), (4, "a b " * 8, "x", 1, "y"), (4, "a b " * 8, "x", 1, "y"), (None, "é " * 9, "x", 1, "y"), (5, None, None, None, None)]
    got = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.find_runs(spark.createDataFrame(rows, DOCS)).collect())
    assert got == [(0, 9, [(0, 9, 1)], "é"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 16, [(0, 16, 2)], "a b"), (4, 16, [(0, 16, 2)], "a b"), (5, 0, [], "")]
    empty = spark.createDataFrame([], DOCS)
    assert periodic.find_runs(empty).count() == 0
    assert with_planted_period(None, []) == [] and with_planted_period(None, [b"a", b"b"]) == [b"a", b"a"]
    with pytest.raises(ValueError):
        periodic.find_runs(empty, min_exponent=1)


ODD = [
    "", "One, two; three... FOUR?! it's they'll 'quoted' end", "Ünïcode Ñandú ÉCOLE straße ẞ K İstanbul ǰ J̌ á   nbsp", "tabs\tand\x0bvt\x0cff\r\nlines\x1cfs\x85nel",
    "a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|> <|x|>", "日本語 テキスト 한국어 😀😀 é̂", "x1y2z3 12.5% a-b_c (d) [e] {f}", "word." * 50, "..., !!! ?;: .a. ,b", "ñ ̃ ̃a", "ΑΣ ΣΑΣ. ﬁ ª º ² ½",
]


def test_ids_equal_those_of_whole_texts(spark):
    plain = Tokenizer.from_file(TOKENIZER)
    docs = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect() if r.text]
    encoder = packing.Encoder(TOKENIZER)
    assert encoder.by_word
    for texts in (ODD, docs, [" ".join(ODD), *docs[:20]]):
        want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
        got = [np.frombuffer(i, "<u4").tolist() for i in encoder.encode([t.encode() for t in texts])]
        assert got == want


def test_long_texts_go_by_chunks(monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_BYTES", 50)
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    plain, encoder = Tokenizer.from_file(TOKENIZER), packing.Encoder(TOKENIZER)
    text = " ".join(ODD * 3) + " " + "verylongword" * 20 + " end"
    assert np.frombuffer(next(encoder.encode([text.encode()])), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, plain = packing.Encoder(path), Tokenizer.from_file(path)
    assert not encoder.by_word
    assert [np.frombuffer(i, "<u4").tolist() for i in encoder.encode([t.encode() for t in ODD])] == [plain.encode(t, add_special_tokens=False).ids for t in ODD]


def test_piece_lengths():
    for n in [*range(1, 300), 4095, 4096, 4097, 20001]:
        for most in (1, 8, 4096):
            parts = packing.piece_lengths(n, most)
            assert sum(parts) == n and all(p & (p - 1) == 0 and p <= most for p in parts)
            small = [p for p in parts if p < most]
            assert parts == sorted(parts, reverse=True) and len(set(small)) == len(small)


def check_packing(rows, pieces, most):
    plain = Tokenizer.from_file(TOKENIZER)
    want = sorted((i if i is not None else -1, (*plain.encode(t or "", add_special_tokens=False).ids, 2)) for i, t in rows)
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    assert all(p.offset == 0 and p.length <= most and p.length & (p.length - 1) == 0 and len(p.ids) == 4 * p.length for p in pieces)
    assert sum(p.length for p in pieces) == sum(len(ids) for _, ids in want)
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id if p.doc_id is not None else -1, []).append(p)
    for doc_id, ids in want:
        of = sorted((p.start, p.sequence_id, p) for p in by_doc[doc_id] if p.doc_tokens == len(ids))
        assert {p.start for _, _, p in of if tuple(np.frombuffer(p.ids, "<u4")) == ids[p.start : p.start + p.length]} == {p.start for _, _, p in of}
        assert sorted({(p.start, p.length) for _, _, p in of}) == sorted(zip(np.cumsum([0, *packing.piece_lengths(len(ids), most)[:-1]]).tolist(), packing.piece_lengths(len(ids), most), strict=True))


def test_packing_keeps_every_token(spark):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(50, None), (51, "again"), (51, "again"), (None, "no id here at all")]
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], DOCS).repartition(3)
    check_packing(rows, packing.pack(docs, TOKENIZER, most=8).collect(), 8)
    assert packing.pack(docs.limit(0), TOKENIZER).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, TOKENIZER, most=100)


def test_op13_on_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    pieces = packing.pack(spark.read.parquet(f"{SF}/documents.parquet"), TOKENIZER).collect()
    check_packing(rows, pieces, 4096)
    crc = {(p.doc_id, p.start): zlib.crc32(p.ids) for p in pieces}
    assert {(r.doc_id, r.start): r.ids_crc32 for r in op13_packing(spark, SF).collect()} == crc


def test_buckets_hold_equal_lengths(spark, tmp_path):
    packed = packing.pack(spark.read.parquet(f"{SF}/documents.parquet"), TOKENIZER, most=256)
    packing.write_buckets(packed, str(tmp_path / "sequences"))
    back = spark.read.parquet(str(tmp_path / "sequences"))
    assert back.count() == packed.count() and back.filter("octet_length(ids) <> 4 * length").count() == 0
