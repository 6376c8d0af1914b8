"""SimHash, containment and suffix operators against brute force on small tables."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerstar.llm import decontaminate, simhash, suffixes

DOCS = "doc_id long, text string, fp string, component_id int, root string"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def fixture(seed=3, n=60):
    rng = random.Random(seed)
    rows = [(k, words(rng, rng.randrange(1, 120))) for k in range(n)]
    long = words(rng, 900)
    for k in range(n, n + 25):  # near copies in a chain: a word changes each time
        parts = long.split()
        parts[rng.randrange(900)] = "changed"
        long = " ".join(parts)
        rows.append((k, long.upper() if k % 2 else long))
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "one two"), (204, "one two"), (204, "one two"), (None, "one two"), (None, "alone in null land here"), (205, rows[3][1])]
    rows.append((206, "Ünïcode Éé " * 30))
    return [(i, t, "x", 1, "y") for i, t in rows]


def simhash_of(text):
    parts = (text or "").translate({c: c + 32 for c in range(65, 91)})
    parts = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", parts) if w]
    if not parts:
        return 0
    grams = [" ".join(parts[k : k + 4]) for k in range(max(1, len(parts) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, bits=4):
    fps = [simhash_of(r[1]) for r in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if bin(fps[a] ^ fps[b]).count("1") <= bits:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for g, r in zip(group, rows, strict=True):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    return [(r[0], f, least.get(g)) for r, f, g in zip(rows, fps, group, strict=True)]


def test_near_duplicates_equal_brute_force(spark):
    rows = fixture()
    got = simhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    key = lambda t: tuple((x is None, x or 0) for x in t)
    mine = sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=key)
    assert mine == sorted(brute_components(rows), key=key)


@pytest.mark.parametrize("count", [2, 3, 4, 5])
def test_links_equal_all_pairs_for_any_segment_count(spark, count):
    rng = random.Random(count)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(7))) for b in base for _ in range(6)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = {(u, v) for u in signed for v in signed if u < v and bin((u ^ v) % 2**64).count("1") <= 4}
    got = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), 4, count)
    assert {(r.u, r.v) for r in got.collect()} == want


def test_keep_one_keeps_one_row_of_each_component(spark):
    rows = fixture()
    docs = spark.createDataFrame(rows, DOCS)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(str(r.doc_id) for r in kept.collect())
    groups = {(c, None if c is not None else f) for _, f, c in brute_components(rows)}
    assert got == sorted(str(c) for c, _ in groups)
    assert kept.filter("doc_id = 203").first().text == "one two"


def test_simhash_of_an_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0


def brute_contained(docs, items, size=5, threshold=0.8):
    def shingles(texts):
        out = set()
        for t in texts:
            w = [x for x in __import__("regex").split(r"[^\p{L}\p{N}]+", (t or "").lower()) if x]
            if w:
                out |= {" ".join(w[k : k + size]) for k in range(max(1, len(w) - size + 1))}
        return out

    by = lambda rows: {i: shingles([r[1] for r in rows if r[0] == i]) for i in {r[0] for r in rows} - {None}}
    d, b = by(docs), by(items)
    return {(i, j, len(s), len(s & t)) for i, t in d.items() for j, s in b.items() if s and len(s & t) >= threshold * len(s)}


def test_contained_items_equal_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    items = [(k, words(rng, rng.randrange(6, 60), 3000)) for k in range(30)]
    items += [(30, None), (31, ""), (32, "just three words"), (33, "just three words"), (None, words(rng, 9)), (34, items[2][1])]
    docs = []
    for k in range(80):
        body = words(rng, rng.randrange(5, 300), 3000).split()
        if k % 2:
            item = items[rng.randrange(30)][1].split()
            for _ in range(rng.randrange(3)):
                item[rng.randrange(len(item))] = "other"
            at = rng.randrange(len(body))
            body[at:at] = item
        docs.append((k, " ".join(body).title() if k % 3 else ", ".join(body)))
    docs += [(90, None), (91, ""), (92, "Just three: words!"), (None, items[0][1]), (93, items[4][1]), (93, "a second row")]
    want = brute_contained(docs, items)
    for limit in (decontaminate.BROADCAST_ROWS, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
        got = decontaminate.contained_items(spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int"), spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int"))
        assert {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in got.collect()} == want
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    left = decontaminate.drop_contaminated(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id for r in left.collect()} == {d[0] for d in docs} - {w[0] for w in want}


def test_containment_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.contained_items(docs.limit(0), items).count() == 0
    assert decontaminate.contained_items(docs, items.limit(0)).count() == 0


def test_containment_stays_on_the_jvm(spark):
    docs, items = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    plan = decontaminate.drop_contaminated(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def brute_kept(rows, length):
    least = {}
    order = [((1 << 63) - 1 if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in order:
        for a in range(len(t) - length + 1):
            s = t[a : a + length]
            least[s] = min(least.get(s, (i, a)), (i, a))
    out = []
    for i, t in order:
        gone = np.zeros(len(t), dtype=int)
        for a in range(len(t) - length + 1):
            if least[t[a : a + length]] < (i, a):
                gone[a : a + length] = 1
        kept = np.frombuffer(t, np.uint8)[gone == 0].tobytes()
        spans = int((np.diff(np.r_[0, gone]) == 1).sum())
        out.append((None if i == (1 << 63) - 1 else i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("length", "in_place"), [(100, 4096), (100, 2), (40, 3)])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, length, in_place):
    monkeypatch.setattr(suffixes, "IN_PLACE", in_place)
    rng = random.Random(length + in_place)
    shared = [words(rng, 40, 90) for _ in range(4)]
    rows = []
    for k in range(60):
        parts = [words(rng, rng.randrange(1, 60), 90) for _ in range(2)]
        if k % 3:
            parts.insert(1, shared[rng.randrange(4)][rng.randrange(30) :])
        if k % 5 == 0:
            parts.append(rng.choice(shared))
        rows.append((rng.randrange(10_000), "é".join(parts)))
    rows = list({i: (i, t) for i, t in rows}.values())
    rows += [(20_000, rows[0][1]), (20_001, "ab" * 300), (20_002, "x" * 99), (20_003, "x" * 250), (20_004, None), (20_005, ""), (None, rows[1][1]), (20_001, "ab" * 300), (20_006, rows[2][1]), (20_006, words(rng, 50))]
    got = suffixes.deduplicated(spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, bucket string"), length)
    got = got.select("doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_kept(rows, length)


def test_merge_orders_front_coded_runs():
    rng = random.Random(1)
    runs = [sorted(bytes(rng.choices(b"ab", k=rng.randrange(1, 12))) for _ in range(rng.randrange(40))) for _ in range(7)]
    coded = [iter([(0 if not k else suffixes._common(r[k - 1], r[k], 0), s) for k, s in enumerate(r)]) for r in runs]
    got = list(suffixes.merged(coded))
    keys = [k for _, k in got]
    assert keys == sorted(s for r in runs for s in r)
    assert [s for s, _ in got][1:] == [suffixes._common(a, b, 0) for a, b in zip(keys, keys[1:], strict=False)]
    assert list(suffixes.merged([])) == []


def test_suffix_dedup_of_an_empty_table(spark):
    assert suffixes.deduplicated(spark.createDataFrame([], "doc_id long, text string")).count() == 0
