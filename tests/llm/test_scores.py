"""Models, top-k, mixing and page text on small tables and held-out labels."""

import collections
import itertools
import math
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerstar.llm import language, mixing, pages, quality, queries, secrets, topk, toxicity

SF01 = "/root/testdata/sf0.01"
SF1 = "/root/testdata/sf0.1"


def tokens_of(text):
    return [*(text or "").encode().lower().split(), None]


@pytest.fixture(scope="module")
def tree_case(spark):
    rng = random.Random(2)
    follow = {"the": ["cat", "dog"], "a": ["cat", "mouse"], "of": ["the", "a"]}
    rows = []
    for k in range(300):
        out = ["the"]
        for _ in range(rng.randrange(1, 60)):
            out.append(rng.choice(follow.get(out[-1], ["the", "a", "of", f"w{rng.randrange(300)}"])))
        rows.append((k, " ".join(out)))
    rows += [(400, None), (401, ""), (402, "The THE\tthe\x0bÉÉ"), (None, "the cat"), (3, "again of the"), (500, "the cat " * 3000)]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, score int")
    held = F.coalesce(F.col("doc_id") % 5 == 1, F.lit(False))
    tree = language.train(docs.filter(~held), p_min=0.01)
    return rows, tree, language.scored(docs, tree, held).collect()


def test_language_scores_equal_a_plain_tree(tree_case):
    rows, tree, got = tree_case
    train = [tokens_of(t) for i, t in rows if i is None or i % 5 != 1]
    count = collections.Counter(w for t in train for w in t)
    n, v = sum(count.values()), len(count)
    assert (tree.n, tree.v) == (n, v) and (tree.single > 0).any() and len(tree.pairs)
    hashed = {}
    for w in {w for _, t in rows for w in tokens_of(t)} - {None}:
        tok, _ = language.tokens(np.frombuffer(w, np.uint8), np.array([0, len(w)]))
        hashed[int(tok[0])] = w
    symbols = [hashed.get(int(s), "BEGIN") for s in tree.contexts.symbols]
    symbols[-1] = "BEGIN"
    k = len(symbols)
    after = collections.defaultdict(collections.Counter)
    for t in train:
        line = ["BEGIN", *t]
        for j in range(1, len(line)):
            after[(line[j - 1],)][line[j]] += 1
            if j > 1:
                after[(line[j - 2], line[j - 1])][line[j]] += 1
    ones = {(symbols[c],) for c in np.flatnonzero(tree.single)}
    twos = {(symbols[(c - k) // k], symbols[(c - k) % k]) for c in tree.pairs.tolist()}

    def p(word, context):
        if not context:
            return (count[word] + 0.5) / (n + 0.5 * (v + 1))
        seen = after[context]
        total, kinds = sum(seen.values()), len(seen)
        return (seen[word] + kinds * p(word, context[1:])) / (total + kinds)

    want = []
    for i, t in rows:
        line, base, score = ["BEGIN", *tokens_of(t)], 0.0, 0.0
        for j in range(1, len(line)):
            context = next((c for c in (tuple(line[max(0, j - 2) : j]), (line[j - 1],)) if c in twos or c in ones), ())
            base += math.log10(p(line[j], ()))
            score += math.log10(p(line[j], context))
        own = tokens_of(t)
        want.append((i, bool(i is not None and i % 5 == 1), len(own), sum(count[w] > 0 for w in own), n, round(base, 6), round(score, 6)))
    mine = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got]
    assert sorted(mine, key=str) == sorted(want, key=str)


def test_language_model_beats_token_frequencies(tree_case):
    held = [r for r in tree_case[2] if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_keeps_rare_contexts(spark):
    rng = random.Random(5)
    rows = [(k, " ".join(f"w{rng.randrange(400)}" for _ in range(60))) for k in range(200)]
    rows += [(200 + k, f"a{k} left middle one b{k} right middle two") for k in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = F.col("doc_id") == 209
    tree = language.train(docs.filter(~held))
    assert 9 < 1e-3 * tree.n  # each context is less than a thousandth of the tokens
    assert len(tree.pairs) == 2 and (tree.single > 0).sum() >= 3
    got = sorted(map(str, language.scored(docs, tree, held).collect()))
    one = language.scored_by_rest(docs, held)
    assert sorted(map(str, one.collect())) == got
    last = one.filter(held).first()
    assert last.score > last.base_score + 6


def test_language_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert language.scored(docs.limit(0), language.train(docs), F.lit(False)).count() == 0
    row = language.scored(docs, language.train(docs.limit(0)), F.lit(True)).first()
    assert row.n_known == 0 and row.n_tokens == 3 and math.isfinite(row.score)


TEXTS = [
    'é password = "abcdefghijkl" end', "token: short", "secret=token : abcdefghijklmnop", "API_KEY='0123456789abcdef0123'", "xAKIAABCDEFGHIJKLMN AKIA", "ſecret=abcdefghijklmnop",
    "deadbeefdeadbeef deadbeef", None, "", "nothing here", "😀 apikey:Zx9_qL0-vT7+pB3/ok tail",
]


def test_base_spans():
    got = [[(k, t[a:e]) for a, k, e in secrets.base_spans(t)] if t else [] for t in TEXTS]
    assert got[0] == [("assign", 'password = "abcdefghijkl')]
    assert got[1] == got[2] == got[5] == got[7] == got[8] == got[9] == []
    assert got[3] == [("assign", "API_KEY='0123456789abcdef0123"), ("hex", "0123456789abcdef0123")]
    assert got[4] == [("access", "AKIAABCDEFGHIJKLMN")]
    assert got[6] == [("hex", "deadbeefdeadbeef")]
    assert got[10] == [("assign", "apikey:Zx9_qL0-vT7+pB3/ok")]


def test_network_ranks_bare_secrets_above_plain_runs(spark):
    model = secrets.train(spark.read.parquet(f"{SF1}/documents.parquet"))
    rng = random.Random(3)
    keys = ["".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=19)) + "7" for _ in range(40)]
    plain = ["someone.else@mail.example.com", "https://www.example.com/en/23", "abridged.chapters.and.verses"]

    def probability(run):
        text = f"the word of {run} and the rest"
        return max(float(model.probabilities(secrets.encode(text, a, e)[None])[0]) for a, e in secrets.candidates(text, []))

    low = [probability(t) for t in plain]
    assert np.mean([[probability(k) > p for p in low] for k in keys]) > 0.8
    docs = spark.createDataFrame([(k, f"the word of {t} and the rest", "q") for k, t in enumerate(plain)], "doc_id long, text string, __x string")
    assert secrets.find(docs, model).filter(F.size("__spans") > 0).count() == 0


def test_redact(spark):
    docs = spark.createDataFrame([(k, t, 5) for k, t in enumerate(TEXTS)], "doc_id long, text string, n_chars long")
    out = {r.doc_id: r for r in secrets.redact(docs, None).collect()}
    assert out[0].text == 'é [secret]" end' and out[0].n_chars == 15
    assert out[3].text == "[secret]'" and out[7].text is None and out[8].text == "" and out[9].text == "nothing here"
    assert secrets.train(docs.limit(0)) is None
    assert secrets.find(docs.limit(0), None).count() == 0


def test_gradients_of_the_network():
    rng = np.random.default_rng(1)
    net, x, y = secrets.CharCNN(3), rng.integers(0, 256, (6, secrets.WIDTH)).astype(np.uint8), np.array([0, 1, 1, 0, 1, 0.0])
    loss = lambda: float(np.mean(np.logaddexp(0, net.logits(x)) - y * net.logits(x)))
    for name, g in net.gradients(x, y).items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = net.p[name][at]
        net.p[name][at] = old + 1e-5
        up = loss()
        net.p[name][at] = old - 1e-5
        assert g[at] == pytest.approx((up - loss()) / 2e-5, rel=1e-2, abs=1e-6)
        net.p[name][at] = old


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(k, [float(x) for x in rng.normal(size=6).round(1)]) for k in range(700)]
    rows += [(700, None), (800, [1.0, None]), (900, [float("nan")] * 6), (1000, [float("inf")] * 6), (1100, [2.0]), (1200, []), (1300, rows[5][1]), (1301, rows[5][1]), (1301, rows[5][1]), (None, rows[6][1])]
    clean = {i: [math.floor(1024 * x) for x in v] for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = set()
    for q, a in clean.items():
        if q % 100 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in clean.items() if i != q)[:10]
            want |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, block int")
    got = topk.top_k(frame, F.col("vec_id") % 100 == 0, block_rows=32, query_rows=3)
    assert {tuple(r) for r in got.collect()} == want
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    few = topk.top_k(frame.filter("vec_id IN (0, 1, 2)"), F.col("vec_id") % 100 == 0)
    assert [r.rank for r in few.orderBy("rank").collect()] == [1, 2]


def test_share_reaches_its_limits():
    assert mixing.share([100, 100], [5, 2], 150, 2) == pytest.approx([150 * 5 / 7, 150 * 2 / 7])
    assert mixing.share([10, 100, 0], [5, 2, 1], 165, 2) == pytest.approx([20, 145, 0])
    assert mixing.share([], [], 0, 2) == []


@pytest.mark.parametrize("seed", range(30))
def test_fit_is_the_best_subset_sum(seed):
    rng = random.Random(seed)
    lengths = np.array(sorted(rng.sample(range(1, 40), 4)))
    counts = np.array([rng.randrange(1, 4) for _ in lengths])
    budget = rng.randrange(0, int((lengths * counts).sum()) + 10)
    take = mixing.fit(lengths, counts, budget)
    assert (take >= 0).all() and (take <= counts).all()
    best = max(s for c in itertools.product(*(range(x + 1) for x in counts)) if (s := int((lengths * np.array(c)).sum())) <= budget)
    assert int((lengths * take).sum()) == best


def test_fit_of_large_budgets_leaves_nothing():
    rng = np.random.default_rng(0)
    lengths = np.arange(1, 5000)
    counts = rng.integers(1, 50, len(lengths))
    for budget in (10**6, 123_456_789, 250_000_001):
        assert int((lengths * mixing.fit(lengths, counts, budget)).sum()) == min(budget, int((lengths * counts).sum()))


def test_mix(spark):
    rng = random.Random(1)
    rows = [(k, " ".join(["w"] * rng.randrange(0, 50)), rng.choice(["a", "a", "a", "b", "é", None])) for k in range(600)]
    rows += [(1, rows[1][1], rows[1][2]), (None, "x y z", "a"), (700, None, "b"), *[(k, "same words in all", "b") for k in range(800, 1200)]]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int")
    out = [r.asDict() for r in mixing.mix(docs).collect()]
    assert len(out) == len(rows)
    size = collections.Counter()
    for i, t, s in rows:
        size[s] += len((t or "").split())
    order = ["a", "b", "é", None]
    want = dict(zip(order, mixing.share([size[s] for s in order], [5, 2, 1, 5], 1.5 * sum(size.values()), 2), strict=True))
    for s in order:
        mine = [r for r in out if r["source"] == s]
        assert {r["__source_size"] for r in mine} == {size[s]} and mine[0]["__target"] == pytest.approx(want[s])
        assert abs(sum(r["__taken"] for r in mine) - want[s]) <= 1
        assert all(r["__taken"] in (0, r["__size"], 2 * r["__size"]) and r["__size"] == len((r["text"] or "").split()) for r in mine)
    again = mixing.mix_sizes(docs.repartition(7)).select("doc_id", "source", "__size", "__taken").collect()
    key = lambda r: str((r["doc_id"], r["source"], r["__size"], r["__taken"]))
    assert sorted(map(key, again)) == sorted(map(key, out))
    assert mixing.mix(docs.limit(0)).count() == 0


PAGE = '<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><a href="/">Home</a></nav><div class="x">{top}</div><div><h2>{k}</h2><p>Text {k} &amp; more\n of&nbsp;it<p><b>Second {k}<br>line</div><div id="comments">bad</div><footer>&copy; me</footer></body></html>'


def test_page_differencing(spark):
    rows = [(k, f"http://www.h.com/a/{k}.html?q=1", PAGE.format(top="Buy now", k=k)) for k in range(9)]
    rows += [(20, "http://other.org/x", "<p>Buy now</p><p>Alone"), (21, None, None), (22, "http://h.com/zz", ""), (23, "http://h.com/zz", "<!-- x --><p></p> <"), (3, rows[3][1], rows[3][2])]
    article = "<body><p>Shared</p><article><h1>Shared</h1><p>Own words of page {k}</p><aside>no</aside></article>"
    rows += [(30 + k, f"http://art.com/{k}", article.format(k=k)) for k in range(2)]
    rows += [(40, "http://copy.com/1", "<p>All of it</p><p>is copied"), (41, "http://copy.com/2", "<p>All of it</p><p>is copied")]
    got = {(r.page_id, r.text) for r in pages.main_text(spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")).collect()}
    want = {(k, f"{k}\nText {k} & more of it\nSecond {k} line") for k in range(9)}
    want |= {(20, "Buy now\nAlone"), (21, ""), (22, ""), (23, "<"), (30, "Shared\nOwn words of page 0"), (31, "Shared\nOwn words of page 1"), (40, "All of it\nis copied"), (41, "All of it\nis copied")}
    assert got == want
    assert pages.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_common_subsequence_is_longest():
    rng = random.Random(9)
    for _ in range(200):
        a, b = [rng.choices("abc", k=rng.randrange(9)) for _ in range(2)]
        best = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
        for i, j in itertools.product(range(len(a)), range(len(b))):
            best[i + 1, j + 1] = best[i, j] + 1 if a[i] == b[j] else max(best[i, j + 1], best[i + 1, j])
        got = pages.common_subsequence(a, b)
        assert len(got) == best[-1, -1] and all(a[i] == b[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:], strict=False))


def accuracy(rows: pd.DataFrame, label: str) -> float:
    held = rows[rows.held_out]
    return float((held.predicted == held[label]).mean())


ODD = [(1, None), (2, ""), (3, " \n "), (4, "x" * 300_000), (5, "\x00é😀"), (5, "\x00é😀"), (None, "some words")]


def odd_scores(spark, module, model):
    docs = spark.createDataFrame([(*r, 0.5) for r in ODD], "doc_id long, text string, score double")
    got = module.scored(docs, model)
    assert got.columns == [*docs.columns, "__score"]
    scores = [r["__score"] for r in got.collect()]
    assert len(scores) == len(ODD) and all(0 <= s <= 1 for s in scores)
    assert module.scored(docs.limit(0), model).count() == 0
    assert all(r["__score"] == 0 for r in module.scored(docs, None).collect())


def test_toxicity_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF1}/documents.parquet"), spark.read.parquet(f"{SF1}/labels.parquet")
    held = queries.hash_fold("doc_id", 3) == 1
    model = toxicity.train(docs, labels.filter(~held))
    got = toxicity.scored(docs.select("doc_id", "text"), model).join(labels, "doc_id").select(held.alias("held_out"), "toxic", (F.col("__score") >= 0.7).cast("int").alias("predicted")).toPandas()
    assert accuracy(got, "toxic") > 0.93
    assert ((got.predicted == 1) & (got.toxic == 0)).mean() < 0.01
    unseen = ["what an idi0t you are", "such a path3tic thing", "lооk at this of the and"]
    assert len(toxicity.scored(spark.createDataFrame([(k, t) for k, t in enumerate(unseen)], "doc_id long, text string"), model).collect()) == 3
    odd_scores(spark, toxicity, model)
    assert toxicity.train(docs, labels.limit(0)) is None


def test_a_toxic_score_does_not_depend_on_the_texts_beside_it():
    rng = np.random.default_rng(1)
    model = toxicity.Model(rng.normal(size=1 << toxicity.BUCKET_BITS).astype(np.float32), 0.1, 2.0, -0.5)
    texts = ["one two three", "three two one one", "", "one", None, "one one", "  ", "two one " * 40, "two one"]
    together = model.scores(*toxicity.text_buffer(pa.array(texts, pa.string())))
    alone = [model.scores(*toxicity.text_buffer(pa.array([t], pa.string())))[0] for t in texts]
    assert together.tolist() == alone


def test_quality_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    held = queries.hash_fold("doc_id", 5) == 0
    model = quality.train(docs, labels.filter(~held))
    got = quality.scored(docs.select("doc_id", "text"), model).join(labels, "doc_id").select(held.alias("held_out"), "quality", (F.col("__score") >= 0.3).cast("int").alias("predicted")).toPandas()
    assert accuracy(got, "quality") > 0.95
    odd_scores(spark, quality, model)
    assert quality.train(docs, labels.limit(0)) is None
