"""Secrets that no base pattern finds, judged at the threshold that production uses."""

import random
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerstar.llm import secrets

WORD = string.ascii_letters + string.digits
KINDS = {
    "cloud": ("", 40, WORD + "/+"),
    "personal": ("ghp_", 36, WORD),
    "random": ("", 24, WORD),
    "base32": ("", 20, string.ascii_uppercase + "234567"),
    "upper hex": ("", 32, "0123456789ABCDEF"),
    "service": ("sk-", 32, WORD),
    "signed": ("eyJhbGciOiJIUzI1NiJ9.", 80, WORD + "-_"),
}
SENTENCES = ["We found that {} was still in the old notes.", "Please send {} to the other team today.", "the value {} appears twice", "Yesterday ({}) it broke again"]
PLAIN = """internationalization responsibilities getElementById someone.else@mail.example.com https://www.example.com/en/23
abridged.chapters.and.verses src/main/java/org/apache/Spark.java /usr/local/share/applications 192.168.100.200
customer_order_line_items MAX_RETRY_COUNT_DEFAULT version-4.11.2-beta UNQUESTIONABLY straightforwardness
createDataFrameFromRows index.html?page=2 user-guide-2023.pdf state-of-the-art 1234567890123 Geschwindigkeitsbegrenzung
TransactionManagerFactory README_first.txt out-of-the-ordinary ACKNOWLEDGEMENTS thunderstorms""".split()


@pytest.fixture(scope="module")
def model(spark):
    return secrets.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def marked(spark, model, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secrets.find(docs, model).select("doc_id", F.filter("__spans", lambda s: s["kind"] == "model").alias("spans"))
    return {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.spans] for r in found.collect()}


@pytest.mark.parametrize("kind", KINDS)
def test_bare_secrets_are_found(spark, model, kind):
    rng, (prefix, n, alphabet) = random.Random(kind), KINDS[kind]
    keys = [prefix + "".join(rng.choices(alphabet, k=n)) for _ in range(200)]
    got = marked(spark, model, [SENTENCES[k % len(SENTENCES)].format(key) for k, key in enumerate(keys)])
    assert np.mean([any(len(s) > n // 2 for s in got[k]) for k in range(200)]) >= 0.9


def test_plain_runs_stay(spark, model):
    texts = [s.format(run) for run in PLAIN for s in SENTENCES]
    assert np.mean([bool(s) for s in marked(spark, model, texts).values()]) < 0.01


def test_words_of_the_corpus_stay(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = secrets.find(docs, model).select(F.size(F.filter("__spans", lambda s: s["kind"] == "model")).alias("n"))
    assert found.filter("n > 0").count() < 0.001 * docs.count()


def test_training_is_repeatable_and_kinds_are_kept_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    one, two = secrets.train(docs), secrets.train(docs.repartition(5))
    assert one.threshold == two.threshold and (one.net.p["k"] == two.net.p["k"]).all()
    assert not set(secrets.ALPHABETS) & set(secrets.KEPT_OUT)


def test_every_finding_and_candidate_is_learned(spark):
    rng = random.Random(8)
    value = lambda: "".join(rng.choices(WORD, k=24))
    rows = [(k, f"see token={value()} and {value()}") for k in range(6000)]
    rows += [(6000, " ".join(f"password={value()} in straight{'forward' * j}ness" for j in range(1, 9))), (6001, None), (6002, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = docs.select(F.shiftrightunsigned(F.xxhash64("text", F.lit(7)), 1).alias("order"), "text")
    dealt = secrets._dealt(texts.repartition(3).unionAll(texts.limit(500)), 4)
    left = [secrets._loaded(part) for _, part in dealt.toPandas().groupby("shard")]
    assert len(left) == 4
    y = np.concatenate([p[0] for p in left])
    # Repeated texts come once; the eight long words come once each, those over 40 characters in several windows.
    long = sum(len(secrets.windows(0, len("straight" + "forward" * j + "ness"))) for j in range(1, 9))
    assert np.bincount(y).tolist() == [6000, 6008, long]
    out = np.concatenate([p[2] for p in left])
    assert 0.2 < out.mean() < 0.3


def test_shards_learn_from_one_network_and_repeat(spark):
    rng = random.Random(9)
    words = ["letters", "straightforwardness", "internationalization", "src/main/java/org/Spark.java", "thunderstorms-in-spring", "ACKNOWLEDGEMENTS"]
    rows = [(k, f"{rng.choice(words)} token={''.join(rng.choices(WORD, k=24))} {rng.choice(words)} {k}") for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one, two = secrets.train(docs, shard=40_000), secrets.train(docs.repartition(5), shard=40_000)
    assert one.threshold == two.threshold and all((one.net.p[k] == two.net.p[k]).all() for k in one.net.p)
    first = secrets.train(docs)
    assert (first.net.p["k"] != one.net.p["k"]).any()
    keys = ["".join(rng.choices(WORD, k=24)) for _ in range(200)]
    found, plain = ([np.mean([bool(s) for s in marked(spark, m, [f"the value {k} appears" for k in some]).values()]) for m in (first, one)] for some in (keys, words))
    assert min(found) > 0.8 and max(plain) < 0.2 and abs(found[0] - found[1]) < 0.1


def test_varied_examples():
    rng = np.random.default_rng(2)
    text = 'a token = "0123456789abcdef" is é here'
    code = secrets.encode(text, 11, 27).tobytes()
    made = secrets.varied(rng, [code], ["wordsoflanguage"], list(secrets.ALPHABETS), 200)
    assert len(made) == 400 and sum(v for *_, v in made) == 200 and secrets.varied(rng, [], [], ["base62"], 9) == []
    for text, a, e, _ in made:
        assert e - a >= 12 and not secrets.CANDIDATE.match(text[a - 1 : a] * 12) and not secrets.CANDIDATE.match(text[e : e + 1] * 12)
