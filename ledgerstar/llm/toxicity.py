"""Toxicity by subword-bag embeddings averaged into a linear softmax.

Every word, with its boundaries, is a bag of character n-grams; each n-gram has
an embedding in a hashed table. The embeddings of a window of words are
averaged and go through a linear softmax; table and softmax are trained
jointly. A misspelling never seen in training shares most of its n-grams, and so
their vectors, with the word it hides. A document scores as its most toxic window.

Labels mark documents, not windows: after a first fit in which all windows of a
toxic document count as toxic, windows that the model finds clean are left out
(each toxic document keeps its highest one) and the model is fitted again. Each
half of the sample is judged by the model of the other half, so that memorised
windows don't confirm themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstar.llm.common import LOWER, SPACE, mix64, pack, sliced, text_buffer, unpack

#: Largest training sample, documents of each class (those with the least id hash).
SAMPLE_PER_CLASS = 800
#: Text of each class in the training sample, in bytes: documents are taken until they reach it, each with all its windows.
SAMPLE_BYTES = 8 << 20
BUCKET_BITS = 17
DIM = 8
SIZES = (3, 4, 5)
#: Words in half a window; windows overlap by half.
HALF = 16
#: An n-gram is learned when this many sampled documents have it: rarer ones tell documents apart, not toxicity.
LEAST_DOCS = 4
#: Text scored at once inside a task: the arrays of a piece take about 60 times its size.
SCORE_BYTES = 1 << 19
#: Added to the number of n-grams when a window is averaged, so that a window of a few n-grams isn't extreme.
PRIOR = 150


def ngrams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(position, bucket) of every n-gram inside a word and its boundaries, for each size."""
    # One space before and after every text: boundaries, and no n-gram spans two texts.
    n_docs = len(offsets) - 1
    grown = np.full(len(data) + n_docs + 1, 0x20, dtype=np.uint8)
    doc = np.repeat(np.arange(n_docs), np.diff(offsets))
    grown[np.arange(len(data)) + doc + 1] = np.where(SPACE[data], np.uint8(0x20), LOWER[data])
    space = grown == 0x20
    echo = _echoes(grown, space, offsets[:-1] + np.arange(n_docs))
    h = grown.astype(np.uint64)
    for n in range(2, max(SIZES) + 1):
        h = h[:-1] * np.uint64(0x100000001B3) + grown[n - 1 :] + np.uint64(n)
        if n in SIZES:
            inner = np.zeros(len(h), dtype=bool)
            for k in range(1, n - 1):
                inner |= space[k : k + len(h)]
            at = np.flatnonzero(~(inner | echo[1 : 1 + len(h)]))
            yield at, (mix64(h[at]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def _echoes(grown: np.ndarray, space: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Bytes of words that repeat one of the two words before: a repeated word says nothing new, but would fill a window's average.

    ``firsts``: where each text starts; a word only repeats words of its own text.
    """
    edge = np.flatnonzero(np.diff(np.r_[True, space, True].astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    if not len(start):
        return np.zeros(len(grown), dtype=bool)
    place = np.arange(len(grown)) - np.repeat(np.r_[0, start], np.diff(np.r_[0, start, len(grown)]))
    digest = np.r_[np.uint64(0), np.cumsum(mix64(grown.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(8))))]
    word = digest[end] - digest[start]
    text = np.searchsorted(firsts, start, side="right")
    same = np.zeros(len(word), dtype=bool)
    for back in (1, 2):
        same[back:] |= (word[back:] == word[:-back]) & (text[back:] == text[:-back])
    mark = np.zeros(len(grown) + 1, dtype=np.int8)
    mark[start[same]] += 1
    mark[end[same]] -= 1
    return np.cumsum(mark[:-1]).astype(bool)


def half_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of the grown buffer its half window (numbered over all texts); first half window of each text."""
    n_docs = len(offsets) - 1
    word = ~SPACE[data]
    start = word & np.r_[True, ~word[:-1]] if len(data) else word
    doc = np.repeat(np.arange(n_docs), np.diff(offsets))
    full = offsets[:-1][np.diff(offsets) > 0]
    start[full] = word[full]
    count = np.cumsum(start)
    base = np.r_[0, count][offsets]  # words before each text
    own = np.maximum(count - base[:-1][doc] - 1, 0) // HALF
    per_doc = np.maximum(1, -(-np.diff(base) // HALF))
    first = np.r_[0, np.cumsum(per_doc)]
    grown = np.zeros(len(data) + n_docs + 1, dtype=np.int64)
    where = np.arange(len(data)) + doc + 1
    grown[where] = own + first[:-1][doc]
    # The space before a text belongs to its first half window.
    grown[offsets[:-1] + np.arange(n_docs)] = first[:-1]
    return grown, first


@dataclass(frozen=True)
class Model:
    table: np.ndarray  # each bucket's embedding times the softmax's weight difference
    bias: float
    slope: float
    shift: float

    def window_logits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half, first = half_windows(data, offsets)
        total, n = np.zeros(first[-1]), np.zeros(first[-1])
        for at, bucket in ngrams(data, offsets):
            where = half[at]
            total += np.bincount(where, weights=self.table[bucket], minlength=len(total))
            n += np.bincount(where, minlength=len(n))
        last = np.zeros(len(total), dtype=bool)
        last[first[1:] - 1] = True
        pair_sum, pair_n = total.copy(), n.copy()
        pair_sum[:-1] += np.where(last[:-1], 0, total[1:])
        pair_n[:-1] += np.where(last[:-1], 0, n[1:])
        return pair_sum / (pair_n + PRIOR) + self.bias, first

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        logits, first = self.window_logits(data, offsets)
        best = np.maximum.reduceat(logits, first[:-1]) if len(logits) else logits
        return 1 / (1 + np.exp(-np.clip(self.slope * best + self.shift, -60, 60)))


def _bags(texts: DataFrame) -> DataFrame:
    """(label, bags): for each sampled text the buckets of its n-grams by half window, and how many each half window has, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, limit=1):
            data, offsets = text_buffer(batch.column("text"))
            half, first = half_windows(data, offsets)
            where, bucket = (np.concatenate(c) for c in zip(*((half[at], b) for at, b in ngrams(data, offsets)), strict=True))
            bags = pack(bucket[np.argsort(where, kind="stable")], np.bincount(where, minlength=int(first[-1])))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array([bags], pa.binary())], names=["label", "bags"])

    return texts.select("label", "text").mapInArrow(run, "label int, bags binary")


@dataclass(frozen=True)
class _Windows:
    """All windows of the sample: learned n-grams by half window. Window w has the half windows from w up to ends[w]."""

    bucket: np.ndarray
    cuts: np.ndarray  # where each half window's n-grams begin
    ends: np.ndarray
    n: np.ndarray  # all n-grams of each window, learned or not

    def bags(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``pick``, bucket) of every learned n-gram of the picked windows."""
        lens = self.cuts[self.ends[pick]] - self.cuts[pick]
        at = np.repeat(self.cuts[pick] - np.r_[0, np.cumsum(lens)[:-1]], lens) + np.arange(lens.sum())
        return np.repeat(np.arange(len(pick)), lens), self.bucket[at]

    def logits(self, net: _Net) -> np.ndarray:
        picks = (np.arange(lo, min(lo + 2048, len(self.n))) for lo in range(0, len(self.n), 2048))
        return np.concatenate([net.logits(*self.bags(pick), self.n[pick]) for pick in picks])


class _Net:
    """Embeddings, their mean over a bag, a linear softmax of two classes; trained by Adagrad on mini-batches."""

    def __init__(self, size: int, seed: int):
        rng = np.random.default_rng(seed)
        self.e = rng.normal(0, 0.1, (size, DIM)).astype(np.float32)
        self.w = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32)
        self.c = np.zeros(2)
        self.ge, self.gw, self.gc = np.full(size, 1e-8), np.full((DIM, 2), 1e-8), np.full(2, 1e-8)

    def logits(self, window: np.ndarray, bucket: np.ndarray, n: np.ndarray) -> np.ndarray:
        z, out = self.e @ self.w, np.zeros((len(n), 2))
        for lo in range(0, len(window), 1 << 20):
            piece = slice(lo, lo + (1 << 20))
            for k in (0, 1):
                out[:, k] += np.bincount(window[piece], weights=z[bucket[piece], k], minlength=len(n))
        return out / (n + PRIOR)[:, None] + self.c

    def step(self, window, bucket, n, y, weight, rate=0.5):
        logits = self.logits(window, bucket, n)
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = p
        g[np.arange(len(y)), y] -= 1
        g *= (weight / weight.sum())[:, None]
        per = g / (n + PRIOR)[:, None]
        # An embedding's gradient is the sum, over the windows that hold it, of the softmax's weights times their errors.
        s = np.stack([np.bincount(bucket, weights=per[window, k], minlength=len(self.e)) for k in (0, 1)], axis=1)
        de, dw, dc = s @ self.w.T.astype(np.float64), self.e.T.astype(np.float64) @ s, g.sum(axis=0)
        self.ge += (de**2).mean(axis=1)
        self.gw += dw**2
        self.gc += dc**2
        self.e -= (rate * de / np.sqrt(self.ge)[:, None]).astype(np.float32)
        self.w -= (rate * 0.2 * dw / np.sqrt(self.gw)).astype(np.float32)
        self.c -= rate * 0.2 * dc / np.sqrt(self.gc)


def _fit_net(windows: _Windows, y, weight, seed, steps=200, size=512) -> _Net:
    """``steps`` mini-batches, however small the sample is."""
    net, rng = _Net(int(windows.bucket.max(initial=0)) + 1, seed), np.random.default_rng(seed)
    used = np.flatnonzero(weight > 0)
    for _ in range(-(-steps * size // max(1, len(used)))):
        order = rng.permutation(used)
        for lo in range(0, len(order), size):
            pick = order[lo : lo + size]
            net.step(*windows.bags(pick), windows.n[pick], y[pick], weight[pick])
    return net


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic fit of y on x: penalised Newton steps on standardised x, halved while they don't help."""
    mean, spread = float(x.mean()), float(x.std()) + 1e-9
    z, at = (x - mean) / spread, np.zeros(2)

    def loss(a: np.ndarray) -> float:
        t = a[0] * z + a[1]
        return float((weight * (np.logaddexp(0, t) - y * t)).sum() + 0.5 * (a[0] ** 2 + a[1] ** 2))

    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(at[0] * z + at[1], -60, 60)))
        r, v = weight * (p - y), weight * p * (1 - p)
        grad = np.array([(r * z).sum(), r.sum()]) + at
        hess = np.array([[(v * z * z).sum() + 1, (v * z).sum()], [(v * z).sum(), v.sum() + 1]])
        step = np.linalg.solve(hess, grad)
        while loss(at - step) > loss(at) and np.abs(step).max() > 1e-9:
            step = step / 2
        at = at - step
        if np.abs(step).max() < 1e-7:
            break
    slope = max(at[0], 1e-3) / spread
    return float(slope), float(at[1] - slope * mean)


def train(docs: DataFrame, labels: DataFrame, seed: int = 7, per_class: int = SAMPLE_PER_CLASS) -> Model | None:
    """Fit on at most ``per_class`` labelled documents of each class, with all their windows; None when a class has no document.

    ``docs`` needs doc_id and text, ``labels`` doc_id and toxic. A document labelled twice counts as toxic when any
    label says so; null labels and ids are left out.
    """
    spark = docs.sparkSession
    known = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    order = F.xxhash64("doc_id", F.lit(seed))
    chosen = known.filter("label = 0").orderBy(order, "doc_id").limit(per_class).unionAll(known.filter("label = 1").orderBy(order, "doc_id").limit(per_class))
    ids = sorted((r["label"], r["at"], r["doc_id"]) for r in chosen.withColumn("at", order).collect())
    if not ids:
        return None
    sizes = docs.join(F.broadcast(spark.createDataFrame([(i,) for *_, i in ids], "doc_id long")), "doc_id").groupBy("doc_id").agg(F.sum(F.octet_length("text")).alias("n"))
    sizes, taken, within = {r["doc_id"]: r["n"] or 0 for r in sizes.collect()}, [0, 0], []
    for label, _, i in ids:
        if i in sizes and taken[label] < SAMPLE_BYTES:
            taken[label] += sizes[i]
            within.append((i, label))
    if {label for _, label in within} != {0, 1}:
        return None
    sample = spark.createDataFrame(within, "doc_id long, label int")
    bags = [(r["label"], unpack(r["bags"])) for r in _bags(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")).collect()]
    bags.sort(key=lambda r: (r[0], len(r[1][0]), r[1][0].tobytes(), r[1][1].tobytes()))
    spread = np.zeros(1 << BUCKET_BITS, dtype=np.int32)  # documents that have the n-gram
    for _, (b, _) in bags:
        spread[np.unique(b)] += 1
    learned = np.flatnonzero(spread >= min(LEAST_DOCS, len(bags)))
    place = np.full(1 << BUCKET_BITS, -1, dtype=np.int32)
    place[learned] = np.arange(len(learned), dtype=np.int32)
    marks = np.array([label for label, _ in bags])
    sizes = np.array([len(n) for _, (_, n) in bags])
    y, doc = np.repeat(marks, sizes), np.repeat(np.arange(len(bags)), sizes)
    n = np.concatenate([n for _, (_, n) in bags])
    bucket, lens = [], []
    for _, (b, each) in bags:
        b = place[b]
        lens.append(np.bincount(np.repeat(np.arange(len(each)), each)[b >= 0], minlength=len(each)))
        bucket.append(b[b >= 0])
    del bags
    last = np.r_[doc[1:] != doc[:-1], True]  # a text's last half window is a window on its own
    n = n + np.where(last, 0, np.r_[n[1:], 0])
    windows = _Windows(np.concatenate(bucket), np.r_[0, np.cumsum(np.concatenate(lens))], np.arange(len(y)) + np.where(last, 1, 2), n)
    del bucket
    fold = (np.arange(len(marks)) % 2)[doc]

    def weights(lit: np.ndarray) -> np.ndarray:
        return np.where(y == 0, 0.5 / max(1, (y == 0).sum()), np.where(lit, 0.5 / max(1, lit.sum()), 0.0)) * len(y)

    def crossed(weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Margins of all windows, and the highest of each document, from the models that have not seen them."""
        margin = np.zeros(len(y))
        for f in (0, 1):
            both = windows.logits(_fit_net(windows, y, np.where(fold == f, weight, 0.0), seed))
            margin = np.where(fold == f, margin, both[:, 1] - both[:, 0])
        best = np.full(len(marks), -np.inf)
        np.maximum.at(best, doc, margin)
        return margin, best

    lit = y == 1
    for _ in range(2):
        margin, best = crossed(weights(lit))
        clean = np.quantile(margin[y == 0], 0.99)
        lit = (y == 1) & ((margin > clean) | (margin >= best[doc]))
    margin, best = crossed(weights(lit))
    net = _fit_net(windows, y, weights(lit), seed)
    # Toxic documents are rare in a corpus: clean ones weigh ten times as much in the calibration.
    slope, shift = _logistic(best, marks, np.where(marks == 1, 1.0, 10.0))
    table = np.zeros(1 << BUCKET_BITS, dtype=np.float32)
    table[learned] = (net.e @ (net.w[:, 1] - net.w[:, 0]))[: len(learned)]
    return Model(table, float(net.c[1] - net.c[0]), slope, shift)


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """The columns of ``docs`` and __score, 0 to 1. Null and empty texts score like a text without any n-gram; no model: 0."""
    fields = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, limit=SCORE_BYTES):
            score = np.zeros(batch.num_rows) if model is None else model.scores(*text_buffer(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, "__score"])

    return docs.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", `__score` double")


def drop_toxic(docs: DataFrame, model: Model | None, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``."""
    return scored(docs, model).filter(F.col("__score") < threshold).drop("__score")
