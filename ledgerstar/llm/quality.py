"""Quality classifier by Bradley-Terry pairwise ranking.

A document's strength is a linear function of its features. Training looks at
preference pairs only: the better document should win, with probability
sigmoid(strength difference), so the logistic loss is taken on feature
differences. The threshold is a quantile of the strengths: the share of
documents that the labels call poor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstar.llm.common import LOWER, SPACE, mix64, pack, sliced, text_buffer, unpack

#: Largest training sample, labelled documents (those with the least id hash).
SAMPLE_DOCS = 20_000
#: Preference pairs drawn from the sample.
PAIRS = 60_000
#: The score at the threshold quantile.
CUT = 0.3

FEATURES = (
    "log_words", "word_bytes", "long_words", "short_words", "upper", "capital_words", "digit", "non_ascii", "symbol",
    "bang", "pipe", "comma", "stop", "echo", "echo_two", "new_words", "line_words", "symbol_tail", "most_symbol", "most_echo",
    "most_upper", "most_pipe", "lines_again", "word_bytes_spread",
)


def _per(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=n)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of FEATURES for every text; a text without words has zeros only."""
    n = len(offsets) - 1
    out = np.zeros((n, len(FEATURES)))
    if not len(data):
        return out
    doc = np.repeat(np.arange(n), np.diff(offsets))
    word = ~SPACE[data]
    at_start = np.zeros(len(data), dtype=bool)
    at_start[offsets[:-1][np.diff(offsets) > 0]] = True
    start = word & (at_start | np.r_[True, ~word[:-1]])
    s = np.flatnonzero(start)
    if not len(s):
        return out
    ends_doc = np.r_[at_start[1:], True]
    e = np.flatnonzero(word & (ends_doc | np.r_[~word[1:], True])) + 1
    own, length = doc[s], e - s
    words = np.bincount(own, minlength=n)
    per_word, size = np.maximum(words, 1), np.maximum(_per(length, own, n), 1)
    low = LOWER[data]
    place = np.arange(len(data)) - np.repeat(np.r_[0, s], np.diff(np.r_[0, s, len(data)]))
    digest = np.r_[np.uint64(0), np.cumsum(mix64(low.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(8))))]
    h = digest[e] - digest[s]
    upper = (data >= 65) & (data <= 90)
    letter = ((low >= 97) & (low <= 122)) | (data >= 128)
    digit = (data >= 48) & (data <= 57)
    symbol = word & ~letter & ~digit & ~np.isin(data, np.frombuffer(b".,'!|?-", np.uint8))
    run = lambda mask: np.add.reduceat(mask.astype(np.int64), s) if len(s) else np.zeros(0)
    first_up = upper[s] | (data[s] == 0xC3)
    up_words = (run(upper) >= 2).astype(float)
    sym_words = (run(symbol) > 0).astype(float)
    pipes = ((length == 1) & (data[s] == ord("|"))).astype(float)
    last = data[e - 1]
    same = np.r_[False, (h[1:] == h[:-1]) & (own[1:] == own[:-1])].astype(float)
    two = np.zeros(len(s))
    two[2:] = (h[2:] == h[:-2]) & (own[2:] == own[:-2])
    order = np.lexsort((h, own))
    fresh = np.r_[True, (h[order][1:] != h[order][:-1]) | (own[order][1:] != own[order][:-1])]
    distinct = _per(fresh.astype(float), own[order], n)
    stop = (length <= 3) & ~same.astype(bool)
    # Windows of 24 words: the worst window tells junk inside an otherwise good text.
    rank = np.arange(len(s)) - np.r_[0, np.cumsum(words)][own]
    windows = np.r_[0, np.cumsum(np.maximum(1, -(-words // 24)))]
    win = windows[own] + rank // 24
    win_doc = np.repeat(np.arange(n), np.diff(windows))
    n_win = np.maximum(np.bincount(win, minlength=windows[-1]), 8)

    def most(values: np.ndarray) -> np.ndarray:
        share, best = np.bincount(win, weights=values, minlength=windows[-1]) / n_win, np.zeros(n)
        np.maximum.at(best, win_doc, share)
        return best

    newline = data == 10
    lines = _per(newline.astype(float), doc, n) + 1
    line_of = np.cumsum(newline | at_start)[s]
    cuts = np.flatnonzero(np.r_[True, line_of[1:] != line_of[:-1]])
    line_hash = mix64(np.add.reduceat(mix64(h + (np.arange(len(h)) - np.repeat(cuts, np.diff(np.r_[cuts, len(h)]))).astype(np.uint64)), cuts))
    line_doc = own[cuts]
    order = np.lexsort((line_hash, line_doc))
    again = np.r_[False, (line_hash[order][1:] == line_hash[order][:-1]) & (line_doc[order][1:] == line_doc[order][:-1])]
    mean = size / per_word
    columns = [
        np.log1p(words), mean / 10, _per(length > 12, own, n) / per_word, _per(length <= 2, own, n) / per_word,
        _per(upper, doc, n) / size, _per(first_up, own, n) / per_word, _per(digit, doc, n) / size, _per(data >= 128, doc, n) / size, np.sqrt(_per(symbol, doc, n) / size),
        np.sqrt(_per(data == 33, doc, n) / per_word), np.sqrt(_per(pipes, own, n) / per_word), _per(data == 44, doc, n) / per_word, _per(stop, own, n) / per_word,
        np.sqrt(_per(same, own, n) / per_word), np.sqrt(_per(two, own, n) / per_word), distinct / per_word * np.log1p(words) / 5, np.log1p(words / lines),
        _per((last != 46) & (last != 44) & ((last < 48) | ((last > 57) & (last < 65))), own, n) / per_word, most(sym_words), most(same),
        most(up_words), most(pipes), np.sqrt(_per(again, line_doc[order], n) / np.maximum(np.bincount(line_doc, minlength=n), 1)),
        np.sqrt(np.maximum(_per(length.astype(float) ** 2, own, n) / per_word - mean**2, 0)) / 10,
    ]
    out[:] = np.where(words[:, None] > 0, np.stack(columns, axis=1), 0.0)
    return out


def expanded(x: np.ndarray) -> np.ndarray:
    """Features, their squares and a few steps of each (strength may rise and fall with a feature)."""
    return np.concatenate([x, x**2, np.tanh(4 * x), np.tanh(20 * x)], axis=1)


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float  # the strength at the threshold quantile
    scale: float

    def strengths(self, x: np.ndarray) -> np.ndarray:
        return ((expanded(x) - self.mean) / self.spread).clip(-6, 6) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        shift = np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip((self.strengths(x) - self.cut) * self.scale + shift, -60, 60)))


def train(docs: DataFrame, labels: DataFrame, seed: int = 7, sample: int = SAMPLE_DOCS, pairs: int = PAIRS) -> Model | None:
    """Fit on at most ``sample`` labelled documents; None when a class has no document.

    ``docs`` needs doc_id and text, ``labels`` doc_id and quality. A document labelled twice counts as poor when any
    label says so; null labels and ids are left out.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    chosen = [(r["doc_id"], r["label"]) for r in known.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(sample).collect()]
    if not chosen:
        return None
    wanted = docs.sparkSession.createDataFrame(chosen, "doc_id long, label int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            x = features(*text_buffer(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("doc_id"), pa.array([pack(r) for r in x], pa.binary())], names=["label", "doc_id", "x"])

    rows = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id").select("label", "doc_id", "text").mapInArrow(run, "label int, doc_id long, x binary").collect()
    rows = sorted((r["label"], r["doc_id"], r["x"]) for r in rows)
    y = np.array([r[0] for r in rows])
    if len(set(y.tolist())) < 2:
        return None
    x = expanded(np.stack([unpack(r[2])[0] for r in rows]))
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = ((x - mean) / spread).clip(-6, 6)
    rng = np.random.default_rng(seed)
    good, poor = rng.choice(np.flatnonzero(y == 1), pairs), rng.choice(np.flatnonzero(y == 0), pairs)
    w, velocity = np.zeros(z.shape[1]), np.zeros(z.shape[1])
    for epoch in range(12):
        rate = 0.05 / (1 + epoch / 3)
        for lo in range(0, pairs, 2000):
            diff = z[good[lo : lo + 2000]] - z[poor[lo : lo + 2000]]
            miss = 1 / (1 + np.exp(np.clip(diff @ w, -60, 60)))
            velocity = 0.9 * velocity + (diff.T @ miss / len(diff) - 1e-4 * w)
            w = w + rate * velocity
    strength = z @ w
    cut = float(np.quantile(strength, (y == 0).mean()))
    return Model(mean, spread, w, cut, 1.0)


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """The columns of ``docs`` and __score, 0 to 1. Null and empty texts score like a text whose features are all zero; no model: 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            score = np.zeros(batch.num_rows) if model is None else model.scores(features(*text_buffer(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, "__score"])

    return docs.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", `__score` double")


def keep_good(docs: DataFrame, model: Model | None, threshold: float = CUT) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``."""
    return scored(docs, model).filter(F.col("__score") >= threshold).drop("__score")
