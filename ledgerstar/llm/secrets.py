"""Secret scans: base patterns, and a character convolutional network over every candidate.

The base patterns find credentials by keyword, prefix or alphabet. Every other
long run of token characters, and what a finding leaves of one, is a candidate; a small character CNN in numpy
reads it with its surrounding context, long ones in overlapping windows, and
tells whether any part of it looks like a secret.
It is trained on labelled findings: credentials that the base patterns found
(half of them with the keyword blanked, so the value itself must convince)
against candidates that no pattern found. Findings of a corpus look alike, so
both sides are varied: values of other alphabets, lengths and forms take the
place of findings and of plain runs, and words of the corpus are joined to
addresses, paths and names. Whole kinds of secret never enter training.

Every window of every finding and candidate is learned: they are dealt out by
hash into shards of bounded size, equal ones once. A network trained on the
first shard is trained on by each of the others, and the mean of what they make
of it is the network of the corpus. Its probabilities are calibrated on all
findings and candidates of the documents kept out of training (a quarter by
hash), counted by narrow steps of the network's output, and the threshold is
the highest step that still recalls the required share of the known secrets
there and of the kinds that it was not trained on.
"""

from __future__ import annotations

import copy
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstar.llm.common import mix64, pack, sliced, split_by_part, store, unpack

#: The base patterns, by kind, in the order of the listing.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "model")

#: What a finding ends with.
VALUE = re.compile(r"[A-Za-z0-9+/_.=-]+\Z")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
#: Characters of the candidate and of the context on each side that the network reads at once.
BODY, SIDE = 40, 12
#: Longer candidates are read in windows of BODY characters that start this many apart.
STRIDE = 10
#: Windows scored together.
PIECE = 8192
WIDTH = BODY + 2 * SIDE
#: Text of a shard, in characters: what one task learns.
SHARD = 64 << 20
#: A class counts in training and calibration like this many examples at most, each of its examples for less if there are more.
CLASS_WEIGHT = 4000
#: Examples that a task gathers before it sends them.
FLUSH = 100_000
#: Steps of the network's output, by which examples are counted for calibration and threshold.
STEP = 1 / 256
RECALL = 0.99
#: Share of the secrets of kinds kept out of training that the threshold recalls.
NEW_RECALL = 0.98
#: Varied secrets, and as many plain runs, that a shard makes to train on.
VARIED = 4000
#: Mini-batches of training at least, however small a shard is.
STEPS = 800


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of every base finding, by start and kind."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1])))


def _pieces(text: str, base: list[tuple[int, str, int]]) -> Iterator[tuple[int, int, bool]]:
    """(start, end, whether a base finding touches its run) of every candidate."""
    order, k = sorted((a, e) for a, _, e in base), 0
    for m in CANDIDATE.finditer(text):
        start, stop = m.span()
        while k < len(order) and order[k][1] <= start:
            k += 1
        cuts, at, j = [], start, k
        while j < len(order) and order[j][0] < stop:
            cuts.append((at, order[j][0]))
            at = max(at, order[j][1])
            j += 1
        for a, e in [*cuts, (at, stop)]:
            while e > a and text[e - 1] in ".-_=/+":
                e -= 1
            if e - a >= 12:
                yield a, e, bool(cuts)


def candidates(text: str, base: list[tuple[int, str, int]]) -> list[tuple[int, int]]:
    """Runs of token characters, without trailing punctuation; of a run that base findings touch, each piece that they leave."""
    return [(a, e) for a, e, _ in _pieces(text, base)]


def one_case(run: str) -> bool:
    """Letters in one case, at most with a capital first: most such runs are words of the text."""
    return run.isalpha() and (run[1:].islower() or run.isupper())


def windows(start: int, end: int) -> list[tuple[int, int]]:
    """Overlapping windows of at most BODY characters over a whole candidate; the last one ends with it."""
    starts = [*range(start, end - BODY, STRIDE), max(start, end - BODY)]
    return [(a, min(end, a + BODY)) for a in starts]


def encode(text: str, start: int, end: int, blank: bool = False) -> np.ndarray:
    """The character codes that the network reads of a window; blank: without what precedes it."""
    codes = np.zeros(WIDTH, dtype=np.uint8)
    left = "" if blank else text[max(0, start - SIDE) : start]
    right = text[end : end + SIDE]
    body = text[start : min(end, start + BODY)]
    squeeze = lambda s: np.frombuffer(s.encode("latin-1", "replace"), dtype=np.uint8)
    if left:
        codes[SIDE - len(left) : SIDE] = squeeze(left)
    codes[SIDE : SIDE + len(body)] = squeeze(body)
    if right:
        codes[SIDE + BODY : SIDE + BODY + len(right)] = squeeze(right)
    return codes


class CharCNN:
    """Character embedding, one convolution with ReLU, maximum and mean over positions, logistic output."""

    def __init__(self, seed: int = 7, dim: int = 8, filters: int = 32, span: int = 5):
        rng = np.random.default_rng(seed)
        self.p = {
            "e": rng.normal(0, 0.3, (256, dim)),
            "k": rng.normal(0, 0.2, (span * dim, filters)),
            "b": np.zeros(filters),
            "w": rng.normal(0, 0.2, 2 * filters),
            "c": np.zeros(1),
        }
        self.span, self.dim, self.filters = span, dim, filters

    def forward(self, x: np.ndarray) -> tuple:
        emb = self.p["e"][x]  # n, width, dim
        n, steps = len(x), WIDTH - self.span + 1
        cols = np.concatenate([emb[:, k : k + steps] for k in range(self.span)], axis=2)
        act = np.maximum(cols.reshape(n * steps, -1) @ self.p["k"] + self.p["b"], 0).reshape(n, steps, self.filters)
        top = act.argmax(axis=1)
        pooled = np.concatenate([np.take_along_axis(act, top[:, None], axis=1)[:, 0], act.mean(axis=1)], axis=1)
        return cols, act, top, pooled, pooled @ self.p["w"] + self.p["c"][0]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.forward(x[lo : lo + 512])[4] for lo in range(0, len(x), 512)]) if len(x) else np.zeros(0)

    def gradients(self, x: np.ndarray, y: np.ndarray, weights: np.ndarray | None = None) -> dict:
        cols, act, top, pooled, logit = self.forward(x)
        n, steps = len(x), act.shape[1]
        share = 1 / n if weights is None else weights / weights.sum()
        d = (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - y) * share
        dp = d[:, None] * self.p["w"]
        da = np.repeat(dp[:, None, self.filters :] / steps, steps, axis=1)
        np.put_along_axis(da, top[:, None], np.take_along_axis(da, top[:, None], axis=1) + dp[:, None, : self.filters], axis=1)
        da[act <= 0] = 0
        flat = da.reshape(n * steps, -1)
        dc = (flat @ self.p["k"].T).reshape(n, steps, self.span, self.dim)
        at = np.zeros((n, WIDTH, self.dim))
        for k in range(self.span):
            at[:, k : k + steps] += dc[:, :, k]
        seen = x.ravel()
        de = np.stack([np.bincount(seen, weights=at[:, :, j].ravel(), minlength=256) for j in range(self.dim)], axis=1)
        return {"e": de, "k": cols.reshape(n * steps, -1).T @ flat, "b": flat.sum(axis=0), "w": pooled.T @ d, "c": np.array([d.sum()])}

    def fit(self, x: np.ndarray, y: np.ndarray, weights: np.ndarray, seed: int, size: int = 128, rate: float = 3e-3) -> None:
        rng, first, second, t = np.random.default_rng(seed), {k: np.zeros_like(v) for k, v in self.p.items()}, {k: np.zeros_like(v) for k, v in self.p.items()}, 0
        for _ in range(-(-STEPS * size // max(1, len(x)))):
            order = rng.permutation(len(x))
            for lo in range(0, len(x), size):
                pick, t = order[lo : lo + size], t + 1
                for k, g in self.gradients(x[pick], y[pick], weights[pick]).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.p[k] -= rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)


@dataclass(frozen=True)
class Model:
    net: CharCNN
    slope: float
    shift: float
    threshold: float

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.net.logits(x) + self.shift, -60, 60)))


def _calibrated(logit: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Logistic calibration with a light penalty, by damped Newton steps; ``n``: what each output counts."""
    at = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(at[0] * logit + at[1], -60, 60)))
        v = n * (p * (1 - p) + 1e-9)
        grad = np.array([(n * (p - y) * logit).sum() + at[0] - 1, (n * (p - y)).sum() + at[1]])
        hess = np.array([[(v * logit**2).sum() + 1, (v * logit).sum()], [(v * logit).sum(), v.sum() + 1]])
        step = np.linalg.solve(hess, grad)
        at = at - step * min(1.0, 1.0 / max(1e-9, np.abs(step).max()))
    return float(at[0]), float(at[1])


def _steps(net: CharCNN, classes: list[int], codes: list[list[bytes]]) -> pa.RecordBatch:
    """(y, step, n): examples by class and the step of their highest window's output."""
    sizes = np.array([len(c) for c in codes])
    x = np.frombuffer(b"".join(c for some in codes for c in some), dtype=np.uint8).reshape(-1, WIDTH)
    top = np.maximum.reduceat(net.logits(x), np.r_[0, np.cumsum(sizes)[:-1]])
    at, n = np.unique(np.stack([np.array(classes), np.floor(top / STEP).astype(np.int64)]), axis=1, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(at[0], pa.int32()), pa.array(at[1], pa.int64()), pa.array(n, pa.int64())], names=["y", "step", "n"])


LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Alphabets of the varied secrets; those of the second table never enter training.
ALPHABETS = {
    "base62": LOWER + UPPER + DIGITS,
    "base64": LOWER + UPPER + DIGITS + "+/",
    "urlsafe": LOWER + UPPER + DIGITS + "-_",
    "base36": LOWER + DIGITS,
    "upper36": UPPER + DIGITS,
    "upper hex": DIGITS + "ABCDEF",
    "letters": LOWER + UPPER,
}
KEPT_OUT = {"base32": UPPER + "234567", "prefixed": LOWER + UPPER + DIGITS, "dotted": LOWER + UPPER + DIGITS + "-_"}
#: Parts of made-up words.
ONSETS = "b br c ch cl cr d dr f fl fr g gl gr h j k kn l m n p ph pl pr qu r s sc sch sh sk sl sp st str t th tr v w wh".split()
VOWELS = "a e i o u ai au ea ee ei ia ie io oa oo ou y".split()
CODAS = ["", "", "", *"b ck ct d ft g l ld ll m mp n nd ng nt p r rd rm rs rt s sm ss st t tch th ve x".split()]


def _letters(rng: np.random.Generator, alphabet: str, n: int) -> str:
    return "".join(alphabet[k] for k in rng.integers(0, len(alphabet), n))


def varied_secret(rng: np.random.Generator, kind: str) -> str:
    """A random value of a kind of secret, sometimes behind a short prefix; "prefixed" always is, "dotted" has three parts."""
    alphabet, n = {**ALPHABETS, **KEPT_OUT}[kind], int(rng.choice([16, 20, 24, 32, 40, 48, int(rng.integers(16, 65))]))
    if kind == "dotted":
        return ".".join(_letters(rng, alphabet, int(rng.integers(20, 60))) for _ in range(3))
    value = _letters(rng, alphabet, n)
    if kind == "base64":
        value += "=" * int(rng.integers(0, 3))
    if kind == "prefixed" or rng.random() < 0.15:
        # Training sees prefixes of capitals, the kind kept out has those in small letters.
        letters = LOWER if kind == "prefixed" else UPPER
        value = _letters(rng, letters, int(rng.integers(2, 5))) + str(rng.choice(["_", "-"])) + value
    return value


def made_word(rng: np.random.Generator) -> str:
    """A word that can be spoken: syllables of an onset, a vowel and a coda."""
    pick = lambda parts: parts[int(rng.integers(0, len(parts)))]
    return "".join(pick(ONSETS) + pick(VOWELS) + pick(CODAS) for _ in range(int(rng.integers(1, 5))))


def plain_run(rng: np.random.Generator, words: list[str]) -> str:
    """A run of token characters that is no secret: words alone, joined, as a path, name, address, date or number."""
    word = lambda: (words[int(rng.integers(0, len(words)))] if words and rng.random() < 0.4 else made_word(rng)).lower()
    some, form = [word() for _ in range(int(rng.integers(2, 7)))], int(rng.integers(0, 10))
    number = lambda: str(int(10 ** rng.uniform(0, 5)))
    if form == 0:
        run = str(rng.choice(["-", "_", ".", "/"])).join(some)
    elif form == 1:
        run = "/" + "/".join(some) + str(rng.choice(["", ".html", ".py", ".tar.gz", "/" + number()]))
    elif form == 2:
        run = "".join([some[0], *(w.capitalize() for w in some[1:])])
    elif form == 3:
        run = str(rng.choice(["_", "-"])).join(some).upper()
    elif form == 4:
        run = ".".join(["www", *some[:2], str(rng.choice(["com", "org", "net"]))]) + "/" + "/".join(some[2:])
    elif form == 5:
        run = str(rng.choice(["-", "_", ""])).join([*some[:2], number()])
    elif form == 6:
        run = str(rng.choice(["-", ".", "/", "="])).join(str(int(v)) for v in rng.integers(0, 3000, int(rng.integers(3, 7))))
        if rng.random() < 0.4:
            year, month, day, hour = (int(rng.integers(a, b)) for a, b in ((1900, 2100), (1, 13), (1, 32), (0, 24)))
            run = f"{year}-{month:02}-{day:02}" + str(rng.choice(["T", "-", "_"])) + f"{hour:02}"
    elif form == 7:
        run = _letters(rng, DIGITS, int(rng.integers(12, 16)))
    elif form == 8:
        run = "_".join(some) + "=" + str(rng.choice([number(), word()]))
    else:
        run = "".join(some[:3])
        run = (run, run.capitalize(), run.upper())[int(rng.integers(0, 3))]
    return run


def _around(code: bytes) -> tuple[str, str]:
    """The context on both sides of an encoded window."""
    return tuple(c.replace(b"\0", b"").decode("latin-1") for c in (code[:SIDE], code[SIDE + BODY :]))


def varied(rng: np.random.Generator, codes: list[bytes], words: list[str], kinds: list[str], n: int) -> list[tuple[str, int, int, float]]:
    """(text, start, end, 1: secret) of ``n`` varied secrets and as many plain runs in the surroundings of ``codes``, each of which comes up in turn."""
    out = []
    for k in range(2 * n if codes else 0):
        left, right = _around(codes[k // 2 % len(codes)])
        if k % 2:
            run = plain_run(rng, words)
            while len(run) < 12:
                run += "-" + made_word(rng)
        else:
            run = varied_secret(rng, kinds[k // 2 % len(kinds)])
            if rng.random() < 0.1:
                run = made_word(rng) + str(rng.choice(["=", "/", ":"])) + run
        # What precedes a bare run is plain; a key word before it may not tell, so plain runs have it as often.
        left = (left[-3:] if rng.random() < 0.3 else left).rstrip(ALPHABETS["base64"] + "-_=.") if left else left
        if CANDIDATE.match(right[:1] * 12):
            right = " " + right
        out.append((left + run + right, len(left), len(left) + len(run), float(1 - k % 2)))
    return out


def _examples(text: str, order: int) -> Iterator[tuple[int, list[bytes]]]:
    """Class (0: candidate, 1: finding, 2: plain word) and coded windows of every finding and candidate of a text.

    Half of the findings go without what precedes their value, so that the value itself must convince, and so does a quarter of the others.
    """
    base = base_spans(text)
    for k, (a, kind, e) in enumerate(s for s in base if s[1] != "hex"):
        blank = (order + k) % 2 == 0
        # Blanked, an access key also goes without its prefix: that is its keyword.
        skip = (len("AKIA") if blank else 0) if kind == "access" else VALUE.search(text, a, e).start() - a
        yield 1, [encode(text, lo, hi, blank).tobytes() for lo, hi in windows(a + skip, e)]
    # What a finding leaves of a run may belong to the secret; plain words and others are learned alike.
    for k, (a, e) in enumerate((a, e) for a, e, touched in _pieces(text, base) if not touched):
        yield 2 if one_case(text[a:e]) else 0, [encode(text, lo, hi, (order + k) % 4 == 0).tobytes() for lo, hi in windows(a, e)]


def _kept_out(order: np.ndarray) -> np.ndarray:
    """A quarter of the documents is kept out of training."""
    return order & 24 == 0


def _distinct(order: np.ndarray, y: np.ndarray, x: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, ...]:
    """Equal examples of a class once, by least order; kept out where one of them is."""
    key = np.concatenate([y[:, None].astype(np.uint8), x], axis=1).view(f"V{WIDTH + 1}")[:, 0]
    _, at, same = np.unique(key, return_index=True, return_inverse=True)
    least = np.full(len(at), np.iinfo(np.int64).max)
    np.minimum.at(least, same, order)
    any_out = np.bincount(same, weights=out) > 0
    y, x = y[at], x[at]
    place = np.lexsort((np.arange(len(at)), least))
    return least[place], y[place], x[place], any_out[place]


def _dealt(docs: DataFrame, shards: int) -> DataFrame:
    """(shard, counts of findings and others that are kept out or not, payload): all examples by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []

        def flush() -> Iterator[pa.RecordBatch]:
            order, y = (np.array(c, dtype=np.int64) for c in ([h[k] for h in held] for k in (0, 1)))
            x = np.frombuffer(b"".join(h[2] for h in held), dtype=np.uint8).reshape(-1, WIDTH)
            order, y, x, out = _distinct(order, y, x, _kept_out(order))
            words = np.ascontiguousarray(x).view(np.uint64)
            hashed = mix64(y.astype(np.uint64) + np.uint64(1))
            for k in range(words.shape[1]):
                hashed = mix64(hashed ^ words[:, k])
            for shard, at in split_by_part((hashed % np.uint64(shards)).astype(np.int64)):
                found = y[at] == 1
                counts = [int((found & out[at]).sum()), int((~found & out[at]).sum()), int((found & ~out[at]).sum()), int((~found & ~out[at]).sum())]
                payload = pack(order[at], y[at].astype(np.int8), out[at].astype(np.int8), x[at].ravel())
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), *(pa.array([c], pa.int64()) for c in counts), pa.array([payload], pa.binary())], names=names)

        for batch in sliced(batches):
            for order, text in zip(batch.column("order").to_pylist(), batch.column("text").to_pylist(), strict=True):
                held += [(order, y, code) for y, codes in (_examples(text, order) if text else ()) for code in codes]
                if len(held) > FLUSH:
                    yield from flush()
                    held.clear()
        if held:
            yield from flush()

    names = ["shard", "found_out", "other_out", "found", "other", "payload"]
    kind = "shard int, found_out long, other_out long, found long, other long, payload binary"
    return store(docs.mapInArrow(run, kind), "secret-examples")


def _loaded(frame: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """The distinct examples of a shard in order: class, codes, kept out."""
    order, y, out, x = (np.concatenate(c) for c in zip(*(unpack(p) for p in frame["payload"]), strict=True))
    return _distinct(order, y, x.reshape(-1, WIDTH), out)[1:]


def _words(x: np.ndarray, y: np.ndarray) -> list[str]:
    return [c.tobytes().rstrip(b"\0").decode("latin-1") for c in x[y == 2, SIDE : SIDE + BODY]]


def _learned(dealt: DataFrame, start: CharCNN, seed: int, keep_out: bool) -> list[tuple[int, int, dict]]:
    """(shard, examples, weights) of the network after each shard of ``dealt`` has gone on with ``start``."""

    def learn(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        y, x, out = _loaded(frame)
        mine = ~out if keep_out else np.ones(len(y), dtype=bool)
        y, x, rng = y[mine], x[mine], np.random.default_rng([seed, int(key[0])])
        if not len(y):
            return pd.DataFrame({"shard": [], "n": [], "payload": []})
        extra = varied(rng, _mixed(rng, x, (y == 1).astype(float)), _words(x, y), list(ALPHABETS), VARIED)
        more = [windows(a, e)[-1 if text[a:e].find("=") > 0 else int(rng.integers(0, len(windows(a, e))))] for text, a, e, _ in extra]
        made = np.stack([encode(text, *w) for (text, *_), w in zip(extra, more, strict=True)])
        counts = np.bincount(y, minlength=3)
        weights = np.minimum(1.0, CLASS_WEIGHT / np.maximum(counts, 1))[y]
        net = copy.deepcopy(start)
        net.fit(np.concatenate([x, made]), np.concatenate([y == 1, [v for *_, v in extra]]).astype(float), np.concatenate([weights, np.ones(len(made))]), seed)
        return pd.DataFrame({"shard": [int(key[0])], "n": [len(y)], "payload": [pack(*(net.p[k].ravel() for k in sorted(net.p)))]})

    rows = dealt.select("shard", "payload").groupBy("shard").applyInPandas(learn, "shard int, n long, payload binary").collect()
    return [(r["shard"], r["n"], {k: v.reshape(start.p[k].shape) for k, v in zip(sorted(start.p), unpack(r["payload"]), strict=True)}) for r in sorted(rows, key=lambda r: r["shard"])]


def _network(dealt: DataFrame, seed: int, keep_out: bool) -> CharCNN:
    """Trained on the first shard, then by every other one; the mean of what they make of it, by examples."""
    net = CharCNN(seed)
    first = dealt.agg(F.min("shard")).first()[0]
    for part in (dealt.filter(F.col("shard") == first), dealt.filter(F.col("shard") > first)):
        learned = _learned(part, net, seed, keep_out)
        if learned:
            total = sum(n for _, n, _ in learned)
            net.p = {k: sum(n / total * p[k] for _, n, p in learned) for k in net.p}
    return net


def train(docs: DataFrame, seed: int = 7, shard: int = SHARD) -> Model | None:
    """Fit on every finding and candidate of ``docs`` but for a quarter of them, which all set calibration and threshold.

    None when there are no findings or no candidates to learn from; with too few to keep any out, all are learned and
    judged. ``docs`` needs text. ``shard``: characters of text that one task learns.
    """
    texts = docs.select(F.shiftrightunsigned(F.xxhash64("text", F.lit(seed)), 1).alias("order"), "text")
    dealt = _dealt(texts, max(1, -(-int(texts.agg(F.sum(F.length("text"))).first()[0] or 0) // shard)))
    found_out, other_out, found, other = (int(n or 0) for n in dealt.agg(*(F.sum(c) for c in ("found_out", "other_out", "found", "other"))).first())
    if not (found_out + found and other_out + other):
        return None
    keep_out = bool(found_out and other_out and found and other)
    net = _network(dealt, seed, keep_out)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A candidate is judged by its highest window, so it is calibrated by that, too."""
        for batch in sliced(batches):
            rows = [e for order, text in zip(batch.column("order").to_pylist(), batch.column("text").to_pylist(), strict=True) if text for e in _examples(text, order)]
            if rows:
                yield _steps(net, [y for y, _ in rows], [codes for _, codes in rows])

    def judge_new(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        """Kinds that training has not seen (class 3), and as many plain runs (4), around what was kept out."""
        y, x, out = _loaded(frame)
        mine = out if keep_out else np.ones(len(y), dtype=bool)
        y, x, rng = y[mine], x[mine], np.random.default_rng([seed, int(key[0]), 1])
        if not len(y):
            return pd.DataFrame({"y": [], "step": [], "n": []})
        unseen = varied(rng, _mixed(rng, x, (y == 1).astype(float)), _words(x, y), list(KEPT_OUT), VARIED // 4)
        return _steps(net, [3 if v else 4 for *_, v in unseen], [[encode(text, lo, hi).tobytes() for lo, hi in windows(a, e)] for text, a, e, _ in unseen]).to_pandas()

    kind = "y int, step long, n long"
    judged = texts.filter(F.col("order").bitwiseAND(F.lit(24)) == 0) if keep_out else texts
    steps = judged.mapInArrow(judge, kind).unionByName(dealt.select("shard", "payload").groupBy("shard").applyInPandas(judge_new, kind))
    rows = steps.groupBy("y", "step").agg(F.sum("n").alias("n")).orderBy("y", "step").collect()  # a row for each step of the output
    y, step, n = (np.array([r[c] for r in rows], dtype=np.int64) for c in ("y", "step", "n"))
    logit = (step + 0.5) * STEP
    counts = np.bincount(y, weights=n, minlength=5)
    slope, shift = _calibrated(logit, np.isin(y, (1, 3)).astype(float), n * np.minimum(1.0, CLASS_WEIGHT / np.maximum(counts, 1))[y])
    p = lambda logits: 1 / (1 + np.exp(-np.clip(slope * logits + shift, -60, 60)))
    recalled = []
    for of, share in ((1, RECALL), (3, NEW_RECALL)):
        mine = y == of
        if mine.any():
            below = int((n[mine].sum() - 1) * (1 - share))  # examples that may be missed
            recalled.append(float(p(step[mine][np.searchsorted(np.cumsum(n[mine]), below, side="right")] * STEP)))
    return Model(net, slope, shift, min(recalled))


def _mixed(rng: np.random.Generator, x: np.ndarray, y: np.ndarray) -> list[bytes]:
    """Codes of findings and of other candidates in turn, as long as the longer of both lists; these repeat."""
    sides = [x[y == 1], x[y == 0]]
    sides = [side[rng.permutation(len(side))] for side in sides if len(side)]
    return [side[k % len(side)].tobytes() for k in range(max(map(len, sides))) for side in sides]


def find(docs: DataFrame, model: Model | None) -> DataFrame:
    """The columns of ``docs`` and __spans: array of (start, kind, end), code points, by start and kind.

    ``docs`` needs text; null and empty texts have no spans. No model: base findings only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            every, where, codes, best = [], [], [], {}

            def score(where=where, codes=codes, best=best) -> None:
                for at, p in zip(where, model.probabilities(np.stack(codes)).tolist(), strict=True):
                    best[at] = max(best.get(at, 0.0), p)
                where.clear()
                codes.clear()

            for k, text in enumerate(batch.column("text").to_pylist()):
                base = base_spans(text) if text else []
                every.append(base)
                if text and model is not None:
                    for a, e in candidates(text, base):
                        for lo, hi in windows(a, e):
                            where.append((k, a, e))
                            codes.append(encode(text, lo, hi))
                            if len(codes) == PIECE:
                                score()
            if codes:
                score()
            for (k, a, e), p in best.items():
                if p >= model.threshold:
                    every[k] = [*every[k], (a, "model", e)]
            spans = [[{"start": a, "kind": kind, "end": e} for a, kind, e in sorted(s, key=lambda s: (s[0], KINDS.index(s[1])))] for s in every]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, kind)], names=[*batch.schema.names, "__spans"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, schema + ", `__spans` array<struct<start: bigint, kind: string, end: bigint>>")


def redact(docs: DataFrame, model: Model | None, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark``; overlapping spans are one. n_chars, if present, follows the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("__spans").to_pylist(), strict=True):
                if spans:
                    parts, at, marked = [], 0, 0
                    for s in spans:
                        if s["start"] >= marked:
                            parts += [text[at : s["start"]], mark]
                        at = marked = max(marked, s["end"])
                    text = "".join([*parts, text[at:]])
                texts.append(text)
            columns = {n: batch.column(n) for n in batch.schema.names if n != "__spans"}
            columns["text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    out = find(docs, model).mapInArrow(run, schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out.select(docs.columns)
