"""Suffix-array deduplication by a common-prefix-aware distributed merge sort.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts earlier
in the corpus. The suffixes that matter are found first: every string of that
length holds an anchor, the position of its least-hashed ``GRAM``-byte piece, so
equal strings have equal anchors at the same place. All strings with the same
anchor in a row form one stretch of text. Stretches whose piece occurs once in
the corpus have no copy and are left out.

The others are sorted as suffixes that begin at the anchor (what precedes it
comes last). Each task sorts its own share into a run, front-codes it (length of
the prefix shared with the suffix before, and the rest) and sends it to the hash
range of the anchor's piece. There the runs are merged by a loser tree that
keeps, for each loser, the length of the prefix it shares with the winner, so
that known prefixes are never compared again. Equal suffixes come out side by
side; the earliest stays. Suffixes that share the piece but differ further out
are resolved string by string; a piece with very many of them hands its strings
to another exchange, by string hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstar.llm.common import mix64, n_parts, pack, sliced, split_by_part, store, text_buffer, unpack

LENGTH, GRAM = 100, 32
#: Differing stretches around one piece that are resolved in place; pieces with more of them use the string exchange.
IN_PLACE = 4096
LAST = np.iinfo(np.int64).max  # the order of a null doc_id

_ROOT, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def piece_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` bytes in a row: a polynomial from prefix sums, then mixed."""
    down = _powers(_INVERSE, len(data) + 1)
    prefix = np.r_[np.uint64(0), np.cumsum(mix64(data.astype(np.uint64) + np.uint64(1)) * down[:-1])]
    up = _powers(_ROOT, len(data) + 1)
    n = len(data) - size + 1
    return mix64((prefix[size:] - prefix[:n]) * up[:n])


def stretches(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, start in the text, number of strings, anchor's distance from the start, piece hash) of every stretch."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return none, none, none, none, none.astype(np.uint64)
    h = piece_hashes(data, gram)
    span = length - gram + 1
    # The least hash of every window, with its position in the low bits: leftmost on ties, which equal strings share.
    low = (h & ~np.uint64(0xFFFFFFFF)) | np.arange(len(h), dtype=np.uint64)
    reach = 1
    while reach * 2 <= span:
        low, reach = np.minimum(low[:-reach], low[reach:]), reach * 2
    n = len(data) - length + 1
    anchor = (np.minimum(low[:n], low[span - reach : span - reach + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    doc = np.searchsorted(offsets, np.arange(n), side="right") - 1
    inside = np.flatnonzero(np.arange(n) + length <= offsets[doc + 1])
    anchor, doc = anchor[inside], doc[inside]
    if not len(inside):
        return none, none, none, none, none.astype(np.uint64)
    at = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])])
    count = np.diff(np.r_[at, len(inside)])
    start = inside[at]
    return doc[at], start - offsets[doc[at]], count, anchor[at] - start, h[anchor[at]]


def _common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of a and b, known to be ``at`` at least."""
    end = min(len(a), len(b))
    while at < end:
        x, y = a[at : at + 32], b[at : at + 32]
        if x == y:
            at += 32
            continue
        n = min(len(x), len(y))
        differ = int.from_bytes(x[:n], "big") ^ int.from_bytes(y[:n], "big")
        return at + n - (differ.bit_length() + 7) // 8 if differ else at + n
    return end


def front_coded(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shared prefix lengths, lengths of the rests, all rests in a row) of sorted keys."""
    shared = [0] * len(keys)
    for k in range(1, len(keys)):
        shared[k] = _common(keys[k - 1], keys[k], 0)
    rests = [key[s:] for key, s in zip(keys, shared, strict=True)]
    return np.array(shared, dtype=np.uint16), np.array([len(r) for r in rests], dtype=np.uint16), np.frombuffer(b"".join(rests), dtype=np.uint8)


def _run(payload: bytes) -> Iterator[tuple]:
    """(shared prefix with the one before, key, anchor distance, doc, text hash, start) in order."""
    shared, sizes, rests, lead, doc, text, start = unpack(payload)
    raw, at, key = rests.tobytes(), 0, b""
    for s, n, *facts in zip(shared.tolist(), sizes.tolist(), lead.tolist(), doc.tolist(), text.tolist(), start.tolist(), strict=True):
        key = key[:s] + raw[at : at + n]
        at += n
        yield (s, key, *facts)


def merged(runs: list[Iterator[tuple]]) -> Iterator[tuple]:
    """Items of sorted runs in order, each with the prefix it shares with the item before.

    A loser tree: losers remember the prefix they share with the winner that beat them, so two candidates are
    compared from the longer known prefix on, or not at all when their known prefixes differ.
    """
    k = 1
    while k < len(runs):
        k *= 2
    heads = [next(r, None) for r in runs] + [None] * (k - len(runs))
    known = [0] * k  # prefix shared with the last winner
    losers = [0] * k

    def beats(a: int, b: int) -> bool:
        """Whether a comes before b; sets the loser's known prefix to what it shares with the winner."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        if known[a] != known[b]:
            return known[a] > known[b]
        p, q = x[1], y[1]
        at = _common(p, q, known[a])
        first = len(p) <= len(q) if at == len(p) or at == len(q) else p[at] < q[at]
        known[b if first else a] = at
        return first

    def build(node: int) -> int:
        if node >= k:
            return node - k
        a, b = build(2 * node), build(2 * node + 1)
        if beats(a, b):
            losers[node] = b
            return a
        losers[node] = a
        return b

    if not runs:
        return
    winner = build(1) if k > 1 else 0
    while heads[winner] is not None:
        item = heads[winner]
        yield (known[winner], *item[1:])
        head = next(runs[winner], None)
        heads[winner] = head
        known[winner] = head[0] if head is not None else 0
        node = (winner + k) >> 1
        while node:
            other = losers[node]
            if beats(other, winner):
                losers[node], winner = winner, other
            node >>= 1


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _bucket(doc: np.ndarray, buckets: int) -> np.ndarray:
    return _part(mix64(doc.view(np.uint64)), buckets)


def _doc_order(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").cast(pa.int64()).fill_null(LAST).to_numpy(zero_copy_only=False)


class _Gone:
    """Byte ranges found to be copies, and strings to be resolved elsewhere; sent by document bucket or string hash."""

    def __init__(self) -> None:
        self.ranges: list[tuple] = []
        self.strings: dict[bytes, list] = {}

    def add(self, doc: int, text: int, start: int, size: int) -> None:
        self.ranges.append((doc, text, start, size))

    def resolve(self, items: list[tuple], length: int) -> None:
        """Strings of differing stretches around one piece: all but the earliest of each string go."""
        least: dict[bytes, tuple] = {}
        for stretch, doc, _, start in items:
            for o in range(len(stretch) - length + 1):
                string, place = stretch[o : o + length], (doc, start + o)
                if string not in least or place < least[string]:
                    least[string] = place
        for stretch, doc, text, start in items:
            since = -1
            for o in range(len(stretch) - length + 1):
                if least[stretch[o : o + length]] < (doc, start + o):
                    since = o if since < 0 else since
                elif since >= 0:
                    self.add(doc, text, start + since, o - since - 1 + length)
                    since = -1
            if since >= 0:
                self.add(doc, text, start + since, len(stretch) - since)

    def rows(self, buckets: int) -> Iterator[tuple[int, bytes]]:
        if self.ranges:
            doc, text, start, size = (np.array(c, dtype=np.int64) for c in zip(*self.ranges, strict=True))
            order = np.lexsort((start, text, doc))
            doc, text, start, size = doc[order], text[order], start[order], size[order]
            for b, at in split_by_part(_bucket(doc, buckets)):
                yield b, pack(doc[at], text[at], start[at], size[at])


def _string_rows(items: list[tuple], length: int, parts: int) -> list[tuple[int, bytes]]:
    """The strings of many stretches, packed by string hash: (part, two hashes, doc, text, start)."""
    cols = ([], [], [], [], [])
    for stretch, doc, text, start in items:
        for o in range(len(stretch) - length + 1):
            h = xxhash.xxh3_128_intdigest(stretch[o : o + length])
            for col, value in zip(cols, (h >> 64, h & (1 << 64) - 1, doc, text, start + o), strict=True):
                col.append(value)
    high, low = np.array(cols[0], dtype=np.uint64), np.array(cols[1], dtype=np.uint64)
    doc, text, start = (np.array(c, dtype=np.int64) for c in cols[2:])
    return [(p, pack(high[at], low[at], doc[at], text[at], start[at])) for p, at in split_by_part(_part(high, parts))]


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) for every row of ``docs`` (doc_id, text; others are ignored).

    spans: the maximal removed ranges (start, end) of the text's UTF-8 bytes; kept: the remaining bytes. Earlier means
    a smaller doc_id, then a smaller start; null ids come last and count as one document, as do rows that share a
    doc_id: places that are equal by both remove nothing from each other. Null texts are empty. Empty table: no rows.
    """
    spark = docs.sparkSession
    gram = max(1, min(GRAM, length // 3))
    buckets, parts = n_parts(spark, 2), n_parts(spark, 4)
    narrow = docs.select("doc_id", "text")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every stretch, by its piece's hash."""
        for batch in sliced(batches):
            ids = _doc_order(batch)
            doc, start, count, lead, h = stretches(*text_buffer(batch.column("text")), length, gram)
            rows = []
            for p, at in split_by_part(_part(h, parts)):
                key = h[at] >> np.uint64(16)  # a filter only: 48 bits will do
                rows.append((p, pack((key >> np.uint64(16)).astype(np.uint32), key.astype(np.uint16), ids[doc[at]], start[at], count[at].astype(np.uint16), lead[at].astype(np.uint16))))
            if rows:
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.binary())], names=["part", "payload"])

    def repeated(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        """The stretches whose piece occurs more than once, by document bucket."""
        high, low, doc, start, count, lead = (np.concatenate(c) for c in zip(*(unpack(p) for p in frame["payload"]), strict=True))
        piece = high.astype(np.uint64) << np.uint64(16) | low.astype(np.uint64)
        order = np.argsort(piece, kind="stable")
        same = piece[order][1:] == piece[order][:-1]
        at = order[np.r_[False, same] | np.r_[same, False]]
        at = at[np.lexsort((start[at], doc[at]))]
        rows = [(b, "stretches", pack(doc[at[w]], start[at[w]], count[at[w]], lead[at[w]])) for b, w in split_by_part(_bucket(doc[at], buckets))]
        return pd.DataFrame(rows, columns=["bucket", "kind", "payload"])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts, packed by document bucket."""
        for batch in sliced(batches):
            ids, (data, offsets) = _doc_order(batch), text_buffer(batch.column("text"))
            null = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False).astype(np.int8)
            rows = []
            for b, at in split_by_part(_bucket(ids, buckets)):
                body = [data[offsets[k] : offsets[k + 1]] for k in at.tolist()]
                rows.append((b, "texts", pack(ids[at], null[at], np.diff(offsets)[at], np.concatenate(body))))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1]), pa.array(cols[2], pa.binary())], names=["bucket", "kind", "payload"])

    def sort(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        """One bucket's repeated stretches as a sorted, front-coded run for each hash range; copies inside the bucket go at once."""
        wanted = [unpack(p) for p, k in zip(frame["payload"], frame["kind"], strict=True) if k == "stretches"]
        rows, gone = [], _Gone()
        if wanted:
            doc, start, count, lead = (np.concatenate(c) for c in zip(*wanted, strict=True))
            order = np.argsort(doc, kind="stable")
            doc, start, end, lead = doc[order], start[order].tolist(), (start + count.astype(np.int64) + length - 1)[order].tolist(), lead[order].tolist()
            first: dict[tuple, tuple] = {}
            for ids, body, text in _bodies(frame):
                lo, hi = np.searchsorted(doc, ids), np.searchsorted(doc, ids, side="right")
                for k in range(lo, hi):
                    if end[k] > len(body):
                        continue  # another text of the same doc_id
                    a = start[k]
                    cut = a + lead[k]
                    item, place = (body[cut : end[k]] + body[a:cut], lead[k]), (ids, a, text)
                    old = first.get(item)
                    if old is None:
                        first[item] = place
                    elif place[:2] < old[:2]:
                        first[item] = place
                        gone.add(old[0], old[2], old[1], len(item[0]))
                    elif place[:2] > old[:2]:
                        gone.add(ids, text, a, len(item[0]))
                    elif place != old:
                        first[item] = min(place, old)
            items = sorted((k, lead_, *place) for (k, lead_), place in first.items())
            h = np.array([xxhash.xxh64_intdigest(k[:gram]) for k, *_ in items], dtype=np.uint64)
            for p, at in split_by_part(_part(mix64(h), parts)):
                mine = [items[k] for k in at.tolist()]
                _, lead_, ids, a, text = zip(*mine, strict=True)
                rows.append((p, "run", pack(*front_coded([m[0] for m in mine]), np.array(lead_, dtype=np.uint16), np.array(ids, dtype=np.int64), np.array(text, dtype=np.int64), np.array(a, dtype=np.int64))))
        # Ranges already known pass through the merge tasks on their way to their documents.
        rows += [(b % parts, f"gone {b}", p) for b, p in gone.rows(buckets)]
        return pd.DataFrame(rows, columns=["part", "kind", "payload"])

    def merge(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        gone, rows, runs = _Gone(), [], []
        for kind, payload in zip(frame["kind"], frame["payload"], strict=True):
            if kind == "run":
                runs.append(_run(payload))
            else:
                rows.append((int(kind[5:]), "gone", payload))
        group: list[tuple] = []
        spilled = False

        def close() -> None:
            nonlocal group, spilled
            if spilled:
                rows.extend((p, "strings", s) for p, s in _string_rows(group, length, parts))
            elif len(group) > 1:
                gone.resolve(group, length)
            group, spilled = [], False

        before = None
        for shared, k, lead, doc, text, start in merged(runs):
            if shared < gram:
                close()
            if before is not None and shared == len(k) == len(before[0]) and lead == before[1]:
                # The same stretch: the earliest stays in the group, the other goes.
                stretch, d, t, s = group[-1]
                if (doc, start) < (d, s):
                    group[-1] = (stretch, doc, text, start)
                    gone.add(d, t, s, len(k))
                elif (doc, start) > (d, s):
                    gone.add(doc, text, start, len(k))
                continue
            before = (k, lead)
            if len(group) >= IN_PLACE:
                rows.extend((p, "strings", x) for p, x in _string_rows(group[:-1], length, parts))
                group, spilled = group[-1:], True
            cut = len(k) - lead
            group.append((k[cut:] + k[:cut], doc, text, start))
        close()
        rows += [(b, "gone", p) for b, p in gone.rows(buckets)]
        return pd.DataFrame(rows, columns=["bucket", "kind", "payload"])

    def strings(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        """Strings of the pieces that were too many for one place: all but the earliest of each go."""
        high, low, doc, text, start = (np.concatenate(c) for c in zip(*(unpack(p) for p in frame["payload"]), strict=True))
        order = np.lexsort((start, doc, low, high))
        high, low, doc, text, start = high[order], low[order], doc[order], text[order], start[order]
        fresh = np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])]
        lead = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        late = np.flatnonzero((doc != doc[lead]) | (start != start[lead]))
        late = late[np.lexsort((start[late], text[late], doc[late]))]
        rows = [(b, "gone", pack(doc[late[w]], text[late[w]], start[late[w]], np.full(len(w), length))) for b, w in split_by_part(_bucket(doc[late], buckets))]
        return pd.DataFrame(rows, columns=["bucket", "kind", "payload"])

    blocks = "bucket int, kind string, payload binary"
    survivors = narrow.mapInArrow(find, "part int, payload binary").groupBy("part").applyInPandas(repeated, blocks)
    packed = narrow.mapInArrow(texts, blocks)
    runs = survivors.unionByName(packed).groupBy("bucket").applyInPandas(sort, "part int, kind string, payload binary")
    found = store(runs.groupBy("part").applyInPandas(merge, blocks), "suffix-ranges")
    further = found.filter("kind = 'strings'").groupBy("bucket").applyInPandas(strings, blocks)
    ranges = found.filter("kind = 'gone'").unionByName(further)

    def cut(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        gone = [unpack(p) for p, k in zip(frame["payload"], frame["kind"], strict=True) if k == "gone"]
        doc, text, start, size = (np.concatenate(c) for c in zip(*gone, strict=True)) if gone else [np.zeros(0, dtype=np.int64)] * 4
        order = np.lexsort((start, text, doc))
        doc, text, start, end = doc[order], text[order], start[order], (start + size)[order]
        rows = []
        null = np.concatenate([unpack(p)[1] for p, k in zip(frame["payload"], frame["kind"], strict=True) if k == "texts"])
        for (ids, body, own), unnamed in zip(_bodies(frame), null.tolist(), strict=True):
            lo, hi = np.searchsorted(doc, ids), np.searchsorted(doc, ids, side="right")
            mine = lo + np.flatnonzero(text[lo:hi] == own)
            spans: list[list[int]] = []
            for a, e in zip(start[mine].tolist(), end[mine].tolist(), strict=True):
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], e)
                else:
                    spans.append([a, e])
            parts_, at = [], 0
            for a, e in spans:
                parts_.append(body[at:a])
                at = e
            parts_.append(body[at:])
            kept = b"".join(parts_)
            rows.append((None if unnamed else ids, len(body), len(body) - len(kept), [{"start": a, "end": e} for a, e in spans], kept))
        out = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "spans", "kept"])
        out["doc_id"] = pd.array([r[0] for r in rows], dtype="Int64")
        return out

    schema = "doc_id long, n_bytes long, n_removed long, spans array<struct<start: bigint, end: bigint>>, kept binary"
    return packed.unionByName(ranges).groupBy("bucket").applyInPandas(cut, schema)


def _bodies(frame: pd.DataFrame) -> Iterator[tuple[int, bytes, int]]:
    """(doc, text, text hash) of a bucket's texts."""
    for payload, kind in zip(frame["payload"], frame["kind"], strict=True):
        if kind == "texts":
            ids, _, sizes, data = unpack(payload)
            raw, at = data.tobytes(), 0
            for doc, n in zip(ids.tolist(), sizes.tolist(), strict=True):
                body = raw[at : at + n]
                at += n
                yield doc, body, xxhash.xxh64_intdigest(body) - (1 << 63)
