"""Packing by power-of-two decomposition.

A document's token count is a sum of powers of two, none above the sequence
length: the document is cut into pieces of these lengths, longest first, and
every piece is a sequence of its own in the bucket of its length. No sequence
crosses documents, and none needs padding. A loader draws its batches from one
bucket at a time.

Nothing is shuffled: a piece's sequence number is made of its bucket, its
task and its place among the task's pieces of that bucket.
"""

from __future__ import annotations

import itertools
import json
import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstar.llm.common import CHUNK_BYTES, binary_column, sliced, text_chunks

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

#: Bits of a sequence number: bucket, task, place in the task's bucket.
PLACE_BITS, TASK_BITS = 33, 23

#: Fixed value: the splitting pattern under which words are tokenized one by one (white space is dropped, letters stand alone).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Distinct words that a Python worker remembers; all are forgotten when there are more.
REMEMBERED = 1 << 20

LETTERS = {"latin-1": re.compile(rb"[a-z\xdf-\xf6\xf8-\xff]+"), "utf-8": re.compile(rb"[A-Za-z]+")}

#: Latin-1 in small letters.
SMALL = bytes(b + 32 if 65 <= b <= 90 or 0xC0 <= b <= 0xDE and b != 0xD7 else b for b in range(256))

#: Latin-1 by what a splitting pattern can join: blanks and plain letters or digits never, the rest (signs) only with other signs.
SIGNS = bytes(32 if b == 32 or 9 <= b <= 13 else 97 if chr(b).isalnum() and (b < 128 or b >= 0xC0) else 46 for b in range(256))
STOPS = b".,;:!?"


def piece_lengths(n: int, most: int) -> list[int]:
    """``n`` as powers of two of at most ``most``, itself a power of two, largest first."""
    whole, rest = divmod(n, most)
    return [most] * whole + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit numbers.

    With a tokenizer that handles each word by itself, every distinct word is tokenized once; words of letters only
    go to the tokenizer together, and each ends with a token that carries the end-of-word mark. In Latin-1 texts
    where no two signs meet, punctuation is taken off the words first and capitals are made small, so fewer words
    differ. Other tokenizers and chunks that hold one of the tokenizer's special tokens get the text as it is.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        suffix = spec["model"].get("end_of_word_suffix")
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self.by_word = bool(suffix) and kinds == ["NFC", "Replace", "Lowercase"] and steps[0].get("pattern") == {"Regex": WORD_PATTERN}
        self.special = [t["content"].encode() for t in spec.get("added_tokens", [])]
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        if self.by_word:
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.latin: dict[bytes, bytes] = {}  # by the word in Latin-1
        self.other: dict[bytes, bytes] = {}  # by the word in UTF-8

    def plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def learn(self, known: dict[bytes, bytes], words: set[bytes], encoding: str) -> None:
        if len(known) + len(words) > REMEMBERED:
            known.clear()
        fresh = list(words - known.keys())
        alone = LETTERS[encoding].fullmatch
        letters = [w for w in fresh if alone(w)]
        for lo in range(0, len(letters), 4096):
            part = letters[lo : lo + 4096]
            ids = np.array(self.tokenizer.encode(b" ".join(part).decode(encoding), add_special_tokens=False).ids, dtype="<u4")
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            raw = ids.tobytes()
            known.update(zip(part, [raw[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)], strict=True))
        rest = [w for w in fresh if w not in known]
        for lo in range(0, len(rest), 4096):
            part = rest[lo : lo + 4096]
            found = self.tokenizer.encode_batch_fast([w.decode(encoding) for w in part], add_special_tokens=False)
            known.update(zip(part, [np.array(e.ids, dtype="<u4").tobytes() for e in found], strict=True))

    def split(self, text: bytes) -> tuple[bytes, list[bytes]]:
        """How a chunk is tokenized ("latin-1" or "utf-8" words, "" for as it is), and its words."""
        try:
            latin = text if text.isascii() else text.decode().encode("latin-1")
        except UnicodeEncodeError:
            latin = None
        if latin is not None and b".." not in latin.translate(SIGNS) and b"'" not in latin:
            small = latin.translate(SMALL)
            for sign in STOPS:
                small = small.replace(b"%c" % sign, b" %c " % sign)
            return "latin-1", small.split()
        return ("", []) if any(s in text for s in self.special) else ("utf-8", text.split())

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text. Words of several short texts are learned together; a long text goes chunk by chunk."""
        if not self.by_word:
            yield from (self.plain(t.decode()) for t in texts)
            return
        for long, group in itertools.groupby(texts, lambda t: len(t) > CHUNK_BYTES):
            if long:
                yield from (b"".join(part for chunk in text_chunks(t, CHUNK_BYTES) for part in self.words([chunk])) for t in group)
            else:
                yield from self.words(list(group))

    def words(self, texts: list[bytes]) -> Iterator[bytes]:
        split = [self.split(t) for t in texts]
        tables = {"latin-1": self.latin, "utf-8": self.other}
        for kind, known in tables.items():
            self.learn(known, set().union(*(words for k, words in split if k == kind)), kind)
        for text, (kind, words) in zip(texts, split, strict=True):
            yield b"".join(map(tables[kind].__getitem__, words)) if kind else self.plain(text.decode())


def worker_encoder(path: str) -> Encoder:
    """The encoder of this Python worker: words learned in one task serve the worker's later tasks."""
    held = sys.modules.setdefault("_ledgerstar_encoders", types.ModuleType("_ledgerstar_encoders")).__dict__
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, most: int = 4096) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): the pieces of every row of ``docs`` (doc_id, text).

    A document's tokens are those of its text by the tokenizer file ``tokenizer`` (a path that all executors have),
    without special ones, and then ``end_id``; a null text counts as empty and so has that one token. ids: the
    piece's tokens, unsigned little-endian 32-bit numbers; start: tokens of the document before it. Every piece is
    the whole of its sequence, so offset is 0. Repeated rows and null ids are packed like others; other columns are
    ignored. ``most``, a power of two, is the longest sequence. Empty table: no rows.
    """
    if most < 1 or most & (most - 1):
        raise ValueError("the longest sequence has to be a power of two")
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = worker_encoder(tokenizer), TaskContext.get().partitionId()
        if task >> TASK_BITS:
            raise ValueError("too many tasks to number their sequences")
        placed = [0] * most.bit_length()
        for batch in sliced(batches):
            rows = []
            texts = binary_column(batch.column(1)).to_pylist()
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts), strict=True):
                ids += end
                total, start = len(ids) // 4, 0
                for length in piece_lengths(total, most):
                    bucket = length.bit_length() - 1
                    number = (bucket << TASK_BITS | task) << PLACE_BITS | placed[bucket]
                    placed[bucket] += 1
                    rows.append((doc_id, start, length, ids[4 * start : 4 * (start + length)], total, number, 0))
                    start += length
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def write_buckets(packed: DataFrame, path: str) -> None:
    """Store sequences for a loader, a folder for each length; tasks write their own files, nothing is shuffled."""
    packed.select("sequence_id", "doc_id", "start", "ids", "length").write.partitionBy("length").parquet(path)
