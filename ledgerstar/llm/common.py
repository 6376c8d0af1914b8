"""Helpers shared by the operators: scratch tables, text buffers, packed blocks."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.session import fresh_folder

#: Text handled at once inside a task; batches are cut to this many bytes (a longer text is taken whole).
CHUNK_BYTES = 4 << 20

#: White space between words: bytes 0x09-0x0D and 0x20.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

GAP = re.compile(rb"[\x20\x09-\x0D]")

#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def store(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_folder(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def hash_fold(column: str, buckets: int) -> Column:
    """crc32 of the id's decimal text modulo ``buckets``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % buckets


def n_parts(spark: SparkSession, per_partition: int = 8) -> int:
    """Hash ranges for block exchanges: several per shuffle partition, so they deal out evenly."""
    return per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))


def binary_column(column: pa.Array) -> pa.Array:
    return pc.fill_null(column.cast(pa.large_binary()), b"")


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column in a row, and the offsets of its texts (null: empty)."""
    arr = binary_column(column)
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset : arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def sliced(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds at most ``limit`` bytes a piece (one text at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < len(ends):
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def text_chunks(text: bytes, limit: int = CHUNK_BYTES) -> Iterator[bytes]:
    """A text cut at white space into chunks of about ``limit`` bytes (longer ones where there is none)."""
    at = 0
    while at < len(text):
        gap = GAP.search(text, at + limit) if len(text) - at > limit else None
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; integers go byte plane by byte plane, which compresses small numbers well."""
    out = [struct.pack("<I", len(arrays))]
    for a in arrays:
        a = np.ascontiguousarray(a)
        out.append(struct.pack("<2sq", a.dtype.str[1:].encode(), a.size))
        planes = a.view(np.uint8).reshape(-1, a.dtype.itemsize).T if a.size else a.view(np.uint8)
        out.append(np.ascontiguousarray(planes).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(payload: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    (n,), at, out = struct.unpack_from("<I", raw), 4, []
    for _ in range(n):
        kind, size = struct.unpack_from("<2sq", raw, at)
        dtype = np.dtype("<" + kind.decode())
        at += 10
        planes = np.frombuffer(raw, np.uint8, size * dtype.itemsize, at).reshape(dtype.itemsize, size)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(dtype) if size else np.zeros(0, dtype))
        at += size * dtype.itemsize
    return out


def split_by_part(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(part, row positions) for each value in ``part``; positions keep their order."""
    if not len(part):
        return
    order = np.argsort(part, kind="stable")
    ranked = part[order]
    cuts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(ranked)], strict=True):
        yield int(ranked[lo]), order[lo:hi]


def doc_column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(name).to_pylist()
