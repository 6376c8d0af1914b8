"""Parquet files whose schemas differ, read as one table.

The files' footers are merged by Spark (one distributed job) as long as they
agree. Where they don't, the list of files is halved until every part agrees,
so the number of jobs follows the number of disagreements, not of files.

Each column then gets one type: the narrowest that holds every value of the
types seen. Columns that a file lacks are NULL there. Types that no type holds
without loss are a conflict: the column becomes text, which the bronze boundary
parses and checks, and the conflict is listed. Files are read in as few scans as
conflicting types demand; a widening alone needs no scan of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
#: Widenings that the Parquet reader makes itself: files are read with the wider type.
_READ_WIDER = {(a.simpleString(), b.simpleString()) for i, a in enumerate(_INTEGERS) for b in _INTEGERS[i + 1:]} | {("float", "double")}


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds every value of both without loss; None if there is none."""
    if a == b:
        return a
    if isinstance(b, T.IntegralType) and not isinstance(a, T.IntegralType):
        a, b = b, a
    if isinstance(a, T.IntegralType):
        if isinstance(b, T.IntegralType):
            return max(a, b, key=_INTEGERS.index)
        if isinstance(b, (T.FloatType, T.DoubleType)):
            small = _INTEGERS.index(a) < (2 if isinstance(b, T.FloatType) else 3)  # 24 and 53 bits
            return b if small else T.DoubleType() if _INTEGERS.index(a) < 3 else None
        if isinstance(b, T.DecimalType):
            return _decimal(max(_DIGITS[a], b.precision - b.scale), b.scale)
    if {type(a), type(b)} == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        return _decimal(max(a.precision - a.scale, b.precision - b.scale), max(a.scale, b.scale))
    if {type(a), type(b)} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return None


def _decimal(whole: int, places: int) -> T.DataType | None:
    return T.DecimalType(whole + places, places) if whole + places <= 38 else None


def list_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Parquet files below folders or globs, by path; only names are listed, as Spark does itself to plan a scan."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(list(paths))
    return sorted(r["path"] for r in found.select("path").collect())


def agreeing(spark: SparkSession, files: list[str]) -> list[tuple[list[str], T.StructType]]:
    """Runs of files with the merged schema of each run."""
    try:
        return [(files, spark.read.option("mergeSchema", "true").parquet(*files).schema)]
    except (PySparkException, Py4JJavaError) as error:
        if len(files) == 1 or "CANNOT_MERGE" not in str(error):
            raise
        middle = len(files) // 2
        return agreeing(spark, files[:middle]) + agreeing(spark, files[middle:])


@dataclass
class Reconciled:
    """``rows`` of all files; ``schema`` of the result; ``columns``: what each column was made of, conflicts included."""

    rows: DataFrame
    schema: T.StructType
    columns: DataFrame
    conflicts: list[str]


COLUMNS = "column string, type string, seen array<string>, outcome string"


def read_reconciled(spark: SparkSession, path: str | Sequence[str]) -> Reconciled:
    """Read a Parquet file, a folder, or globs whose files may differ in columns and types.

    Columns come in the order in which the files (by path) bring them. ``columns`` has a row each: its type, the
    types seen, and whether it is the ``same`` everywhere it is, was ``widened``, or is a ``conflict`` (now text).
    """
    files = list_files(spark, [path] if isinstance(path, str) else list(path))
    if not files:
        raise FileNotFoundError(f"no Parquet files below {path}")
    parts = agreeing(spark, files)
    seen: dict[str, list[T.DataType]] = {}
    for _, schema in parts:
        for field in schema.fields:
            known = seen.setdefault(field.name, [])
            if field.dataType not in known:
                known.append(field.dataType)
    target, conflicts = {}, []
    for name, types in seen.items():
        held: T.DataType | None = types[0]
        for t in types[1:]:
            held = wider(held, t) if held is not None else None
        if held is None:
            conflicts.append(name)
        target[name] = T.StringType() if held is None else held
    # Files that need the same casts share a scan.
    scans: dict[tuple, list[str]] = {}
    for part, schema in parts:
        own = {f.name: f.dataType for f in schema.fields}
        casts = tuple((n, t) for n, t in own.items() if t != target[n] and (t.simpleString(), target[n].simpleString()) not in _READ_WIDER)
        scans.setdefault(casts, []).extend(part)
    rows = None
    for casts, group in scans.items():
        as_read = dict(casts)
        schema = T.StructType([T.StructField(n, as_read.get(n, t)) for n, t in target.items()])
        read = spark.read.schema(schema).parquet(*group)
        read = read.select(*[F.col(f"`{n}`").cast(t).alias(n) for n, t in target.items()])
        rows = read if rows is None else rows.unionByName(read)
    table = [(n, target[n].simpleString(), [t.simpleString() for t in types],
              "conflict" if n in conflicts else "same" if len(types) == 1 else "widened") for n, types in seen.items()]
    schema = T.StructType([T.StructField(n, t) for n, t in target.items()])
    return Reconciled(rows, schema, spark.createDataFrame(table, COLUMNS), conflicts)
