"""Lookup joins from a large fact side to a dimension.

The dimension's size is checked before it is broadcast: its rows and bytes (one
partial aggregate per task, the only values that reach the driver). A stored
dimension whose files alone exceed the limit is not read for that.

Above either limit the join is a shuffle join, with heavy keys measured first:
one pass over the fact keys fills a mergeable frequency sketch, which names
every key that holds more than one task's share of the rows. Only these keys
are salted, each over buckets in proportion to its rows, and only their
dimension rows are replicated. There are fewer of them than tasks, so the list
is a bounded broadcast. Rows with a NULL key match nothing and do not enter the
shuffle at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS_CONF = "ledgerstar.join.maxBroadcastRows"
MAX_BROADCAST_BYTES_CONF = "ledgerstar.join.maxBroadcastBytes"
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 128 << 20
BUCKETS_PER_SHARE = 4  # salt buckets for each task's share of the rows that a heavy key holds
TRACKED_PER_TASK = 16  # keys the frequency sketch keeps for each task: its error is then a small part of a task's share
MAX_TRACKED = 100_000
_BYTES_PER_VALUE = 16  # a value's share of its row in a broadcast table, besides its text


def _conf_int(df: DataFrame, key: str, default: int) -> int:
    return int(df.sparkSession.conf.get(key, str(default)))


def row_spread(df: DataFrame) -> Column:
    """A number for each row that tells rows apart and is the same whenever the row is read again.

    For rows of stored files it is a hash of the file and the row's place in it, so copies of a row differ, too.
    Otherwise it is a hash of the whole row: exact copies share it. A position counted at run time would not do:
    a task that is recomputed after a lost executor may get its input in another order.
    """
    if _reads_files(df):
        return F.xxhash64("_metadata.file_path", "_metadata.row_index")
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def _reads_files(df: DataFrame) -> bool:
    """Whether ``df`` is one stored table, with nothing above it but projections and filters."""
    node = df._jdf.queryExecution().analyzed()
    while node.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.child()
    return node.getClass().getSimpleName() == "LogicalRelation"


def salted_join(fact: DataFrame, dim: DataFrame, key_cols: Sequence[str], how: str, buckets: int) -> DataFrame:
    """Equi-join on ``key_cols`` with every fact row salted over ``buckets`` and the whole dimension replicated."""
    salted_fact = fact.withColumn("_ls_salt", F.pmod(row_spread(fact), F.lit(buckets)).cast("int"))
    salted_dim = dim.withColumn("_ls_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return salted_fact.join(salted_dim, [*key_cols, "_ls_salt"], how).drop("_ls_salt")


def _key_code(key_cols: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in key_cols])


def heavy_keys(fact: DataFrame, key_cols: Sequence[str], tasks: int) -> DataFrame:
    """(_ls_code, _ls_buckets) of every key that holds more than one of ``tasks`` equal shares of the rows.

    One partial aggregate per task (a frequency sketch of bounded size), merged in one. At most ``tasks`` keys can
    be heavy. The code is a hash of the key: two keys of one code would merely be salted alike.
    """
    tracked = min(MAX_TRACKED, TRACKED_PER_TASK * tasks)
    found = fact.select(_key_code(key_cols).alias("code")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(code, {min(tasks, 10_000, tracked)}, {tracked})").alias("top")).first()
    share = found["n"] / tasks
    rows = [(t["item"], -(-BUCKETS_PER_SHARE * t["count"] * tasks // found["n"])) for t in found["top"] or [] if t["count"] > share]
    return fact.sparkSession.createDataFrame(rows, "_ls_code bigint, _ls_buckets int")


def skewed_join(fact: DataFrame, dim: DataFrame, key_cols: Sequence[str], how: str = "left",
                spread: Column | None = None, tasks: int | None = None) -> DataFrame:
    """Equi-join (left or inner) on ``key_cols`` that spreads heavy keys over tasks in proportion to their rows.

    ``spread`` tells the rows of a key apart (``row_spread``); the fact side is read once to measure its keys and
    once to join. With a left join, rows without a key skip the shuffle and get NULLs.
    """
    key_cols = list(key_cols)
    spark = fact.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = fact.withColumn("_ls_spread", row_spread(fact) if spread is None else spread)
    keyed = F.lit(True)
    for k in key_cols:
        keyed = keyed & F.col(f"`{k}`").isNotNull()
    heavy = heavy_keys(fact.filter(keyed), key_cols, tasks)

    def with_buckets(df: DataFrame) -> DataFrame:
        coded = df.withColumn("_ls_code", _key_code(key_cols))
        return coded.join(F.broadcast(heavy), "_ls_code", "left").withColumn("_ls_buckets", F.coalesce("_ls_buckets", F.lit(1)))

    salted = with_buckets(rows.filter(keyed)).withColumn("_ls_salt", F.pmod(F.col("_ls_spread"), F.col("_ls_buckets")).cast("int"))
    copies = with_buckets(dim).withColumn("_ls_salt", F.explode(F.sequence(F.lit(0), F.col("_ls_buckets") - 1)))
    copies = copies.drop("_ls_code", "_ls_buckets")
    joined = salted.join(copies, [*key_cols, "_ls_salt"], how).drop("_ls_salt", "_ls_code", "_ls_buckets", "_ls_spread")
    if how != "left":
        return joined
    nothing = {f.name: F.lit(None).cast(f.dataType) for f in dim.schema.fields if f.name not in key_cols}
    return joined.unionByName(fact.filter(~keyed).withColumns(nothing))


def _stored_bytes(df: DataFrame) -> int | None:
    """Bytes of the files below a plan that reads one stored table; None for any other plan."""
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    if leaves.size() != 1 or leaves.apply(0).getClass().getSimpleName() != "LogicalRelation":
        return None
    return int(plan.stats().sizeInBytes())


def fits_broadcast(dim: DataFrame, max_rows: int | None = None) -> bool:
    """Whether ``dim`` has at most ``max_rows`` rows and fits the limit on bytes.

    One aggregate with a partial row per task. Bytes are estimated as the
    length of every value's text plus a fixed share per value, so a dimension
    of few but long values counts as large. A ``limit(n + 1).count()`` would
    instead gather up to n + 1 rows from every task into a single partition.
    A stored table whose (pruned) files exceed the limit on bytes is not read.
    """
    max_bytes = _conf_int(dim, MAX_BROADCAST_BYTES_CONF, DEFAULT_MAX_BROADCAST_BYTES)
    stored = _stored_bytes(dim)
    if stored is not None and stored > max_bytes:
        return False
    limit = max_rows if max_rows is not None else _conf_int(dim, MAX_BROADCAST_ROWS_CONF,
                                                             DEFAULT_MAX_BROADCAST_ROWS)
    lengths = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)).cast("bigint") for c in dim.columns]
    row_bytes = sum(lengths, F.lit(_BYTES_PER_VALUE * len(dim.columns)).cast("bigint"))
    size = dim.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes), F.lit(0)).alias("bytes")).first()
    return size["rows"] <= limit and size["bytes"] <= max_bytes


def lookup_join(fact: DataFrame, dim: DataFrame, key_cols: Sequence[str] | str, how: str = "left",
                max_broadcast_rows: int | None = None, salt_buckets: int | None = None,
                small: bool | None = None, spread: Column | None = None) -> DataFrame:
    """``fact JOIN dim USING (key_cols)``: broadcast when the dimension is small enough, else ``skewed_join``.

    ``small`` is the result of ``fits_broadcast`` when the caller already
    checked. ``salt_buckets`` asks for that many buckets for every key instead
    of measured ones. SQL equality: a NULL fact key finds no dimension row
    (left join: NULLs).
    """
    key_cols = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    if small is None:
        small = fits_broadcast(dim, max_broadcast_rows)
    if small:
        return fact.join(F.broadcast(dim), key_cols, how)
    if salt_buckets is not None:
        return salted_join(fact, dim, key_cols, how, salt_buckets)
    return skewed_join(fact, dim, key_cols, how, spread)
