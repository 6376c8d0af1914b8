"""Dense ids, insert-only merge, dimensions (hazards H4-H7)."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerstar import schemas
from ledgerstar.operators.keys import dense_ids, max_id
from ledgerstar.operators.merge import build_dim, dedupe_by_key, insert_only_merge, union_dedupe_by_key
from ledgerstar.sinks import create_table_if_absent


@settings(max_examples=12, deadline=None)
@given(keys=st.lists(st.one_of(st.none(), st.integers(-50, 50)), max_size=60, unique=True),
       per_part=st.integers(1, 7), base=st.integers(0, 1000))
def test_dense_ids_equal_global_row_number(spark, keys, per_part, base):
    df = spark.createDataFrame([(k, f"v{k}") for k in keys], "k int, v string")
    got = {r["k"]: r["id"] for r in dense_ids(df, ["k"], "id", base=base, rows_per_partition=per_part).collect()}
    ordered = sorted(keys, key=lambda k: (k is not None, k if k is not None else 0))
    assert got == {k: base + i + 1 for i, k in enumerate(ordered)}


def test_dense_ids_base_from_table_max_and_overflow(spark):
    existing = spark.createDataFrame([(1,), (7,)], "id int")
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    assert sorted(r["id"] for r in dense_ids(df, ["k"], "id", base=max_id(existing, "id")).collect()) == [8, 9]
    assert max_id(existing.filter("id > 100"), "id").first()["max_id"] == 0
    with pytest.raises(Exception):
        dense_ids(df, ["k"], "id", base=2**31 - 2).collect()  # ANSI: no silent wrap


def test_dense_ids_match_window_on_wide_rows(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"), F.col("id").cast("string").alias("s"),
                                     (F.col("id") % 3).alias("g"))
    got = dense_ids(df, ["k"], "rid", base=10, rows_per_partition=400)
    want = df.withColumn("rid", F.row_number().over(Window.orderBy("k")) + 10)
    assert got.exceptAll(want).count() == 0 and got.count() == 5000


def _dim(spark, wh):
    wh.ensure_database("gold")
    name = wh.table("gold", "counter_party_dim")
    create_table_if_absent(spark, name, schemas.COUNTER_PARTY_DIM, wh.location("gold", "counter_party_dim"))
    return name


def _cp(spark, rows):
    return spark.createDataFrame(rows, "counterparty_add string, counterparty_country string, counterparty_name string")


def test_build_dim_is_insert_only_dense_and_null_safe(spark, wh):
    name = _dim(spark, wh)
    first = [("A1", "NL", "x"), ("A1", "NL", "y"), (None, "BE", "n"), ("B2", "DE", "z")]
    assert build_dim(_cp(spark, first), name, ["counterparty_add"], "counterparty_id") == 3  # H4: one per key
    second = [("A1", "FR", "changed"), (None, "BE", "n"), ("C3", "NL", "c"), ("0", "NL", "zero")]
    assert build_dim(_cp(spark, second), name, ["counterparty_add"], "counterparty_id") == 2
    rows = {r["counterparty_add"]: (r["counterparty_country"], r["counterparty_name"], r["counterparty_id"])
            for r in spark.table(name).collect()}
    assert rows == {None: ("BE", "n", 1), "A1": ("NL", "x", 2), "B2": ("DE", "z", 3),  # H5 one NULL member
                    "0": ("NL", "zero", 4), "C3": ("NL", "c", 5)}  # H6 unchanged, H7 dense above max
    # merging the same data again changes nothing
    assert build_dim(_cp(spark, second + first), name, ["counterparty_add"], "counterparty_id") == 0
    assert spark.table(name).count() == 5


def test_merge_primitive_keeps_sql_equality_and_duplicates(spark, wh):
    name = _dim(spark, wh)
    src = _cp(spark, [(None, "BE", "n"), ("A1", "NL", "x"), ("A1", "NL", "y")])
    assert insert_only_merge(src, name, ["counterparty_add"], "counterparty_id") == 3
    assert insert_only_merge(src, name, ["counterparty_add"], "counterparty_id") == 1  # NULL again (H5)
    assert sorted(r["counterparty_id"] for r in spark.table(name).collect()) == [1, 2, 3, 4]


def test_dedupe_by_key_is_deterministic(spark):
    df = _cp(spark, [("A", "Z", "b"), ("A", "Y", "c"), ("A", "Y", "a")])
    assert [tuple(r) for r in dedupe_by_key(df, ["counterparty_add"]).collect()] == [("A", "Y", "a")]


def test_union_dedupe_existing_wins_and_renumbers(spark):
    existing = spark.createDataFrame([("B", "old", 7)], "k string, v string, id int")
    incoming = spark.createDataFrame([("B", "new"), ("A", "a")], "k string, v string")
    got = sorted(tuple(r) for r in union_dedupe_by_key(existing, incoming, ["k"], "id").collect())
    assert got == [("A", "a", 1), ("B", "old", 2)]


def test_dense_ids_split_a_hot_duplicate_key_across_partitions(spark):
    """A third of the rows are identical copies: they still spread over ranges."""
    hot = spark.range(0, 3000).select(F.lit(5).alias("k"), F.lit("same").alias("s"))
    rest = spark.range(0, 6000).select((F.col("id") % 997).alias("k"), F.col("id").cast("string").alias("s"))
    df = hot.unionByName(rest)
    got = dense_ids(df, ["k"], "rid", rows_per_partition=500)
    ids = [r["rid"] for r in got.select("rid").collect()]
    assert sorted(ids) == list(range(1, 9001))
    # ids follow key order: every k=5 row is numbered after all smaller keys
    below = df.filter("k < 5").count()
    hot_ids = sorted(r["rid"] for r in got.filter("k = 5").collect())
    assert hot_ids[0] == below + 1 and hot_ids[-1] == below + df.filter("k = 5").count()
    # the output keeps the range partitioning: the hot copies span several partitions
    spread = got.filter("k = 5").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(spread) >= 3 and max(r["count"] for r in spread) <= 1500


def test_dense_ids_are_a_function_of_the_data(spark):
    """Same input, different shuffle settings and input partitioning: same ids."""
    base = spark.range(0, 4000).select((F.col("id") % 1500).alias("k"), (F.col("id") % 7).alias("g"))
    first = {(r["k"], r["g"], r["rid"]) for r in dense_ids(base, ["k"], "rid", rows_per_partition=300).collect()}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        shuffled = base.repartition(5, "g")
        second = {(r["k"], r["g"], r["rid"]) for r in
                  dense_ids(shuffled, ["k"], "rid", rows_per_partition=300).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert first == second


@settings(max_examples=5, deadline=None)
@given(first=st.lists(st.one_of(st.none(), st.sampled_from(list("abcdefgh"))), max_size=12),
       second=st.lists(st.one_of(st.none(), st.sampled_from(list("abcdefghij"))), max_size=12))
def test_build_dim_twice_equals_once_and_ids_stay_dense(spark, first, second):
    from ledgerstar.sinks import Warehouse

    wh = Warehouse.fresh(spark, "prop")
    name = _dim(spark, wh)
    rows = lambda keys: _cp(spark, [(k, "NL", f"n{k}") for k in keys]) if keys else _cp(spark, [])
    build_dim(rows(first), name, ["counterparty_add"], "counterparty_id")
    before = {r["counterparty_add"]: r["counterparty_id"] for r in spark.table(name).collect()}
    build_dim(rows(second), name, ["counterparty_add"], "counterparty_id")
    build_dim(rows(second), name, ["counterparty_add"], "counterparty_id")  # again: no change
    after = {r["counterparty_add"]: r["counterparty_id"] for r in spark.table(name).collect()}
    assert spark.table(name).count() == len(after) == len(set(first) | set(second))
    assert all(after[k] == v for k, v in before.items())  # existing ids never change
    assert sorted(after.values()) == list(range(1, len(after) + 1))  # dense
    new = sorted((k is not None, k or "") for k in after if k not in before)
    assert [after[None if not has else k] for has, k in new] == list(range(len(before) + 1, len(after) + 1))


def test_id_overflow_fails_without_ansi_too(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        with pytest.raises(Exception, match="exceeds"):
            dense_ids(df, ["k"], "id", base=2**31 - 2).collect()
        assert sorted(r["id"] for r in dense_ids(df, ["k"], "id", base=2**31 - 3).collect()) == [2**31 - 2, 2**31 - 1]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_union_dedupe_treats_null_keys_as_one_member(spark):
    existing = spark.createDataFrame([(None, "old", 4), ("B", "b", 9)], "k string, v string, id int")
    incoming = spark.createDataFrame([(None, "new"), ("A", "a"), (None, "newer")], "k string, v string")
    got = sorted((r["k"] or "", r["v"], r["id"]) for r in
                 union_dedupe_by_key(existing, incoming, ["k"], "id").collect())
    assert got == [("", "old", 1), ("A", "a", 2), ("B", "b", 3)]
