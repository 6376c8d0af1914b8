"""Files of differing schemas: one type a column, nothing lost, as few scans as needed."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.checks.queries import bronze
from ledgerstar.sources.reconcile import agreeing, list_files, read_reconciled, wider

TYPES = {"b": T.ByteType(), "s": T.ShortType(), "i": T.IntegerType(), "l": T.LongType(), "f": T.FloatType(), "d": T.DoubleType(),
         "t": T.StringType(), "date": T.DateType(), "ntz": T.TimestampNTZType(), "tz": T.TimestampType(), "bool": T.BooleanType(),
         "dec": T.DecimalType(10, 2), "fine": T.DecimalType(12, 8), "huge": T.DecimalType(38, 30)}


@pytest.mark.parametrize("a, b, want", [
    ("b", "s", "s"), ("i", "l", "l"), ("s", "f", "f"), ("i", "f", "d"), ("i", "d", "d"), ("l", "d", None), ("l", "f", None), ("f", "d", "d"),
    ("dec", "fine", T.DecimalType(16, 8)), ("dec", "huge", T.DecimalType(38, 30)), ("i", "dec", T.DecimalType(12, 2)), ("l", "huge", None),
    ("date", "ntz", "ntz"), ("date", "tz", None), ("ntz", "tz", None), ("t", "i", None), ("bool", "i", None), ("d", "dec", None), ("t", "t", "t"),
])
def test_wider(a, b, want):
    want = TYPES[want] if isinstance(want, str) else want
    assert wider(TYPES[a], TYPES[b]) == want and wider(TYPES[b], TYPES[a]) == want


def land(spark, root, *frames):
    for k, df in enumerate(frames):
        df.coalesce(1).write.parquet(f"{root}/day{k}")
    return f"{root}/day*"


def test_widened_filled_and_conflicting_columns(spark, wh):
    path = land(
        spark, f"{wh.root}/mixed",
        spark.createDataFrame([(1, 2, 1.5, "x")], "id int, n smallint, v float, `a.b` string"),
        spark.createDataFrame([(2**40, 0.1, "9.25")], "id bigint, v double, w string"),
        spark.createDataFrame([(3, 70000, Decimal("1.25"))], "id int, n int, w decimal(10,2)"),
        spark.createDataFrame([(4, True)], "id int, w boolean"),
        spark.createDataFrame([], "id int, n smallint"))
    got = read_reconciled(spark, path)
    assert got.rows.schema == got.schema
    assert [(f.name, f.dataType.simpleString()) for f in got.schema.fields] == [("id", "bigint"), ("n", "int"), ("v", "double"), ("a.b", "string"), ("w", "string")]
    rows = sorted(tuple(r) for r in got.rows.collect())
    assert rows == [(1, 2, 1.5, "x", None), (3, 70000, None, None, "1.25"), (4, None, None, None, "true"), (2**40, None, 0.1, None, "9.25")]
    outcome = {r["column"]: (r["type"], r.outcome) for r in got.columns.collect()}
    assert outcome == {"id": ("bigint", "widened"), "n": ("int", "widened"), "v": ("double", "widened"), "a.b": ("string", "same"), "w": ("string", "conflict")}
    assert got.conflicts == ["w"]


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


def test_scans_follow_the_conflicts(spark, wh):
    ints, longs = spark.range(5).select(F.col("id").cast("int").alias("k")), spark.range(5).select(F.col("id").alias("k"))
    texts = spark.range(5).select(F.col("id").cast("string").alias("k"))
    wide = read_reconciled(spark, land(spark, f"{wh.root}/wide", ints, longs, ints, longs))
    assert scans(wide.rows) == 1 and wide.rows.count() == 20 and wide.rows.agg(F.sum("k")).first()[0] == 40
    mixed = read_reconciled(spark, land(spark, f"{wh.root}/mixed", ints, texts, ints, texts, texts))
    assert scans(mixed.rows) == 2 and sorted(r.k for r in mixed.rows.distinct().collect()) == list("01234")


def test_agreeing_files_need_one_pass(spark, wh):
    path = f"{wh.root}/same"
    spark.range(100).repartition(12).write.parquet(path)
    files = list_files(spark, [path])
    assert len(files) == 12 and len(agreeing(spark, files)) == 1
    assert read_reconciled(spark, f"{path}/*.parquet").rows.count() == 100
    spark.range(1).write.json(f"{wh.root}/none")
    with pytest.raises(FileNotFoundError):
        read_reconciled(spark, f"{wh.root}/none")


def test_a_projection_reaches_every_scan(spark, wh):
    path = land(spark, f"{wh.root}/pruned", spark.range(9).selectExpr("id", "id AS v", "'x' AS note"), spark.range(9).selectExpr("id", "CAST(id AS string) AS v", "'y' AS note"))
    plan = read_reconciled(spark, path).rows.filter("id = 3").select("id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<id:bigint>") == 2 and plan.count("EqualTo(id,3)") == 2


def test_stream_over_differing_files(spark, wh):
    from ledgerstar.streaming.ingest import ingest_bronze, read_silver

    b = bronze(spark, "/root/testdata/sf0.001")
    path = f"{wh.root}/landing"
    b.filter("booking_id % 2 = 0").withColumn("bookg_amt", F.col("bookg_amt").cast("float")).write.parquet(path)
    b.filter("booking_id % 2 = 1").withColumn("note", F.lit("n")).write.mode("append").parquet(path)
    ingest_bronze(spark, path, f"{wh.root}/out", f"{wh.root}/reports", f"{wh.root}/_check").awaitTermination()
    silver = read_silver(spark, f"{wh.root}/out")
    assert silver.schema["bookg_amt"].dataType == T.DoubleType() and 0 < silver.filter("note = 'n'").count() < silver.count()
    spark.range(3).selectExpr("'x' AS bookg_amt").write.mode("append").parquet(path)
    with pytest.raises(ValueError, match="bookg_amt"):
        ingest_bronze(spark, path, f"{wh.root}/out2", f"{wh.root}/reports2", f"{wh.root}/_check2")
