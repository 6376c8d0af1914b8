"""Order that shows: ranks of stored rows, positions of columns, and that a wrong order is seen."""

from pyspark.sql import functions as F

from ledgerstar.sources.files import with_stored_rank


def test_rank_follows_the_stored_order(spark, wh):
    path = f"{wh.root}/ordered"
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"), F.lit(1).alias("a.b"))
    rows.repartitionByRange(5, "v").sortWithinPartitions("v").write.parquet(path)
    got = with_stored_rank(spark.read.parquet(path), "rank")
    assert got.columns == ["v", "a.b", "rank"]
    assert sorted((r.v, r["rank"]) for r in got.collect()) == [(v, v + 1) for v in range(1000)]
    wrong = f"{wh.root}/wrong"
    rows.repartition(5, "v").write.parquet(wrong)
    assert with_stored_rank(spark.read.parquet(wrong), "rank").filter("rank <> v + 1").count() > 0


def test_registered_orders_are_visible(spark):
    from ledgerstar.checks.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    calendar = QUERIES["calendar_dim"](spark, sf)
    days = [r.payment_date for r in calendar.orderBy("stored_rank").collect()]
    assert days == sorted(days) and len(days) > 1000
    assert QUERIES["reorder_columns"](spark, sf).columns == [f"column_{i}" for i in range(7)]
