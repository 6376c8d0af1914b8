"""Lookups whose dimension is not broadcast: results, hot keys, NULL keys, plans."""

import pytest
from pyspark.sql import functions as F

from ledgerstar.operators.joins import MAX_BROADCAST_BYTES_CONF, fits_broadcast, heavy_keys, lookup_join, row_spread, skewed_join

ROWS = 60_000


def facts(spark, path=None):
    """A third of the rows under key 7, a tenth without a key, the rest under 5,000 keys, some of them unknown."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 10 == 1, F.lit(None).cast("long")).otherwise(F.col("id") % 5000)
    df = spark.range(ROWS).select(key.alias("k"), (F.col("id") % 2).alias("v"))
    if path is None:
        return df
    df.write.parquet(path)
    return spark.read.parquet(path)


def dimension(spark):
    return spark.range(4900).select(F.col("id").alias("k"), (F.col("id") * 10).alias("code"), F.concat(F.lit("n"), "id").alias("name"))


@pytest.fixture()
def many_tasks(spark):
    settings = {"spark.sql.shuffle.partitions": "200", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_equals_a_plain_join(spark, wh, how):
    for fact in (facts(spark), facts(spark, f"{wh.root}/facts-{how}")):
        got, want = skewed_join(fact, dimension(spark), ["k"], how), fact.join(dimension(spark), ["k"], how)
        assert got.columns == want.columns
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_several_key_columns_and_clashing_names(spark):
    fact = facts(spark).withColumn("salt", F.lit(1)).withColumn("a.b", F.col("v"))
    dim = dimension(spark).select("k", (F.col("code") % 2).cast("long").alias("v"), "name")
    got, want = skewed_join(fact, dim, ["k", "v"]), fact.join(dim, ["k", "v"], "left")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_empty_sides(spark):
    fact, dim = facts(spark), dimension(spark)
    assert skewed_join(fact.limit(0), dim, ["k"]).count() == 0
    assert skewed_join(fact, dim.limit(0), ["k"]).filter("name IS NOT NULL").count() == 0
    assert skewed_join(fact.filter("k IS NULL"), dim, ["k"]).count() == fact.filter("k IS NULL").count()


def test_only_heavy_keys_are_found(spark):
    fact = facts(spark).filter("k IS NOT NULL")
    rows = heavy_keys(fact, ["k"], 200).collect()
    code = spark.range(1).select(F.xxhash64(F.lit(7).cast("long"))).first()[0]
    n, hot = fact.count(), fact.filter("k = 7").count()
    assert [r["_ls_code"] for r in rows] == [code]
    assert abs(rows[0]["_ls_buckets"] - 4 * 200 * hot / n) < 20
    assert heavy_keys(fact.filter("k <> 7"), ["k"], 200).count() == 0


def test_a_third_of_the_facts_uses_most_tasks(spark, wh, many_tasks):
    joined = lookup_join(facts(spark, f"{wh.root}/facts"), dimension(spark), "k", max_broadcast_rows=0)
    per_task = joined.filter("k = 7").groupBy(F.spark_partition_id().alias("task")).count().collect()
    sizes = [r["count"] for r in per_task]
    assert len(sizes) > 120 and max(sizes) < 8 * ROWS / 200


def test_copies_of_stored_rows_are_spread(spark, wh):
    stored = facts(spark, f"{wh.root}/facts")
    alike = stored.filter("k = 7 AND v = 0")
    assert alike.select(row_spread(alike).alias("s")).distinct().count() == alike.count()
    unstored = facts(spark).filter("k = 7 AND v = 0")
    assert unstored.select(row_spread(unstored).alias("s")).distinct().count() == 1


def test_null_keys_go_around_the_shuffle(spark, wh, many_tasks):
    joined = skewed_join(facts(spark, f"{wh.root}/facts"), dimension(spark), ["k"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    union = plan[plan.index("Union"):]
    without = union[union.rindex("isnull(k"):]  # the last branch of the union
    assert "Exchange" not in without.split("FileScan")[0] and "SortMergeJoin" not in without.split("FileScan")[0]


def test_a_large_stored_dimension_is_not_read(spark, wh):
    path = f"{wh.root}/dim"
    dimension(spark).write.parquet(path)
    stored = spark.read.parquet(path)
    assert fits_broadcast(stored)
    spark.conf.set(MAX_BROADCAST_BYTES_CONF, "1000")
    try:
        group = "size-check"
        spark.sparkContext.setJobGroup(group, "fits_broadcast")
        assert not fits_broadcast(stored)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == 0
    finally:
        spark.conf.unset(MAX_BROADCAST_BYTES_CONF)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
