"""Plan checks: scans pruned and filtered, no Python in the hot path."""

import contextlib
import glob
import io

from conftest import SF001
from pyspark.sql import functions as F
from ledgerstar.checks import queries as QQ


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("extended")
    return buf.getvalue()


def test_emission_report_pushes_country_and_prunes_columns(spark):
    plan = _plan(QQ.emission_mean_by_category(spark, SF001))
    assert "EqualTo(n_name,NATION_19)" in plan
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_linenumber:int" in plan or "l_orderkey" not in plan
    assert "BroadcastHashJoin" in plan


def test_no_python_evaluation_in_lazy_queries(spark):
    lazy = ["suite_report", "clean_rows", "quarantine_rows", "staging_transactions", "to_euro",
            "emission_per_row", "emission_mean_by_category", "unexpected_values", "calendar_dim"]
    for name in lazy:
        plan = _plan(QQ.QUERIES[name](spark, SF001))
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
            assert node not in plan, (name, node)


def test_suite_is_one_aggregation_pass(spark):
    physical = _plan(QQ.suite_report(spark, SF001)).split("== Physical Plan ==")[1]
    assert physical.count("Scan parquet") == 4  # the four input tables, each once
    assert physical.count("HashAggregate") == 2  # partial + final, one pass for all rules


def test_no_single_partition_exchange_over_rows(spark):
    """Only global aggregates may gather to one partition (one partial row per task)."""
    for name in ("clean_rows", "staging_transactions", "to_euro", "emission_report", "quarantine_rows"):
        physical = _plan(QQ.QUERIES[name](spark, SF001)).split("== Physical Plan ==")[1]
        assert "SinglePartition" not in physical, name
    wh = QQ.gold_loaded(spark, SF001, "plan-check")
    dims = {d.table: spark.table(wh.table("gold", d.table)) for d in QQ.gold.DIMENSIONS}
    physical = _plan(QQ.gold.resolve_fact_keys(QQ.staged(spark, SF001), dims)).split("== Physical Plan ==")[1]
    assert "SinglePartition" not in physical and physical.count("BroadcastHashJoin") >= 4
    # all four dimensions broadcast: the fact rows themselves are never shuffled
    assert "hashpartitioning" not in physical and "SortMergeJoin" not in physical


def test_null_safe_anti_join_is_an_equi_join(spark):
    """`<=>` keys must not degrade into a nested-loop join against a large dimension."""
    from ledgerstar.operators.merge import new_rows_only

    src = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    tgt = spark.createDataFrame([("a", 1)], "k string, v int")
    for null_safe in (True, False):
        plan = _plan(new_rows_only(src, tgt, ["k"], null_safe=null_safe))
        assert "NestedLoopJoin" not in plan and ("SortMergeJoin" in plan or "BroadcastHashJoin" in plan)


def test_few_long_values_are_not_broadcast(spark):
    from ledgerstar.operators.joins import MAX_BROADCAST_BYTES_CONF, fits_broadcast

    dim = spark.range(0, 100).selectExpr("id", "repeat('x', 1000) AS `long.text`", "CAST(NULL AS STRING) AS none")
    assert fits_broadcast(dim) and fits_broadcast(dim.limit(0), 0) and not fits_broadcast(dim, 99)
    spark.conf.set(MAX_BROADCAST_BYTES_CONF, str(100_000))
    try:
        assert not fits_broadcast(dim) and fits_broadcast(dim.drop("long.text"))
    finally:
        spark.conf.unset(MAX_BROADCAST_BYTES_CONF)


def test_stream_of_text_columns_keeps_every_column_and_older_output(spark, wh):
    from ledgerstar.checks.queries import text_bronze
    from ledgerstar.plans.medallion import bronze_to_silver
    from ledgerstar.streaming.ingest import ingest_bronze, read_silver

    landing = f"{wh.root}/landing"
    raw = text_bronze(spark, SF001).withColumn("note", F.col("ctpty_nm"))
    raw.repartition(2, "booking_id").write.parquet(landing)
    want = bronze_to_silver(spark.read.parquet(landing), f"{wh.root}/batch")

    def run(checkpoint):
        ingest_bronze(spark, landing, f"{wh.root}/stream", f"{wh.root}/reports", f"{wh.root}/{checkpoint}",
                      max_files_per_trigger=1).awaitTermination()
        return read_silver(spark, f"{wh.root}/stream")

    got = run("first").select(want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and "note" in want.columns
    assert run("first").count() == want.count()  # nothing new has landed
    assert run("second").count() == 2 * want.count()  # a lost checkpoint overwrites nothing
    ids = [r["stream"] for r in spark.read.parquet(f"{wh.root}/stream").select("stream").distinct().collect()]
    assert [read_silver(spark, f"{wh.root}/stream", i).count() for i in ids] == [want.count()] * 2


def test_stream_lands_more_files_as_the_table_grows(spark, tmp_path, monkeypatch):
    import pyarrow.parquet as pq
    from ledgerstar.checks import queries
    from ledgerstar.sinks import Warehouse

    sf = str(tmp_path)
    spark.range(1, 601).selectExpr(
        "id AS l_orderkey", "id % 7 AS l_partkey", "id % 5 AS l_suppkey", "CAST(id % 7 + 1 AS INT) AS l_linenumber", "CAST(id % 30 AS DOUBLE) AS l_quantity",
        "CAST(id AS DOUBLE) AS l_extendedprice", "IF(id % 3 = 0, 'R', 'N') AS l_returnflag", "TIMESTAMP_NTZ'1997-01-01 00:00:00' AS l_shipdate",
    ).write.parquet(f"{sf}/lineitem.parquet")
    spark.range(7).selectExpr("id AS p_partkey", "CAST(id AS INT) AS p_size").write.parquet(f"{sf}/part.parquet")
    spark.range(5).selectExpr("id AS s_suppkey", "concat('S', id) AS s_name", "CAST(id % 2 AS INT) AS s_nationkey").write.parquet(f"{sf}/supplier.parquet")
    spark.range(2).selectExpr("CAST(id AS INT) AS n_nationkey", "concat('N', id) AS n_name").write.parquet(f"{sf}/nation.parquet")
    roots, fresh = [], Warehouse.fresh
    monkeypatch.setattr(Warehouse, "fresh", lambda *a: roots.append(fresh(*a)) or roots[-1])
    want = queries.silver(spark, sf)
    for rows, least in ((1_000_000, 3), (50, 12)):
        monkeypatch.setattr(queries, "LANDED_ROWS_PER_FILE", rows)
        got = queries.stream_bronze_to_silver(spark, sf)
        assert got.count() == want.count() and got.select(want.columns).exceptAll(want).isEmpty()
        root = roots[-1].root.removeprefix("file:")
        sizes = [pq.read_metadata(f).num_rows for f in glob.glob(f"{root}/bronze/*.parquet")]
        assert sum(sizes) == 600 and len(sizes) == least and max(sizes) <= 2 * max(50, 600 // least)
        assert len(glob.glob(f"{root}/silver/stream=*/batch_id=*")) == 3
