"""Counts and maxima from footers: results, plans, tables without files."""

from pyspark.sql import functions as F

from ledgerstar.operators.keys import max_id, stored_max_id
from ledgerstar.plans import gold
from ledgerstar.sinks import append_by_name
from ledgerstar.sources.footers import from_footers

DIM = gold.DIMENSIONS[3]
MEMBERS = "counterparty_add string, counterparty_country string, counterparty_name string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_and_maxima_are_pushed(spark, wh):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    gold.ensure_gold(wh)
    name = wh.table("gold", DIM.table)
    assert from_footers(spark, name).count() == 0 and max_id(from_footers(spark, name), DIM.id_col).first().max_id == 0
    for k in range(3):
        gold.load_dimension(wh, DIM, spark.createDataFrame([(f"a{i}", "x", "n") for i in range(10 * k, 10 * k + 10)], MEMBERS))
    stored = from_footers(spark, name)
    assert "PushedAggregation: [MAX(counterparty_id)]" in plan(stored_max_id(spark, name, DIM.id_col))
    top, n = max_id(stored, DIM.id_col), stored.agg(F.count(F.lit(1)).alias("n"))
    assert (top.first().max_id, n.first().n) == (30, 30)
    assert "PushedAggregation: [MAX(counterparty_id)]" in plan(top) and "PushedAggregation: [COUNT(*)]" in plan(n)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert "PushedAggregation: [COUNT(*)]" in plan(gold.gold_audit(wh))
    assert {r.table_name: r.row_count for r in gold.gold_audit(wh).collect()}[DIM.table] == 30


def test_null_ids_and_repeated_appends(spark, wh):
    gold.ensure_gold(wh)
    name = wh.table("gold", gold.FACT_TABLE)
    schema = "currency_id int, date_id int, counterparty_id int, category_id int, amount_euro double"
    append_by_name(spark.createDataFrame([(None, 1, None, 1, 1.0)], schema), name)
    append_by_name(spark.createDataFrame([(4, 1, None, 1, 2.0), (None, 2, None, 1, None)], schema), name)
    assert from_footers(spark, name).count() == 3
    assert max_id(from_footers(spark, name), "date_id").first().max_id == 2


def test_a_column_of_nulls(spark, wh):
    gold.ensure_gold(wh)
    name = wh.table("gold", gold.FACT_TABLE)
    schema = "currency_id int, date_id int, counterparty_id int, category_id int, amount_euro double"
    append_by_name(spark.createDataFrame([(1, 1, None, 1, 1.0)], schema), name)
    append_by_name(spark.createDataFrame([(2, 1, 7, 1, 1.0)], schema).limit(0), name)
    assert stored_max_id(spark, name, "counterparty_id").first().max_id == 0
    append_by_name(spark.createDataFrame([(2, 1, 7, 1, 1.0)], schema), name)
    assert stored_max_id(spark, name, "counterparty_id").first().max_id == 7


def test_threads_leave_the_setting_as_it_was(spark, wh):
    from ledgerstar.session import run_concurrently

    gold.ensure_gold(wh)
    name = wh.table("gold", DIM.table)
    gold.load_dimension(wh, DIM, spark.createDataFrame([("a", "x", "n")], MEMBERS))
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    got = run_concurrently({k: (lambda: stored_max_id(spark, name, DIM.id_col).first().max_id) for k in range(12)})
    assert set(got.values()) == {1} and spark.conf.get("spark.sql.sources.useV1SourceList") == before
