"""A dimension renumbered under stored facts."""

import pytest
from pyspark.sql import functions as F

from ledgerstar.operators.joins import MAX_BROADCAST_ROWS_CONF
from ledgerstar.plans import gold

DIM = gold.DIMENSIONS[3]
MEMBERS = "counterparty_add string, counterparty_country string, counterparty_name string"


def loaded(spark, wh):
    """Members c, NULL, m; facts that refer to them, one to none."""
    gold.ensure_gold(wh)
    gold.load_dimension(wh, DIM, spark.createDataFrame([("m", "x", "1"), ("c", "x", "2"), (None, "y", "3")], MEMBERS))
    ids = {r.counterparty_add: r.counterparty_id for r in spark.table(wh.table("gold", DIM.table)).collect()}
    rows = [(1, 1, ids[k], 1, float(n)) for n, k in enumerate(["m", "c", "m", None])] + [(1, 1, None, 1, 9.0)]
    facts = spark.createDataFrame(rows, "currency_id int, date_id int, counterparty_id int, category_id int, amount_euro double")
    gold.append_by_name(facts, wh.table("gold", gold.FACT_TABLE))
    return ids


def resolved(spark, wh):
    members = spark.table(wh.table("gold", DIM.table))
    facts = spark.table(wh.table("gold", gold.FACT_TABLE)).join(members, "counterparty_id", "left")
    return sorted((r.amount_euro, r.counterparty_add, r.counterparty_name) for r in facts.collect())


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_facts_keep_their_members(spark, wh, limit):
    spark.conf.set(MAX_BROADCAST_ROWS_CONF, str(limit))
    try:
        ids, before = loaded(spark, wh), resolved(spark, wh)
        incoming = spark.createDataFrame([("a", "z", "4"), ("c", "other", "5"), ("n", "z", "6"), (None, "other", "7")], MEMBERS)
        moved = {r.counterparty_id: r.new_id for r in gold.rebuild_dimension(wh, DIM, incoming).collect()}
    finally:
        spark.conf.unset(MAX_BROADCAST_ROWS_CONF)
    members = {r.counterparty_add: (r.counterparty_id, r.counterparty_name) for r in spark.table(wh.table("gold", DIM.table)).collect()}
    assert members == {None: (1, "3"), "a": (2, "4"), "c": (3, "2"), "m": (4, "1"), "n": (5, "6")}
    assert moved == {ids[None]: 1, ids["c"]: 3, ids["m"]: 4}
    assert resolved(spark, wh) == before
    assert spark.table(wh.table("gold", gold.FACT_TABLE)).columns == [f.name for f in gold.schemas.TRANSACTIONS_FACT.fields]
    # Later loads go on from the renumbered dimension.
    assert gold.load_dimension(wh, DIM, spark.createDataFrame([("b", "z", "8"), ("m", "z", "9")], MEMBERS)) == 1
    assert spark.table(wh.table("gold", DIM.table)).agg(F.max("counterparty_id")).first()[0] == 6


def test_a_fact_without_a_member_fails(spark, wh):
    loaded(spark, wh)
    stray = spark.createDataFrame([(1, 1, 77, 1, 5.0)], "currency_id int, date_id int, counterparty_id int, category_id int, amount_euro double")
    gold.append_by_name(stray, wh.table("gold", gold.FACT_TABLE))
    count = spark.table(wh.table("gold", gold.FACT_TABLE)).count()
    with pytest.raises(Exception, match="refers to no member"):
        gold.rebuild_dimension(wh, DIM, spark.createDataFrame([("a", "z", "4")], MEMBERS))
    assert spark.table(wh.table("gold", gold.FACT_TABLE)).count() == count
    assert spark.table(wh.table("gold", DIM.table)).count() == 3
