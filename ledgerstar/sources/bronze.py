"""Bronze transactions derived from the TPC-H-style input tables.

The raw bank file is not public, so bronze rows are derived from
``lineitem ⋈ part ⋈ supplier ⋈ nation`` by fixed rules that plant every
data-quality case the engine handles: a currency outside the allowed set and
NULL currencies, negative amounts, NULL timestamps, unknown category codes,
shared counterparty addresses and NULL addresses.

Scale: the three joins are foreign-key equi-joins declared through the
DataFrame API; Catalyst prunes every scan to the columns used below, and AQE
decides per join (runtime-measured size) between a broadcast and a
sort-merge join with skew splitting. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.constants import CATEGORY_CODES

# Currency by line number (1..6); line 7 gets NULL.
LINE_CURRENCY: tuple[str, ...] = ("EUR", "USD", "GBP", "J", "CAD", "CHF")
UNKNOWN_CATEGORY_CODE = 9999


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _currency(line: Column) -> Column:
    """CASE line WHEN 1 THEN 'EUR' ... END (NULL past the list)."""
    (first, *rest) = enumerate(LINE_CURRENCY, start=1)
    expr = F.when(line == first[0], F.lit(first[1]))
    for i, code in rest:
        expr = expr.when(line == i, F.lit(code))
    return expr


def bronze_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze (raw) transaction frame for the tables in ``sf_dir``."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_shipdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_size")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    supplier_nation = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
    rows = (li.join(part, li.l_partkey == part.p_partkey)
              .join(supplier_nation, li.l_suppkey == supplier_nation.s_suppkey))

    amount = F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") == 7),
                    -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    codes = F.array(*[F.lit(c) for c in CATEGORY_CODES])
    category = F.when(F.col("p_size") == 50, F.lit(UNKNOWN_CATEGORY_CODE)).otherwise(
        F.element_at(codes, (F.col("p_size") % len(CATEGORY_CODES) + 1).cast("int")))
    address = F.when(F.col("s_suppkey") % 10 == 9, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("ADDR "), (F.col("s_suppkey") - F.col("s_suppkey") % 2).cast("string")))

    return rows.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("booking_id"),
        _currency(F.col("l_linenumber")).alias("acct_ccy"),
        amount.alias("bookg_amt"),
        F.round(amount * 100).cast("bigint").alias("bookg_amt_nmrc"),
        F.when(F.col("l_quantity") == 13, F.lit(None))
         .otherwise(F.col("l_shipdate") + F.expr("INTERVAL 13 HOURS")).alias("bookg_dt_tm_cet"),
        F.when(F.col("l_quantity") == 27, F.lit(None))
         .otherwise(F.col("l_shipdate") + F.expr("INTERVAL 12 HOURS")).alias("bookg_dt_tm_gmt"),
        category.cast("int").alias("dtld_tx_tp"),
        F.col("s_name").alias("ctpty_nm"),
        F.col("n_name").alias("ctpty_ctry"),
        address.alias("ctpty_adr_line1"),
    )
