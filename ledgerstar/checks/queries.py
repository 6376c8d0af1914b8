"""Registered queries: one per operator of the inventory, over whole tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame. Queries that
exercise writes (sinks, merges, gold loads) write into a fresh folder below
the shared root and return what they read back. Every query starts from the
input tables in ``sf_dir`` (through the bronze derivation), so its work grows
with them.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar import schemas
from ledgerstar.functions.columns import blank_columns, conform, reorder_columns
from ledgerstar.functions.dates import format_day, parse_day, to_day
from ledgerstar.operators import quality as Q
from ledgerstar.operators.joins import lookup_join
from ledgerstar.operators.keys import dense_ids, stored_max_id
from ledgerstar.operators.merge import (build_dim, dedupe_by_key, insert_only_merge,
                                        union_dedupe_by_key)
from ledgerstar.plans import analytics, gold, staging
from ledgerstar.plans.medallion import validate
from ledgerstar.sinks import (Warehouse, create_table_if_absent, overwrite_parquet,
                              overwrite_table)
from ledgerstar.sources import files
from ledgerstar.sources.bronze import bronze_transactions
from ledgerstar.sources.reconcile import read_reconciled
from ledgerstar.sources.reference_data import currency_rates, sample_category_map

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the checks.
COUNTRY = "NATION_19"
BATCH_SPLIT = dt.date(1998, 1, 1)  # first load: payments before this day; second: all
PREVIEW_ROWS = 10
DENSE_ROWS_PER_PARTITION = 5_000  # small on purpose: many range partitions at test scale
LOADS = 3  # micro-batches of the stream
LANDED_ROWS_PER_FILE = 1_000_000


# --- shared building blocks -------------------------------------------------

def bronze(spark: SparkSession, sf: str) -> DataFrame:
    return conform(bronze_transactions(spark, sf), schemas.BRONZE_TYPES)


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return Q.clean_rows(bronze(spark, sf))


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage_transactions(silver(spark, sf))


def category_csv(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """The category map, written as CSV and read back with the CSV source."""
    path = f"{wh.root}/raw/category_map.csv"
    sample_category_map(spark).write.mode("overwrite").options(**files.CSV_OPTIONS).csv(path)
    return staging.read_category_map(spark, path)


def first_batch(df: DataFrame) -> DataFrame:
    return df.filter(F.col("payment_date") < F.lit(BATCH_SPLIT))


def staged_tables(spark: SparkSession, sf: str, wh: Warehouse) -> dict[str, str]:
    """Write the five staging tables; return their names."""
    return staging.write_staging(wh, silver(spark, sf), category_csv(spark, wh), currency_rates(spark))


def gold_loaded(spark: SparkSession, sf: str, tag: str, runs: int = 1) -> Warehouse:
    wh = Warehouse.fresh(spark, tag)
    names = staged_tables(spark, sf, wh)
    for _ in range(runs):
        gold.load_gold(wh, names)
    return wh


def text_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze as it arrives from a text export: every column a string.

    Fixed rules plant malformed values: amounts of unknown-category rows use a
    decimal comma, and booking times of grocery rows use a local day format.
    """
    b = bronze_transactions(spark, sf)
    amount = F.col("bookg_amt").cast("string")
    cet = F.col("bookg_dt_tm_cet")
    return b.select(
        F.col("booking_id").cast("string").alias("booking_id"),
        "acct_ccy",
        F.when(F.col("dtld_tx_tp") == 9999, F.regexp_replace(amount, r"\.", ",")).otherwise(amount)
         .alias("bookg_amt"),
        F.col("bookg_amt_nmrc").cast("string").alias("bookg_amt_nmrc"),
        F.when(F.col("dtld_tx_tp") == 5411, F.date_format(cet, "dd.MM.yyyy HH:mm")).otherwise(cet.cast("string"))
         .alias("bookg_dt_tm_cet"),
        F.col("bookg_dt_tm_gmt").cast("string").alias("bookg_dt_tm_gmt"),
        F.col("dtld_tx_tp").cast("string").alias("dtld_tx_tp"),
        "ctpty_nm", "ctpty_ctry", "ctpty_adr_line1",
    )


# --- sources ----------------------------------------------------------------

def scan_parquet(spark, sf):
    """Land bronze as one named parquet file, read it by name."""
    wh = Warehouse.fresh(spark, "scan-parquet")
    path = f"{wh.root}/bronze/transactions_bronze.parquet"
    overwrite_parquet(bronze(spark, sf), path)
    return files.read_parquet(spark, path)


def scan_parquet_glob(spark, sf):
    """S2 + W1: silver parquet folder, read back through ``*.parquet``."""
    wh = Warehouse.fresh(spark, "scan-glob")
    folder = f"{wh.root}/silver/staging_parquet"
    overwrite_parquet(silver(spark, sf), folder)
    return files.read_parquet(spark, f"{folder}/*.parquet")


def landed_files(spark: SparkSession, sf: str, folder: str) -> str:
    """Bronze landed as three files of differing schemas; returns the glob.

    The second has INT ids, a FLOAT weight, a channel and no counterparty; the third has amounts as text and no weight.
    """
    b = bronze(spark, sf).select("booking_id", "acct_ccy", "bookg_amt", F.col("bookg_amt").alias("weight"), "dtld_tx_tp", "ctpty_nm")
    third = F.pmod("booking_id", F.lit(3))
    one = b.filter(third == 0)
    two = b.filter(third == 1).select(F.col("booking_id").cast("int").alias("booking_id"), "acct_ccy", "bookg_amt",
                                      F.col("weight").cast("float").alias("weight"), "dtld_tx_tp", F.lit("web").alias("channel"))
    three = b.filter(third == 2).select("booking_id", "acct_ccy", F.col("bookg_amt").cast("string").alias("bookg_amt"), "dtld_tx_tp", "ctpty_nm")
    for day, rows in enumerate((one, two, three)):
        overwrite_parquet(rows, f"{folder}/day{day}")
    return f"{folder}/day*"


def scan_glob_differing_schemas(spark, sf):
    """Files of differing schemas read as one table: widened, filled with NULL, conflicts as text and parsed at the boundary."""
    wh = Warehouse.fresh(spark, "scan-differing")
    return conform(read_reconciled(spark, landed_files(spark, sf, f"{wh.root}/bronze")).rows, schemas.BRONZE_TYPES)


def scan_csv_roundtrip(spark, sf):
    """S3: category names with comma, quote and line break, through CSV and back."""
    wh = Warehouse.fresh(spark, "scan-csv")
    rows = analytics.with_categories(staged(spark, sf), category_csv(spark, wh))
    path = f"{wh.root}/export/transactions_csv"
    rows.write.mode("overwrite").options(**files.CSV_OPTIONS).csv(path)
    schema = rows.schema
    return files.read_csv(spark, path, schema)


def scan_catalog_table(spark, sf):
    """S5 + S6 + W2: external catalog table written, then read by name and by SQL."""
    wh = Warehouse.fresh(spark, "scan-table")
    wh.ensure_database("silver")
    name = wh.table("silver", "sta_transactions")
    overwrite_table(staged(spark, sf), name, wh.location("silver", "sta_transactions"))
    return spark.sql(f"SELECT * FROM {name}")


def scan_temp_view(spark, sf):
    """A named view over a query, read from SQL."""
    view = f"silver_temp_{uuid.uuid4().hex[:8]}"
    staged(spark, sf).createOrReplaceTempView(view)
    return spark.sql(f"SELECT currency, amount_euro, payment_date, category_code FROM {view}")


def report_json_roundtrip(spark, sf):
    """S8 + W6: the validation report stored as JSON and loaded again."""
    wh = Warehouse.fresh(spark, "report-json")
    path = Q.report_path_for("transactions_bronze.parquet", f"{wh.root}/reports")
    return validate(bronze(spark, sf), Q.DEFAULT_SUITE, path).report


# --- sinks ------------------------------------------------------------------

def sink_parquet_overwrite(spark, sf):
    """Overwriting twice leaves one copy."""
    wh = Warehouse.fresh(spark, "sink-parquet")
    path = f"{wh.root}/silver/staging_parquet"
    overwrite_parquet(silver(spark, sf), path)
    overwrite_parquet(silver(spark, sf), path)
    return spark.read.parquet(path)


def sink_table_overwrite(spark, sf):
    """The staging tables, written twice; the counterparty table read back."""
    wh = Warehouse.fresh(spark, "sink-table")
    staged_tables(spark, sf, wh)
    names = staged_tables(spark, sf, wh)
    return spark.table(names["sta_counter_party_dim"])


def create_if_absent_twice(spark, sf):
    """Creating an existing table is a no-op; data appended in between survives."""
    wh = Warehouse.fresh(spark, "create-twice")
    wh.ensure_database("gold")
    name = wh.table("gold", "calendar_dim")
    create_table_if_absent(spark, name, schemas.CALENDAR_DIM, wh.location("gold", "calendar_dim"))
    cal = staging.calendar_source(staged(spark, sf))
    build_dim(cal, name, ["payment_date"], "date_id")
    create_table_if_absent(spark, name, schemas.CALENDAR_DIM, wh.location("gold", "calendar_dim"))
    return spark.table(name)


def fact_append_twice(spark, sf):
    """W5 + W7: a second run appends every fact row again (not idempotent)."""
    wh = gold_loaded(spark, sf, "fact-twice", runs=2)
    return spark.table(wh.table("gold", "transactions"))


def exists_then_create_or_merge(spark, sf):
    """S9 + W8: first call creates the dimension, the second merges into it."""
    wh = Warehouse.fresh(spark, "create-or-merge")
    dim = gold.DIMENSIONS[1]  # calendar
    tx = staged(spark, sf)
    gold.create_or_merge(wh, dim, staging.calendar_source(first_batch(tx)))
    gold.create_or_merge(wh, dim, staging.calendar_source(tx))
    return spark.table(wh.table("gold", dim.table))


# --- projections, functions -------------------------------------------------

def staging_transactions(spark, sf):
    return staged(spark, sf)


def reorder_columns_query(spark, sf):
    """Columns named by their position after the reordering, so another order is another result."""
    moved = reorder_columns(staged(spark, sf), ["counterparty_add", "amount_euro"])
    return moved.toDF(*[f"column_{i}" for i in range(len(moved.columns))])


def typed_null_columns(spark, sf):
    return blank_columns(bronze(spark, sf), ["ctpty_adr_line2", "rmt_inf_ustrd2", "tx_tp"])


def payment_day(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    text = format_day("ts")
    return ev.select("event_id", to_day("ts").alias("payment_day"), text.alias("day_text"),
                     parse_day(text).alias("day_parsed"))


def calendar_dim(spark, sf):
    """O1: the ordered calendar stored and read back with each row's rank in the files."""
    wh = Warehouse.fresh(spark, "calendar")
    overwrite_parquet(staging.calendar_source(staged(spark, sf)), f"{wh.root}/calendar")
    return files.with_stored_rank(spark.read.parquet(f"{wh.root}/calendar"), "stored_rank")


def counterparty_distinct(spark, sf):
    return staging.counterparty_source(staged(spark, sf))


def counterparty_one_per_key(spark, sf):
    return dedupe_by_key(staging.counterparty_source(staged(spark, sf)), ["counterparty_add"])


# --- ids ----------------------------------------------------------------------

def max_id_default_zero(spark, sf):
    """A1: max id of a loaded dimension, from its footers, and 0 for an empty one."""
    wh = Warehouse.fresh(spark, "max-id")
    gold.ensure_gold(wh)
    dim = gold.DIMENSIONS[3]
    gold.load_dimension(wh, dim, staging.counterparty_source(staged(spark, sf)))
    loaded = stored_max_id(spark, wh.table("gold", dim.table), dim.id_col)
    empty = stored_max_id(spark, wh.table("gold", "transactions"), "currency_id")
    return (loaded.select(F.lit(dim.table).alias("table_name"), "max_id")
            .unionByName(empty.select(F.lit("transactions").alias("table_name"), "max_id")))


def dense_ids_bucketed(spark, sf):
    """K1: dense ids above a base, over many range partitions."""
    keys = silver(spark, sf).select("booking_id").distinct()
    return dense_ids(keys, ["booking_id"], "payment_id", base=1000, id_type="bigint",
                     rows_per_partition=DENSE_ROWS_PER_PARTITION)


def dense_ids_from_one(spark, sf):
    """K2: first load, ids from 1, NULL key first."""
    keys = dedupe_by_key(staging.counterparty_source(staged(spark, sf)), ["counterparty_add"])
    return dense_ids(keys, ["counterparty_add"], "counterparty_id")


def row_number_renumber(spark, sf):
    """K3: renumber every member 1..n in key order (distributed)."""
    days = staging.calendar_days(staged(spark, sf))  # dense_ids orders by key itself
    return dense_ids(days, ["payment_date"], "date_id", rows_per_partition=500)


def union_dedupe_by_key_query(spark, sf):
    """U1 + U2: existing members win, union by name, renumbered."""
    tx = staged(spark, sf)
    existing = dense_ids(dedupe_by_key(staging.counterparty_source(first_batch(tx)), ["counterparty_add"]),
                         ["counterparty_add"], "counterparty_id")
    incoming = staging.counterparty_source(tx)
    return union_dedupe_by_key(existing, incoming, ["counterparty_add"], "counterparty_id")


# --- merges and dimensions ----------------------------------------------------

def _empty_dim(spark, wh: Warehouse, dim: gold.Dimension) -> str:
    gold.ensure_gold(wh)
    return wh.table("gold", dim.table)


def insert_only_merge_query(spark, sf):
    """W4 + J2: two loads of the calendar, SQL equality, new days only."""
    wh = Warehouse.fresh(spark, "merge")
    dim = gold.DIMENSIONS[1]
    name = _empty_dim(spark, wh, dim)
    tx = staged(spark, sf)
    insert_only_merge(staging.calendar_source(first_batch(tx)), name, ["payment_date"], "date_id")
    insert_only_merge(staging.calendar_source(tx), name, ["payment_date"], "date_id")
    return spark.table(name)


def insert_only_merge_null_keys(spark, sf):
    """H5: with SQL equality a NULL business key is inserted again on each run."""
    wh = Warehouse.fresh(spark, "merge-null")
    dim = gold.DIMENSIONS[3]
    name = _empty_dim(spark, wh, dim)
    tx = staged(spark, sf)
    for batch in (first_batch(tx), tx):
        src = dedupe_by_key(staging.counterparty_source(batch), ["counterparty_add"])
        insert_only_merge(src, name, ["counterparty_add"], "counterparty_id")
    return spark.table(name)


def insert_only_merge_dup_keys(spark, sf):
    """H4: the primitive inserts every source row of a new key (no dedupe)."""
    wh = Warehouse.fresh(spark, "merge-dup")
    dim = gold.DIMENSIONS[3]
    name = _empty_dim(spark, wh, dim)
    insert_only_merge(staging.counterparty_source(staged(spark, sf)), name, ["counterparty_add"],
                      "counterparty_id", null_safe=True)
    return spark.table(name)


def dim_calendar(spark, sf):
    wh = Warehouse.fresh(spark, "dim-calendar")
    dim = gold.DIMENSIONS[1]
    _empty_dim(spark, wh, dim)
    tx = staged(spark, sf)
    for batch in (first_batch(tx), tx):
        gold.load_dimension(wh, dim, staging.calendar_source(batch))
    return spark.table(wh.table("gold", dim.table))


def dim_counterparty(spark, sf):
    wh = Warehouse.fresh(spark, "dim-counterparty")
    dim = gold.DIMENSIONS[3]
    _empty_dim(spark, wh, dim)
    tx = staged(spark, sf)
    for batch in (first_batch(tx), tx):
        gold.load_dimension(wh, dim, staging.counterparty_source(batch))
    return spark.table(wh.table("gold", dim.table))


# --- star schema --------------------------------------------------------------

def fact_lookup(spark, sf):
    """J1 + W5: full gold load, the fact table read back."""
    wh = gold_loaded(spark, sf, "fact-lookup")
    return spark.table(wh.table("gold", "transactions"))


def fact_lookup_using_names(spark, sf):
    """J3 + P5: key resolution through joins on column names, not written."""
    wh = gold_loaded(spark, sf, "fact-names")
    dims = {d.table: spark.table(wh.table("gold", d.table)) for d in gold.DIMENSIONS}
    return gold.resolve_fact_keys(staged(spark, sf), dims)


def star_emission_by_category_country(spark, sf):
    """X1 + X2 + X4 over the gold star schema instead of staging."""
    wh = gold_loaded(spark, sf, "star")
    t = {name: spark.table(wh.table("gold", name)) for name in gold.GOLD_TABLES}
    return analytics.star_emissions(t["transactions"], t["currency_dim"], t["category_dim"],
                                    t["counter_party_dim"])


def gold_audit(spark, sf):
    return gold.gold_audit(gold_loaded(spark, sf, "audit"))


def rebuild_rekeys_facts(spark, sf):
    """A dimension renumbered under stored facts; their ids resolve to the same addresses as before."""
    wh = Warehouse.fresh(spark, "rebuild")
    early = silver(spark, sf).filter(F.col("bookg_dt_tm_cet") < F.lit(BATCH_SPLIT))
    gold.load_gold(wh, staging.write_staging(wh, early, category_csv(spark, wh), currency_rates(spark)))
    dim = gold.DIMENSIONS[3]
    gold.rebuild_dimension(wh, dim, staging.counterparty_source(staged(spark, sf)))
    members = spark.table(wh.table("gold", dim.table)).select("counterparty_id", "counterparty_add")
    facts = spark.table(wh.table("gold", "transactions")).select("amount_euro", "counterparty_id")
    return lookup_join(facts, members, "counterparty_id")


# --- validation ---------------------------------------------------------------

def _single_rule(rule: Q.Rule) -> Query:
    def run(spark, sf):
        return Q.evaluate_suite(bronze(spark, sf), [rule])
    run.__doc__ = f"Report of the single rule {rule.name}."
    return run


def text_bronze_report(spark, sf):
    """Text-typed bronze validated; values that do not parse are counted."""
    return validate(text_bronze(spark, sf)).report


def text_bronze_clean(spark, sf):
    """Text-typed bronze to typed silver; unparseable rows stay out."""
    from ledgerstar.plans.medallion import bronze_to_silver

    wh = Warehouse.fresh(spark, "text-bronze")
    return bronze_to_silver(text_bronze(spark, sf), f"{wh.root}/silver/staging_parquet")


def typed_bronze(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """Bronze whose amounts come in another numeric type, with values planted that the expected type cannot hold.

    float: amounts as FLOAT (all of them fit a DOUBLE), cents as DOUBLE with half a cent in grocery rows.
    decimal: amounts as DECIMAL(38,18) with a digit in the last place where the category is unknown.
    bigint: amounts as BIGINT around 2^53: odd ones above it in unknown categories, multiples of 4 in groceries.
    """
    b = bronze(spark, sf)
    unknown, grocery = F.col("dtld_tx_tp") == 9999, F.col("dtld_tx_tp") == 5411
    amount, cents = F.col("bookg_amt"), F.col("bookg_amt_nmrc")
    above = F.lit(2**53)
    changes = {
        "float": {"bookg_amt": amount.cast("float"),
                  "bookg_amt_nmrc": F.when(grocery, cents.cast("double") + 0.5).otherwise(cents.cast("double"))},
        "decimal": {"bookg_amt": F.when(unknown, amount.cast("decimal(30,18)") + F.lit("0.000000000000000001").cast("decimal(30,18)"))
                                  .otherwise(amount.cast("decimal(38,18)")).cast("decimal(38,18)")},
        "bigint": {"bookg_amt": F.when(unknown, above + 2 * F.col("booking_id") + 1)
                                 .when(grocery, above + 4 * F.col("booking_id")).otherwise(cents)},
    }
    return b.withColumns(changes[kind])


def _each_typed(one: Callable[[DataFrame, str], DataFrame], spark: SparkSession, sf: str) -> DataFrame:
    frames = [one(typed_bronze(spark, sf, k), k).withColumn("kind", F.lit(k)) for k in ("float", "decimal", "bigint")]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def typed_bronze_report(spark, sf):
    """FLOAT, DECIMAL and BIGINT amounts validated; only values that the cast changes are findings."""
    return _each_typed(lambda b, _: validate(b).report, spark, sf)


def typed_bronze_clean(spark, sf):
    """Silver of the same inputs; only changed values stay out."""
    from ledgerstar.plans.medallion import bronze_to_silver

    wh = Warehouse.fresh(spark, "typed-bronze")
    return _each_typed(lambda b, k: bronze_to_silver(b, f"{wh.root}/silver/{k}").select("booking_id", "bookg_amt", "bookg_amt_nmrc"), spark, sf)


def _silver_pass(spark, sf, tag: str):
    """The silver step over bronze with its report stored by the writing pass: (silver folder, report path)."""
    from ledgerstar.plans.medallion import bronze_to_silver

    wh = Warehouse.fresh(spark, tag)
    path = Q.report_path_for("transactions_bronze.parquet", f"{wh.root}/reports")
    bronze_to_silver(bronze(spark, sf), f"{wh.root}/silver/staging_parquet", report_path=path)
    return f"{wh.root}/silver/staging_parquet", path


def silver_pass_report(spark, sf):
    """V7, V8: the report that the silver write counts on its way, stored and read back with every percentage."""
    from ledgerstar.plans.medallion import read_report_detail

    return read_report_detail(spark, _silver_pass(spark, sf, "pass-report")[1])


def silver_pass_statistics(spark, sf):
    """The statistics block of the same report."""
    from ledgerstar.plans.medallion import read_statistics

    return read_statistics(spark, _silver_pass(spark, sf, "pass-statistics")[1])


def silver_and_quarantine(spark, sf):
    """Clean and quarantined rows, written by one job, read back from both sides."""
    from ledgerstar.plans.medallion import read_quarantine, read_silver

    folder, _ = _silver_pass(spark, sf, "both-sides")
    clean = read_silver(spark, folder).withColumns({"side": F.lit("clean"), "failed_rules": F.lit(None).cast("string")})
    bad = read_quarantine(spark, folder).withColumn("side", F.lit("quarantine"))
    columns = ["side", "booking_id", "acct_ccy", "bookg_amt", "bookg_dt_tm_cet", "ctpty_adr_line1", "ctpty_adr_line2", "failed_rules"]
    return clean.select(columns).unionByName(bad.select(columns))


def silver_from_report(spark, sf):
    """Silver as a stored report decides; this input fails, so its rows are cleaned."""
    from ledgerstar.plans.medallion import bronze_to_silver

    wh = Warehouse.fresh(spark, "from-report")
    path = Q.report_path_for("transactions_bronze.parquet", f"{wh.root}/reports")
    validate(bronze(spark, sf), Q.DEFAULT_SUITE, path)
    return bronze_to_silver(bronze(spark, sf), f"{wh.root}/silver/staging_parquet", result_path=path)


def silver_passing_unchanged(spark, sf):
    """An input that passes every rule is copied with its free-text columns."""
    from ledgerstar.plans.medallion import bronze_to_silver

    wh = Warehouse.fresh(spark, "passing")
    noted = bronze(spark, sf).withColumns({
        "rmt_inf_ustrd2": F.concat(F.lit("ref "), F.col("booking_id").cast("string")),
        "tx_tp": F.lit("purchase"), "ctpty_adr_line2": F.col("ctpty_adr_line1")})
    good, _ = Q.split_rows(noted, Q.DEFAULT_SUITE)
    copied = bronze_to_silver(good, f"{wh.root}/silver/staging_parquet")
    return copied.select("booking_id", "acct_ccy", "bookg_amt", "bookg_amt_nmrc", "ctpty_nm",
                         "rmt_inf_ustrd2", "tx_tp", "ctpty_adr_line2")


def money_extremes(spark, sf):
    """rates below 1e-6, amounts above 1e14 and sums of values finer than the rounding places."""
    from ledgerstar.functions.exact import exact_sums
    from ledgerstar.functions.money import rounded_product, shown

    rows = spark.read.parquet(f"{sf}/lineitem.parquet")
    sums = exact_sums(rows, ["l_returnflag"], {"fine": F.col("l_quantity") * 0.0004}).select("l_returnflag", shown("fine").alias("fine_sum"))
    return rows.join(sums, "l_returnflag").select(
        "l_orderkey", "l_linenumber",
        rounded_product(F.col("l_extendedprice") * 1e10, F.col("l_linenumber") * 3.7e-8, 3).alias("large_times_small"),
        rounded_product(F.col("l_quantity") * 1e5, F.lit(4e-7), 3).alias("small_rate"),
        "fine_sum",
    )


def exact_sum_cancelling(spark, sf):
    """A5: amounts of up to 1e17 that cancel out, among eighths: the sum is exact whatever the order of rows."""
    from ledgerstar.functions.exact import exact_sums

    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_returnflag", "l_orderkey", "l_quantity")
    big = F.col("l_orderkey") * 1e12 + 1e16
    values = F.array(F.col("l_quantity") / 8, big, -big)
    added = exact_sums(rows.select("l_returnflag", F.explode(values).alias("value")), ["l_returnflag"], {"total": "value"})
    return added.select("l_returnflag", "total", F.col("total__n").alias("n_values"))


def suite_report(spark, sf):
    return Q.evaluate_suite(bronze(spark, sf), Q.DEFAULT_SUITE)


def suite_success(spark, sf):
    return Q.suite_summary(Q.evaluate_suite(bronze(spark, sf), Q.DEFAULT_SUITE))


def clean_rows(spark, sf):
    return silver(spark, sf)


def quarantine_rows(spark, sf):
    return Q.split_rows(bronze(spark, sf), Q.DEFAULT_SUITE)[1]


def unexpected_values(spark, sf):
    rules = [Q.AMOUNT_NOT_NEGATIVE, Q.CENTS_NOT_NEGATIVE, Q.CURRENCY_KNOWN, Q.CATEGORY_KNOWN]
    return Q.unexpected_values(bronze(spark, sf), rules)


# --- analytics ----------------------------------------------------------------

def _euro(spark, sf):
    return analytics.to_euro(staged(spark, sf), currency_rates(spark))


def to_euro(spark, sf):
    return _euro(spark, sf)


def emission_per_row(spark, sf):
    rows = analytics.with_emission(analytics.with_categories(_euro(spark, sf), sample_category_map(spark)))
    return rows


def _report(spark, sf):
    return analytics.emission_report(_euro(spark, sf), sample_category_map(spark), COUNTRY)


def emission_report(spark, sf):
    return _report(spark, sf)


def emission_mean_by_category(spark, sf):
    return analytics.mean_emission_by_category(_report(spark, sf))


def emission_points(spark, sf):
    return analytics.emission_points(_report(spark, sf))


def stream_bronze_to_silver(spark, sf):
    """Landed bronze files -> validated, cleaned silver through a file stream."""
    from ledgerstar.streaming.ingest import ingest_bronze, read_silver

    wh = Warehouse.fresh(spark, "stream")
    landing = f"{wh.root}/bronze"
    # Land the bronze rows as several files, more of them as the table grows; the stream takes a third per micro-batch.
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()  # from the footers
    per_load = max(1, -(-lines // (LOADS * LANDED_ROWS_PER_FILE)))
    bronze(spark, sf).repartition(LOADS * per_load, "booking_id").write.parquet(landing)
    query = ingest_bronze(spark, landing, f"{wh.root}/silver", f"{wh.root}/reports",
                          f"{wh.root}/_stream_checkpoint", max_files_per_trigger=per_load)
    query.awaitTermination()
    return read_silver(spark, f"{wh.root}/silver")


def first_n_ordered(spark, sf):
    """O2: a preview is the first rows in a stated (unique) order."""
    return staging.calendar_source(staged(spark, sf)).orderBy("payment_date").limit(PREVIEW_ROWS)


def counterparty_lookup_salted(spark, sf):
    """The fact-to-dimension lookup forced onto its salted (non-broadcast) path."""
    wh = Warehouse.fresh(spark, "salted")
    cp = dedupe_by_key(staging.counterparty_source(staged(spark, sf)), ["counterparty_add"])
    dim = dense_ids(cp, ["counterparty_add"], "counterparty_id")
    overwrite_table(dim, f"{wh.ensure_database('gold')}.cp", wh.location("gold", "cp"))
    return lookup_join(staged(spark, sf).select("amount_euro", "counterparty_add"),
                       spark.table(f"{wh.database('gold')}.cp").select("counterparty_add", "counterparty_id"),
                       "counterparty_add", "left", max_broadcast_rows=0, salt_buckets=8)


def counterparty_lookup_skewed(spark, sf):
    """A third of the facts at one address and NULL addresses; heavy keys are measured and only they are salted."""
    wh = Warehouse.fresh(spark, "skewed")
    cp = dedupe_by_key(staging.counterparty_source(staged(spark, sf)), ["counterparty_add"])
    db = wh.ensure_database("gold")
    overwrite_table(dense_ids(cp, ["counterparty_add"], "counterparty_id"), f"{db}.cp", wh.location("gold", "cp"))
    hot = F.when(F.pmod(F.dayofmonth("payment_date"), F.lit(3)) == 0, F.lit("ADDR 2")).otherwise(F.col("counterparty_add"))
    facts = staged(spark, sf).select("amount_euro", hot.alias("counterparty_add"))
    overwrite_table(facts, f"{db}.facts", wh.location("gold", "facts"))
    return lookup_join(spark.table(f"{db}.facts"), spark.table(f"{db}.cp").select("counterparty_add", "counterparty_id"),
                       "counterparty_add", "left", max_broadcast_rows=0)


QUERIES: dict[str, Query] = {
    "silver_from_report": silver_from_report,
    "silver_passing_unchanged": silver_passing_unchanged,
    "money_extremes": money_extremes,
    "exact_sum_cancelling": exact_sum_cancelling,
    "scan_parquet": scan_parquet,
    "scan_parquet_glob": scan_parquet_glob,
    "scan_glob_differing_schemas": scan_glob_differing_schemas,
    "scan_csv_roundtrip": scan_csv_roundtrip,
    "scan_catalog_table": scan_catalog_table,
    "scan_temp_view": scan_temp_view,
    "report_json_roundtrip": report_json_roundtrip,
    "sink_parquet_overwrite": sink_parquet_overwrite,
    "sink_table_overwrite": sink_table_overwrite,
    "create_if_absent_twice": create_if_absent_twice,
    "exists_then_create_or_merge": exists_then_create_or_merge,
    "staging_transactions": staging_transactions,
    "reorder_columns": reorder_columns_query,
    "typed_null_columns": typed_null_columns,
    "payment_day": payment_day,
    "calendar_dim": calendar_dim,
    "counterparty_distinct": counterparty_distinct,
    "counterparty_one_per_key": counterparty_one_per_key,
    "max_id_default_zero": max_id_default_zero,
    "dense_ids_bucketed": dense_ids_bucketed,
    "dense_ids_from_one": dense_ids_from_one,
    "row_number_renumber": row_number_renumber,
    "union_dedupe_by_key": union_dedupe_by_key_query,
    "insert_only_merge": insert_only_merge_query,
    "insert_only_merge_null_keys": insert_only_merge_null_keys,
    "insert_only_merge_dup_keys": insert_only_merge_dup_keys,
    "dim_calendar": dim_calendar,
    "dim_counterparty": dim_counterparty,
    "fact_lookup": fact_lookup,
    "fact_lookup_using_names": fact_lookup_using_names,
    "fact_append_twice": fact_append_twice,
    "counterparty_lookup_salted": counterparty_lookup_salted,
    "counterparty_lookup_skewed": counterparty_lookup_skewed,
    "gold_audit": gold_audit,
    "rebuild_rekeys_facts": rebuild_rekeys_facts,
    "star_emission_by_category_country": star_emission_by_category_country,
    "check_between_amount": _single_rule(Q.AMOUNT_NOT_NEGATIVE),
    "check_between_cents": _single_rule(Q.CENTS_NOT_NEGATIVE),
    "check_in_set_currency": _single_rule(Q.CURRENCY_KNOWN),
    "check_not_null_gmt": _single_rule(Q.GMT_PRESENT),
    "check_not_null_cet": _single_rule(Q.CET_PRESENT),
    "check_in_set_category": _single_rule(Q.CATEGORY_KNOWN),
    "text_bronze_report": text_bronze_report,
    "text_bronze_clean": text_bronze_clean,
    "typed_bronze_report": typed_bronze_report,
    "typed_bronze_clean": typed_bronze_clean,
    "silver_pass_report": silver_pass_report,
    "silver_pass_statistics": silver_pass_statistics,
    "silver_and_quarantine": silver_and_quarantine,
    "suite_report": suite_report,
    "suite_success": suite_success,
    "clean_rows": clean_rows,
    "quarantine_rows": quarantine_rows,
    "unexpected_values": unexpected_values,
    "to_euro": to_euro,
    "emission_per_row": emission_per_row,
    "emission_report": emission_report,
    "emission_mean_by_category": emission_mean_by_category,
    "emission_points": emission_points,
    "first_n_ordered": first_n_ordered,
    "stream_bronze_to_silver": stream_bronze_to_silver,
}
