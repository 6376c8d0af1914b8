"""Silver to staging: the transaction table and the four dimension sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar import schemas
from ledgerstar.constants import RAW_DROP_COLUMNS, RAW_RENAMES
from ledgerstar.functions.columns import reorder_columns, require_columns
from ledgerstar.functions.dates import calendar_parts, to_day
from ledgerstar.session import run_concurrently
from ledgerstar.sinks import Warehouse, overwrite_table
from ledgerstar.sources.files import read_csv

# Renames that can apply: their source column is not in the drop list.
LIVE_RENAMES = tuple((src, dst) for src, dst in RAW_RENAMES if src not in RAW_DROP_COLUMNS)

STAGING_TABLES = ("sta_transactions", "sta_calendar_dim", "sta_counter_party_dim",
                  "sta_category_dim", "sta_currency_dim")


def stage_transactions(silver: DataFrame) -> DataFrame:
    """Drop raw columns, rename the rest, truncate the payment time to a day.

    One projection. The renamed source columns must exist (a missing one is
    an error, not a silent no-op); raw columns outside both lists are kept.
    """
    require_columns(silver, [src for src, _ in LIVE_RENAMES])
    renames = dict(LIVE_RENAMES)
    cols = []
    for name in silver.columns:
        if name in RAW_DROP_COLUMNS:
            continue
        new = renames.get(name, name)
        expr = F.col(name)
        if new == "payment_date":
            expr = to_day(expr)
        elif new == "category_code":
            expr = expr.cast("int")
        cols.append(expr.alias(new))
    return reorder_columns(silver.select(*cols), schemas.STA_TRANSACTIONS.fieldNames())


def calendar_days(transactions: DataFrame) -> DataFrame:
    """Distinct payment days with year, month and day (no order).

    Distinct on the day first (one column through the shuffle, partial
    aggregation collapses a busy day per task), then derive the parts.
    """
    days = transactions.select("payment_date").distinct()
    return days.select("payment_date", *calendar_parts("payment_date"))


def calendar_source(transactions: DataFrame) -> DataFrame:
    """The calendar staging rows, ordered by day as they are stored."""
    return calendar_days(transactions).orderBy("payment_date")


def counterparty_source(transactions: DataFrame) -> DataFrame:
    """Distinct (address, country, name) triples."""
    return transactions.select(*schemas.STA_COUNTERPARTY.fieldNames()).distinct()


def read_category_map(spark: SparkSession, path: str) -> DataFrame:
    """Category map CSV (header, quoted, multi-line fields), explicit schema."""
    return read_csv(spark, path, schemas.CATEGORY_MAP)


def write_staging(wh: Warehouse, silver: DataFrame, categories: DataFrame,
                  rates: DataFrame) -> dict[str, str]:
    """Overwrite the five staging tables; return their names.

    The transaction table is written first; the calendar and counterparty
    sources are then derived from the written table (column-pruned reads),
    not by re-running the cleaning plan.
    """
    wh.ensure_database("silver")
    names = {t: wh.table("silver", t) for t in STAGING_TABLES}

    def put(df: DataFrame, table: str) -> None:
        overwrite_table(df, names[table], wh.location("silver", table))

    put(stage_transactions(silver), "sta_transactions")
    staged = wh.spark.table(names["sta_transactions"])
    # The four remaining tables are independent small jobs: run them side by side.
    run_concurrently({
        "sta_calendar_dim": lambda: put(calendar_source(staged), "sta_calendar_dim"),
        "sta_counter_party_dim": lambda: put(counterparty_source(staged), "sta_counter_party_dim"),
        "sta_category_dim": lambda: put(categories, "sta_category_dim"),
        "sta_currency_dim": lambda: put(rates, "sta_currency_dim"),
    })
    return names
