"""Schemas of the bronze, staging, gold and report tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns of the raw (bronze) file that the engine uses, with the types the
# bronze boundary casts them to (with try_cast; see functions.columns.conform).
BRONZE_TYPES: dict[str, T.DataType] = {
    "booking_id": T.LongType(),
    "acct_ccy": T.StringType(),
    "bookg_amt": T.DoubleType(),
    "bookg_amt_nmrc": T.LongType(),
    "bookg_dt_tm_cet": T.TimestampNTZType(),
    "bookg_dt_tm_gmt": T.TimestampNTZType(),
    "dtld_tx_tp": T.IntegerType(),
    "ctpty_nm": T.StringType(),
    "ctpty_ctry": T.StringType(),
    "ctpty_adr_line1": T.StringType(),
}

CATEGORY_MAP = T.StructType([
    T.StructField("category_code", T.IntegerType()),
    T.StructField("category_name", T.StringType()),
    T.StructField("co2_multiplier", T.DoubleType()),
])

CURRENCY_RATES = T.StructType([
    T.StructField("currency", T.StringType()),
    T.StructField("conversion_rate", T.DoubleType()),
])

STA_TRANSACTIONS = T.StructType([
    T.StructField("currency", T.StringType()),
    T.StructField("amount_euro", T.DoubleType()),
    T.StructField("payment_date", T.DateType()),
    T.StructField("counterparty_country", T.StringType()),
    T.StructField("counterparty_name", T.StringType()),
    T.StructField("category_code", T.IntegerType()),
    T.StructField("counterparty_add", T.StringType()),
])

STA_CALENDAR = T.StructType([
    T.StructField("payment_date", T.DateType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
])

STA_COUNTERPARTY = T.StructType([
    T.StructField("counterparty_add", T.StringType()),
    T.StructField("counterparty_country", T.StringType()),
    T.StructField("counterparty_name", T.StringType()),
])

# Gold star schema, in table column order.
CURRENCY_DIM = T.StructType(CURRENCY_RATES.fields + [T.StructField("currency_id", T.IntegerType())])
CALENDAR_DIM = T.StructType(STA_CALENDAR.fields + [T.StructField("date_id", T.IntegerType())])
CATEGORY_DIM = T.StructType(CATEGORY_MAP.fields + [T.StructField("category_id", T.IntegerType())])
COUNTER_PARTY_DIM = T.StructType(STA_COUNTERPARTY.fields + [T.StructField("counterparty_id", T.IntegerType())])
TRANSACTIONS_FACT = T.StructType([
    T.StructField("currency_id", T.IntegerType()),
    T.StructField("date_id", T.IntegerType()),
    T.StructField("counterparty_id", T.IntegerType()),
    T.StructField("category_id", T.IntegerType()),
    T.StructField("amount_euro", T.DoubleType()),
])

VALIDATION_REPORT = T.StructType([
    T.StructField("rule", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("element_count", T.LongType()),
    T.StructField("missing_count", T.LongType()),
    T.StructField("unexpected_count", T.LongType()),
    T.StructField("unexpected_percent", T.DoubleType()),
    T.StructField("success", T.BooleanType()),
])

VALIDATION_DETAIL = T.StructType(VALIDATION_REPORT.fields + [
    T.StructField(n, T.DoubleType())
    for n in ("missing_percent", "unexpected_percent_total", "unexpected_percent_nonmissing")])

VALIDATION_STATISTICS = T.StructType([
    T.StructField("evaluated_expectations", T.LongType()),
    T.StructField("successful_expectations", T.LongType()),
    T.StructField("unsuccessful_expectations", T.LongType()),
    T.StructField("success_percent", T.DoubleType()),
])


def ddl(schema: T.StructType) -> str:
    """Column list for CREATE TABLE, e.g. ``currency STRING, rate DOUBLE``."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)
