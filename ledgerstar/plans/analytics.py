"""Spend and carbon analytics over staged transactions.

* ``to_euro``: convert non-euro amounts with the rates table.
* ``with_emission``: grams of CO2 = amount in euro x category multiplier.
* ``emission_report``: one country, one category excluded, five columns.
* ``mean_emission_by_category`` and ``emission_points``: the data behind the
  bar chart (mean per category) and the scatter plot.
* ``star_emissions``: the same arithmetic read from the gold star schema,
  per category and country.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstar.constants import EXCLUDED_CATEGORY_NAME
from ledgerstar.functions.exact import exact_sums
from ledgerstar.functions.money import rounded_product, shown, shown_mean
from ledgerstar.operators.joins import lookup_join

EURO = "EUR"


def to_euro(transactions: DataFrame, rates: DataFrame) -> DataFrame:
    """Amounts in a currency other than EUR become ``round(amount * rate, 3)``
    and their currency EUR. A NULL currency is left unchanged; an unknown
    currency has no rate, so its amount becomes NULL.
    """
    joined = lookup_join(transactions, rates.select("currency", "conversion_rate"), "currency", "left")
    foreign = F.col("currency") != F.lit(EURO)
    converted = {
        "amount_euro": F.when(foreign, rounded_product("amount_euro", "conversion_rate", 3))
                        .otherwise(F.col("amount_euro")),
        "currency": F.when(foreign, F.lit(EURO)).otherwise(F.col("currency")),
    }
    if "amount_cent" in transactions.columns:
        converted["amount_cent"] = F.when(foreign, rounded_product("amount_cent", "conversion_rate", 3)) \
                                    .otherwise(F.col("amount_cent"))
    return joined.withColumns(converted).select(*transactions.columns)


def with_categories(transactions: DataFrame, categories: DataFrame) -> DataFrame:
    """Left lookup of category name and multiplier by code."""
    return lookup_join(transactions, categories.select("category_code", "category_name", "co2_multiplier"),
                       "category_code", "left")


def with_emission(df: DataFrame) -> DataFrame:
    """``co2_emission_g = round(amount_euro * co2_multiplier, 2)``."""
    return df.withColumn("co2_emission_g", rounded_product("amount_euro", "co2_multiplier", 2))


def emission_report(transactions: DataFrame, categories: DataFrame, country: str,
                    excluded_category: str = EXCLUDED_CATEGORY_NAME) -> DataFrame:
    """Emission per transaction for one country, one category left out.

    Rows without a category name drop out too (NULL is not ``!=``).
    The country filter reaches the scan; the category filter turns the left
    lookup into an inner one that Catalyst pushes to the small side.
    """
    rows = with_emission(with_categories(transactions, categories))
    rows = rows.filter((F.col("category_name") != F.lit(excluded_category))
                       & (F.col("counterparty_country") == F.lit(country)))
    return rows.select("co2_emission_g", "amount_euro", "category_code", "category_name", "co2_multiplier")


def mean_emission_by_category(report: DataFrame) -> DataFrame:
    """Mean emission (and count, total) per category name, from exact sums."""
    return exact_sums(report, ["category_name"], {"total": "co2_emission_g"}).select(
        "category_name",
        shown_mean("total", "total__n").alias("mean_co2_emission_g"),
        shown("total").alias("total_co2_emission_g"),
        F.col("total__n").alias("transactions"),
    )


def emission_points(report: DataFrame) -> DataFrame:
    """Amount against emission, per category: the scatter plot's data."""
    return report.select("amount_euro", "co2_emission_g", "category_name")


def star_emissions(fact: DataFrame, currency_dim: DataFrame, category_dim: DataFrame,
                   counterparty_dim: DataFrame) -> DataFrame:
    """Emission per category and country, read from the star schema.

    Fact rows resolve their surrogate ids against the dimensions (size-checked
    lookups), amounts in another currency are converted with the currency
    dimension's rate, and spend without a category (no multiplier) is left
    out. Same arithmetic as ``to_euro`` and ``with_emission``.
    """
    rows = lookup_join(fact, currency_dim.select("currency_id", "currency", "conversion_rate"), "currency_id")
    rows = lookup_join(rows, category_dim.select("category_id", "category_name", "co2_multiplier"),
                       "category_id", "inner")
    rows = lookup_join(rows, counterparty_dim.select("counterparty_id", "counterparty_country"),
                       "counterparty_id")
    foreign = F.col("currency") != F.lit(EURO)
    euro = F.when(foreign, rounded_product("amount_euro", "conversion_rate", 3)).otherwise(F.col("amount_euro"))
    rows = rows.withColumn("amount_eur", euro).withColumn(
        "co2_emission_g", rounded_product("amount_eur", "co2_multiplier", 2))
    values = {"grams": "co2_emission_g", "euro": "amount_eur"}
    return exact_sums(rows, ["category_name", "counterparty_country"], values).select(
        "category_name", "counterparty_country",
        shown_mean("grams", "grams__n").alias("mean_co2_emission_g"),
        shown("grams").alias("total_co2_emission_g"),
        shown("euro").alias("total_amount_eur"),
        F.col("__rows").alias("transactions"),
    )
