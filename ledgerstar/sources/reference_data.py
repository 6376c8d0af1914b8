"""Small reference inputs: currency rates and the category map.

The currency rates are the pipeline's fixed literal table. The category map is
an input CSV in production; SAMPLE_CATEGORY_MAP is an invented stand-in (every
validation code but 7512, so one lookup misses) whose names exercise CSV
quoting: a comma, a double quote and a line break.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerstar import schemas
from ledgerstar.constants import CONVERSION_RATES, EXCLUDED_CATEGORY_NAME

# Invented sample values (code, name, grams of CO2 per euro).
SAMPLE_CATEGORY_MAP: tuple[tuple[int, str, float], ...] = (
    (2222, "Financial transfers", 0.05),
    (3333, "Cash withdrawals, ATM", 0.02),
    (4111, "Local commuter transport", 0.12),
    (4112, "Passenger railways", 0.09),
    (4121, "Taxicabs and limousines", 0.41),
    (4131, "Bus lines", 0.15),
    (4511, EXCLUDED_CATEGORY_NAME, 1.85),
    (5411, "Grocery stores, supermarkets", 0.33),
    (5420, "Butchers", 0.92),
    (5422, "Freezer and locker meat provisioners", 0.88),
    (5462, "Bakeries", 0.27),
    (5541, "Service stations", 2.35),
    (5542, "Automated fuel dispensers", 2.4),
    (5912, 'Drug stores and "pharmacies"', 0.18),
    (6542, "Charities and\nsocial services", 0.06),
    (6630, "Insurance sales", 0.04),
)


def local_table(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType) -> DataFrame:
    """A small literal table as an inline ``VALUES`` relation.

    Values travel as bound parameters (no quoting), and the plan is a JVM
    ``LocalTableScan`` whose size Catalyst knows, not a Python RDD scan.
    """
    cells, args = [], {}
    for i, row in enumerate(rows):
        refs = []
        for j, (field, value) in enumerate(zip(schema.fields, row)):
            args[f"v{i}_{j}"] = value
            refs.append(f"CAST(:v{i}_{j} AS {field.dataType.simpleString()})")
        cells.append(f"({', '.join(refs)})")
    names = ", ".join(f"`{n}`" for n in schema.fieldNames())
    return spark.sql(f"SELECT * FROM VALUES {', '.join(cells)} AS t({names})", args=args)


def currency_rates(spark: SparkSession) -> DataFrame:
    """The literal rates table (5 rows)."""
    return local_table(spark, CONVERSION_RATES, schemas.CURRENCY_RATES)


def sample_category_map(spark: SparkSession) -> DataFrame:
    return local_table(spark, SAMPLE_CATEGORY_MAP, schemas.CATEGORY_MAP)
