"""Money arithmetic on DOUBLE amounts.

A rounded product is ``round(amount * factor, n)`` of the two doubles, half-up
on the product's shortest decimal form: no amount or factor is narrowed first.
Sums are exact (``functions.exact``) and shown to twelve significant digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rounded_product(amount: Column | str, factor: Column | str, scale: int) -> Column:
    """``round(amount * factor, scale)``, half-up."""
    return F.round(_col(amount) * _col(factor), scale)


def shown(value: Column | str) -> Column:
    """Twelve significant digits of a DOUBLE, rounded from its exact binary value (ties to even); NULL stays NULL."""
    value = _col(value)
    digits = F.call_function("format_number", value, F.lit("0.00000000000E0")).cast("double")
    return F.when(F.abs(value) < float("inf"), digits).otherwise(value)


def shown_mean(total: Column | str, count: Column | str) -> Column:
    """Mean from an exact total, to twelve significant digits; NULL without values."""
    return shown(F.when(_col(count) > 0, _col(total) / _col(count)))
