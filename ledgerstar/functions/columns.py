"""Column-level helpers: ordering, typed NULLs, presence checks, casts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MissingColumnsError(ValueError):
    """Raised when a frame lacks columns an operator needs."""


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumnsError(f"missing columns {missing}; frame has {df.columns}")


def reorder_columns(df: DataFrame, first: list[str]) -> DataFrame:
    """Given columns first, all others after them in their original order."""
    require_columns(df, first)
    rest = [c for c in df.columns if c not in first]
    return df.select(*first, *rest)


def typed_null(type_name: str = "string") -> Column:
    """A NULL literal of a given type (keeps the column type on write)."""
    return F.lit(None).cast(type_name)


def blank_columns(df: DataFrame, names: Iterable[str], type_name: str = "string") -> DataFrame:
    """Replace (or add) columns with typed NULLs."""
    return df.withColumns({n: typed_null(type_name) for n in names})


def conform(df: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """Cast known columns to their expected types with ``try_cast``.

    A value that does not cast becomes NULL instead of failing the job (ANSI
    mode); quality.Castable flags such rows by comparing with the raw value.
    Columns already of the right type are left untouched.
    """
    current = dict(df.dtypes)
    casts = {
        name: F.col(name).try_cast(dtype)
        for name, dtype in types.items()
        if name in current and current[name] != dtype.simpleString()
    }
    return df.withColumns(casts) if casts else df
