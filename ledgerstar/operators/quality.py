"""Declarative data-quality rules, evaluated as DataFrame expressions.

A rule is a pair of boolean column expressions: ``violation`` (the row breaks
the rule; never NULL) and ``missing`` (the value is NULL and so not checked).
A suite of rules is evaluated in **one** aggregation pass over the data (one
conditional count per rule, partial aggregation per task), and rows are split
into clean and quarantined sets by the same predicates: nothing is collected
to the driver, and there is no row-position bookkeeping.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.constants import BLANKED_COLUMNS, CATEGORY_CODES, VALID_CURRENCIES
from ledgerstar.functions.columns import blank_columns, require_columns


def _false() -> Column:
    return F.lit(False)


@dataclass(frozen=True)
class Rule:
    name: str
    column: str

    def violation(self) -> Column:
        raise NotImplementedError

    def missing(self) -> Column:
        """NULL values are not checked by value rules (they pass)."""
        return F.col(self.column).isNull()

    def value(self) -> Column:
        """The offending value, as text, for unexpected-value listings."""
        return F.col(self.column).cast("string")

    @property
    def reported_column(self) -> str:
        return self.column


@dataclass(frozen=True)
class Between(Rule):
    """``min_value <= column <= max_value``; either bound may be open."""

    min_value: float | None = None
    max_value: float | None = None

    def violation(self) -> Column:
        c = F.col(self.column)
        outside = []
        if self.min_value is not None:
            outside.append(c < F.lit(self.min_value))
        if self.max_value is not None:
            outside.append(c > F.lit(self.max_value))
        if not outside:
            return _false()
        return F.coalesce(functools.reduce(operator.or_, outside), _false())

    def value(self) -> Column:
        return F.col(self.column).cast("string")


@dataclass(frozen=True)
class InSet(Rule):
    values: tuple = ()

    def violation(self) -> Column:
        c = F.col(self.column)
        return F.coalesce(c.isNotNull() & ~c.isin(list(self.values)), _false())


@dataclass(frozen=True)
class NotNull(Rule):
    def violation(self) -> Column:
        return F.col(self.column).isNull()

    def missing(self) -> Column:
        return _false()


_INTEGERS = ("tinyint", "smallint", "int", "bigint")
_WIDER = {t: set(_INTEGERS[i + 1:]) for i, t in enumerate(_INTEGERS)}
for _t in ("tinyint", "smallint"):
    _WIDER[_t] |= {"float", "double"}
_WIDER["int"] |= {"double"}
_WIDER["float"] = {"double"}
_PLAIN = {*_INTEGERS, "float", "double", "boolean", "date", "timestamp", "timestamp_ntz"}


def _is_decimal(type_name: str) -> bool:
    return type_name.startswith("decimal")


def _finer_decimal(type_name: str) -> str:
    """A decimal type with room for the whole digits of ``type_name`` and as many places as are left."""
    if not _is_decimal(type_name):
        return "decimal(38,18)"
    digits, places = (int(x) for x in type_name[8:-1].split(","))
    return f"decimal(38,{38 - (digits - places)})"


@dataclass(frozen=True)
class Castable(Rule):
    """A raw value is present but does not cast to ``type_name``, or the cast changes it.

    The comparison is made in the type that the value comes in: cast there and
    back, it has to be the same value. So a widening cast never fails, a
    DECIMAL fails where a DOUBLE cannot hold its digits, a BIGINT above 2^53
    fails where the DOUBLE next to it is another number, and a fraction that
    an integer type cuts off fails. Text has no such type: it has to parse,
    and for an integer or decimal target, read with all its places, to be the
    number that the cast gives. Rendering as text changes nothing.
    """

    type_name: str = "string"
    source_type: str = "string"

    def violation(self) -> Column:
        c = F.col(self.column)
        unreadable = c.isNotNull() & c.try_cast(self.type_name).isNull()
        changed = self._changed(c)
        return F.coalesce(unreadable if changed is None else unreadable | (c.isNotNull() & changed), _false())

    def _changed(self, c: Column) -> Column | None:
        source, target = self.source_type, self.type_name
        if target == source or target == "string" or target in _WIDER.get(source, ()):
            return None
        given = c.try_cast(target)
        if source == "string":
            if target not in _INTEGERS and not _is_decimal(target):
                return None
            finer = _finer_decimal(target)
            return ~c.try_cast(finer).eqNullSafe(given.cast(finer))
        if (source in _PLAIN or _is_decimal(source)) and (target in _PLAIN or _is_decimal(target)):
            back = ~given.try_cast(source).eqNullSafe(c)
            # The floating value 2^63 casts back to the largest BIGINT, which is not 2^63.
            return back | (given >= F.lit(2.0**63)) if source == "bigint" and target in ("float", "double") else back
        return None

    @property
    def reported_column(self) -> str:
        return self.column.removeprefix(RAW_PREFIX)


# The default suite: two amount ranges, the currency set, both timestamps.
AMOUNT_NOT_NEGATIVE = Between("amount_not_negative", "bookg_amt", min_value=0)
CENTS_NOT_NEGATIVE = Between("amount_cents_not_negative", "bookg_amt_nmrc", min_value=0)
CURRENCY_KNOWN = InSet("currency_known", "acct_ccy", VALID_CURRENCIES)
GMT_PRESENT = NotNull("booked_gmt_present", "bookg_dt_tm_gmt")
CET_PRESENT = NotNull("booked_cet_present", "bookg_dt_tm_cet")
DEFAULT_SUITE: tuple[Rule, ...] = (
    AMOUNT_NOT_NEGATIVE, CENTS_NOT_NEGATIVE, CURRENCY_KNOWN, GMT_PRESENT, CET_PRESENT,
)
# Defined alongside the suite but not part of it by default.
CATEGORY_KNOWN = InSet("category_known", "dtld_tx_tp", CATEGORY_CODES)


RAW_PREFIX = "_raw_"


def conform_with_checks(df: DataFrame, types: Mapping[str, T.DataType]) -> tuple[DataFrame, list[Rule]]:
    """Cast columns to their expected types, and one ``Castable`` rule per cast.

    Columns whose type differs keep their raw value in ``_raw_<name>`` and are
    replaced by ``try_cast``; the returned rules flag rows whose raw value is
    present but does not cast or would change, so they are quarantined instead
    of failing the job (ANSI) or silently turning into NULLs. Already-typed input gives no
    rules and an unchanged frame.
    """
    current = dict(df.dtypes)
    mismatched = [n for n, t in types.items() if n in current and current[n] != t.simpleString()]
    if not mismatched:
        return df, []
    out = df.withColumns({f"{RAW_PREFIX}{n}": F.col(n) for n in mismatched})
    out = out.withColumns({n: F.col(f"{RAW_PREFIX}{n}").try_cast(types[n]) for n in mismatched})
    rules = [Castable(f"{n}_parses", f"{RAW_PREFIX}{n}", types[n].simpleString(), current[n]) for n in mismatched]
    return out, rules


def drop_raw(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(RAW_PREFIX)])


def check_suite(df: DataFrame, rules: Sequence[Rule]) -> None:
    if not rules:
        raise ValueError("a suite needs at least one rule")
    require_columns(df, sorted({r.column for r in rules}))
    names = [r.name for r in rules]
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate rule names: {names}")


def suite_counts(rules: Sequence[Rule]) -> list[Column]:
    """The suite's aggregates: rows (``_ls_n``) and per rule missing (``_ls_m<i>``) and unexpected values (``_ls_u<i>``)."""
    aggs = [F.count(F.lit(1)).alias("_ls_n")]
    for i, rule in enumerate(rules):
        aggs.append(F.count(F.when(rule.missing(), True)).alias(f"_ls_m{i}"))
        aggs.append(F.count(F.when(rule.violation(), True)).alias(f"_ls_u{i}"))
    return aggs


def _report(totals: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    entries = F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(r.name).alias("rule"), F.lit(r.reported_column).alias("column"),
                 F.col(f"_ls_m{i}").alias("missing_count"), F.col(f"_ls_u{i}").alias("unexpected_count"))
        for i, r in enumerate(rules)
    ])
    long = totals.select(F.col("_ls_n").alias("element_count"), F.inline(entries))
    checked = F.col("element_count") - F.col("missing_count")
    return long.select(
        "rule", "column", "element_count", "missing_count", "unexpected_count",
        F.when(checked > 0, F.col("unexpected_count").cast("double") * F.lit(100.0) / checked.cast("double"))
         .alias("unexpected_percent"),
        (F.col("unexpected_count") == 0).alias("success"),
    )


def evaluate_suite(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Validation report, one row per rule, from a single aggregation pass.

    Columns: rule, column, element_count, missing_count, unexpected_count,
    unexpected_percent (of the checked, i.e. non-missing, values; NULL when
    nothing was checked) and success (no unexpected value).
    """
    check_suite(df, rules)
    return _report(df.agg(*suite_counts(rules)), rules)


def report_from_counts(spark: SparkSession, counts: Mapping[str, int], rules: Sequence[Rule]) -> DataFrame:
    """The same report from counts that another pass has observed (``suite_counts``): one row per rule, nothing is read."""
    names = [f"_ls_{kind}{i}" for i in range(len(rules)) for kind in "mu"]
    row = [int(counts[n]) for n in ("_ls_n", *names)]
    return _report(spark.createDataFrame([row], ", ".join(f"{n} bigint" for n in ("_ls_n", *names))), rules)


def suite_statistics(report: DataFrame) -> DataFrame:
    """One row: expectations evaluated, successful and not, and the percentage of successful ones."""
    n, good = F.count(F.lit(1)), F.count(F.when(F.col("success"), True))
    return report.agg(n.alias("evaluated_expectations"), good.alias("successful_expectations"),
                      (n - good).alias("unsuccessful_expectations"),
                      F.when(n > 0, good.cast("double") * F.lit(100.0) / n.cast("double")).alias("success_percent"))


def report_detail(report: DataFrame) -> DataFrame:
    """The report with every percentage: missing of all values, unexpected of all and of the values that are there."""
    every, missing = F.col("element_count"), F.col("missing_count")

    def percent(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part.cast("double") * F.lit(100.0) / whole.cast("double"))

    return report.withColumns({
        "missing_percent": percent(missing, every),
        "unexpected_percent_total": percent(F.col("unexpected_count"), every),
        "unexpected_percent_nonmissing": percent(F.col("unexpected_count"), every - missing),
    })


def suite_summary(report: DataFrame) -> DataFrame:
    """One row: overall success, number of rules, number of failed rules."""
    return report.agg(
        F.bool_and("success").alias("success"),
        F.count(F.lit(1)).alias("rules"),
        F.count_if(~F.col("success")).alias("failed_rules"),
    )


def violation_flag(rules: Sequence[Rule]) -> Column:
    """TRUE when the row breaks at least one rule (never NULL)."""
    return functools.reduce(operator.or_, [r.violation() for r in rules])


def failed_rule_names(rules: Sequence[Rule]) -> Column:
    """Comma-separated names of the rules a row breaks, in suite order."""
    return F.concat_ws(",", *[F.when(r.violation(), F.lit(r.name)) for r in rules])


def split_rows(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with a ``failed_rules`` column).

    Complete and order-free: every row lands in exactly one of the two.
    """
    check_suite(df, rules)
    flag = violation_flag(rules)
    good = df.filter(~flag)
    quarantine = df.filter(flag).withColumn("failed_rules", failed_rule_names(rules))
    return good, quarantine


def clean_rows(df: DataFrame, rules: Sequence[Rule] = DEFAULT_SUITE,
               blanked: Sequence[str] = BLANKED_COLUMNS) -> DataFrame:
    """Silver rows: the rows that pass every rule, with free-text columns blanked."""
    good, _ = split_rows(df, rules)
    return blank_columns(good, blanked)


def unexpected_values(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Every distinct offending value per rule with its count.

    Long format ``(rule, column, value, unexpected_n)``; value is text.
    One scan; only rows that break a rule go on, with one entry per rule they break, and the
    count is a partial (map-side) aggregation, so a hot value is combined
    before the shuffle.
    """
    check_suite(df, rules)
    entries = F.array(*[
        F.when(r.violation(), F.struct(F.lit(r.name).alias("rule"), F.lit(r.reported_column).alias("column"),
                                        r.value().alias("value")))
        for r in rules
    ])
    hits = df.filter(violation_flag(rules)).select(F.explode(F.array_compact(entries)).alias("hit")).select("hit.*")
    return hits.groupBy("rule", "column", "value").agg(F.count(F.lit(1)).alias("unexpected_n"))


def active_rules(report: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    """Rules a stored report marks as failed (the report has one row per rule)."""
    failed = {r["rule"] for r in report.filter(~F.col("success")).select("rule").collect()}
    unknown = failed - {r.name for r in rules}
    if unknown:
        raise ValueError(f"the report marks rules as failed that are not given: {sorted(unknown)}")
    return [r for r in rules if r.name in failed]


def report_path_for(input_file_name: str, folder: str) -> str:
    """Report location: input name with ``bronze.parquet`` -> ``_validation``, plus ``.json``."""
    return f"{folder}/{input_file_name.replace('bronze.parquet', '_validation')}.json"
