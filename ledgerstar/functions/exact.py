"""Exact sums of DOUBLEs: the order rows arrive in cannot show.

A double is cut into limbs: whole multiples, below about 2^20, of the bases
2^(20 j - 1074), from the base of its exponent downwards. Doubles of one top
base are cut at the same places, so their limbs, BIGINTs, add up exactly in
any order with the built-in sum, partially in each task. What is left is one
row per key and top base (at most 105, in practice a few); from these the
total is put together as an exact integer and rounded to the nearest double
once, ties to even.

Everything is a built-in expression; what touches every row is generated code.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 20
LOWEST = -1074  # the exponent of the smallest double
PARTS = 5  # limbs that hold any double's 53 bits, wherever the bases cut them
LAST_BASE = 104
NAN, PLUS_INFINITY, MINUS_INFINITY, ZERO = -1, -2, -3, -4  # "bases" of what has no limbs
TOP_LIMBS = 5  # limbs that are put together as an integer: at least 81 bits, far over the 53 that a double keeps
CARRY_LIMBS = 4  # a sum of BIGINTs reaches this many bases above its own
_SMALLEST = "CAST('4.9E-324' AS DOUBLE)"


def limb_columns(x: str = "x") -> list[str]:
    """SQL columns ``j`` (top base; NULL for a NULL) and ``p0`` to ``p4`` (limbs at that base and below) of a DOUBLE column."""
    top = f"least(greatest(CAST(floor((floor(log2(abs({x}))) - ({LOWEST})) / {WIDTH}) AS INT), 0), {LAST_BASE})"
    columns = [
        f"CASE WHEN {x} IS NULL THEN NULL WHEN isnan({x}) THEN {NAN} WHEN {x} = double('Infinity') THEN {PLUS_INFINITY} "
        f"WHEN {x} = double('-Infinity') THEN {MINUS_INFINITY} WHEN {x} = 0 THEN {ZERO} ELSE {top} END AS j",
        f"CASE WHEN j >= 0 THEN {x} ELSE 0D END AS r0",
        f"pow(2D, CAST(greatest(coalesce(j, 0), 0) * {WIDTH} + ({LOWEST}) AS DOUBLE)) AS b0",
    ]
    for k in range(PARTS):
        columns += [f"CAST(r{k} / b{k} AS BIGINT) AS p{k}",
                    f"r{k} - CAST(p{k} AS DOUBLE) * b{k} AS r{k + 1}",
                    f"greatest(b{k} * {2.0**-WIDTH!r}D, {_SMALLEST}) AS b{k + 1}"]
    return columns


def _carry(sums: str) -> str:
    """SQL: sums by base (array of DECIMAL(38,0), lowest base first) as digits below 2^20 and what is carried beyond."""
    unit = f"CAST({1 << WIDTH} AS DECIMAL(38,0))"
    digit = f"pmod(CAST(acc.total + s AS DECIMAL(38,0)), {unit})"
    return (f"aggregate({sums}, struct(CAST(0 AS DECIMAL(38,0)) AS total, CAST(array() AS array<bigint>) AS digits), "
            f"(acc, s) -> struct(CAST(floor((CAST(acc.total + s AS DECIMAL(38,0)) - {digit}) / {unit}) AS DECIMAL(38,0)) AS total, "
            f"concat(acc.digits, array(CAST({digit} AS BIGINT))) AS digits))")  # fmt: skip


def _nearest(df: DataFrame, entries: str, name: str) -> DataFrame:
    """``df`` with ``name``, ``name``_n and ``name``_rows from ``entries``: array<struct<j, p0 .. p4, n, n_rows>>, one entry a top base."""
    own = f"filter({entries}, e -> e.j >= 0)"
    flat = "flatten(transform(__own, e -> array(" + ", ".join(f"struct(greatest(e.j - {k}, 0) AS base, CAST(e.p{k} AS DECIMAL(38,0)) AS total)" for k in range(PARTS)) + ")))"
    zero = "CAST(0 AS DECIMAL(38,0))"
    steps = [
        {"__own": own, "__lo": f"array_min(transform({own}, e -> greatest(e.j - {PARTS - 1}, 0)))",
         "__hi": f"array_max(transform({own}, e -> e.j)) + {CARRY_LIMBS}", "__parts": flat.replace("__own", own)},
        {"__sums": f"transform(sequence(__lo, __hi), b -> aggregate(__parts, {zero}, (acc, t) -> CAST(acc + if(t.base = b, t.total, {zero}) AS DECIMAL(38,0))))"},
        {"__neg": f"({_carry('__sums')}).total < 0"},
        {"__digits": "(" + _carry("transform(__sums, s -> CAST(if(__neg, -s, s) AS DECIMAL(38,0)))") + ").digits"},
        # Place of the highest digit that isn't zero, from 1; 0 for a sum of zero.
        {"__last": "coalesce(array_max(transform(__digits, (d, i) -> if(d <> 0, i + 1, 0))), 0)"},
        {"__first": f"greatest(__last - {TOP_LIMBS - 1}, 1)"},
        {"__whole": f"aggregate(reverse(slice(__digits, __first, {TOP_LIMBS})), {zero}, (acc, d) -> CAST(acc * {1 << WIDTH} + d AS DECIMAL(38,0)))",
         # Anything below only matters for ties: it makes the last of over 80 bits odd.
         "__below": "exists(slice(__digits, 1, __first - 1), d -> d <> 0)",
         "__power": f"(__lo + __first - 1) * {WIDTH} + ({LOWEST})"},
        {"__size": "CAST(CAST(__whole + if(__below AND pmod(__whole, CAST(2 AS DECIMAL(38,0))) = 0, 1, 0) AS DECIMAL(38,0)) AS DOUBLE)"
                   # In two steps: the integer may be small while its power of two is beyond the doubles, or the other way round.
                   " * pow(2D, CAST(floor(__power / 2) AS DOUBLE)) * pow(2D, CAST(__power - floor(__power / 2) AS DOUBLE))",
         f"{name}_n": f"aggregate({entries}, 0L, (acc, e) -> acc + e.n)",
         f"{name}_rows": f"aggregate({entries}, 0L, (acc, e) -> acc + e.n_rows)"},
    ]
    kept = df.columns
    for step in steps:
        df = df.withColumns({c: F.expr(e) for c, e in step.items()})
    seen = {b: f"exists({entries}, e -> e.j = {b})" for b in (NAN, PLUS_INFINITY, MINUS_INFINITY)}
    value = (f"CASE WHEN {name}_n = 0 THEN NULL WHEN {seen[NAN]} OR ({seen[PLUS_INFINITY]} AND {seen[MINUS_INFINITY]}) THEN double('NaN') "
             f"WHEN {seen[PLUS_INFINITY]} THEN double('Infinity') WHEN {seen[MINUS_INFINITY]} THEN double('-Infinity') "
             f"WHEN __last = 0 THEN 0D WHEN __neg THEN -__size ELSE __size END AS {name}")  # fmt: skip
    return df.selectExpr(*[f"`{c}`" for c in kept], value, f"{name}_n", f"{name}_rows")


def exact_sums(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column | str]) -> DataFrame:
    """One row per key: for each name of ``values`` the exact sum, rounded once (``<name>``), and the values counted (``<name>__n``),
    and all rows of the key (``__rows``).

    NULLs are skipped; a key without any value has a NULL sum and a count of 0. A NaN, or infinities of both signs,
    give NaN. A hot key is added up inside its tasks: each hands on one row per value name and top base.
    """
    names = list(values)
    columns = [F.col(v) if isinstance(v, str) else v for v in values.values()]
    inside = [f"__k{i}" for i in range(len(keys))]
    given = [F.col(f"`{k}`").alias(i) for k, i in zip(keys, inside, strict=True)]
    rows = df.select(*given, F.inline(F.array(*[F.struct(F.lit(i).alias("v"), c.cast("double").alias("x")) for i, c in enumerate(columns)])))
    cut = rows.selectExpr(*inside, "v", "x", *limb_columns())
    parts = [f"p{k}" for k in range(PARTS)]
    added = cut.groupBy(*inside, "v", "j").agg(*[F.sum(p).alias(p) for p in parts], F.count("x").alias("n"), F.count(F.lit(1)).alias("n_rows"))
    # At most 109 entries a key and value: the top bases of a double.
    per_value = added.groupBy(*inside, "v").agg(F.collect_list(F.struct("j", *parts, "n", "n_rows")).alias("__e"))
    summed = _nearest(per_value, "__e", "__sum")
    if len(names) == 1:
        per_key, found, n_rows = summed, [(F.col("__sum"), F.col("__sum_n"))], "__sum_rows"
    else:
        one = [(F.max(F.when(F.col("v") == i, F.col("__sum"))), F.max(F.when(F.col("v") == i, F.col("__sum_n")))) for i in range(len(names))]
        columns = [c.alias(f"__{kind}{i}") for i, pair in enumerate(one) for kind, c in zip("vn", pair, strict=True)]
        per_key = summed.groupBy(*inside).agg(*columns, F.max("__sum_rows").alias("__rows"))
        n_rows = "__rows"
        found = [(F.col(f"__v{i}"), F.col(f"__n{i}")) for i in range(len(names))]
    out = [F.col(i).alias(k) for k, i in zip(keys, inside, strict=True)]
    return per_key.select(*out, *[c for (value, n), name in zip(found, names, strict=True) for c in (value.alias(name), n.alias(f"{name}__n"))],
                          F.col(n_rows).alias("__rows"))
