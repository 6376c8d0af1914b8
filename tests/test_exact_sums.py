"""Sums of doubles: exact, rounded once, the same for every order of rows."""

import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ledgerstar.functions.exact import exact_sums


def bits(x):
    return struct.pack(">d", x)


def sums(spark, groups, parts=3):
    rows = [(k, v) for k, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "k int, v double").repartition(parts)
    return {r.k: (r.total, r["total__n"]) for r in exact_sums(df, ["k"], {"total": "v"}).collect()}


def nearest(values):
    total = sum((Fraction(v) for v in values), Fraction(0))
    return total.numerator / total.denominator  # int division rounds correctly


def wild(rng):
    return struct.unpack(">d", rng.getrandbits(64).to_bytes(8, "big"))[0]


def test_random_sums_are_nearest(spark):
    rng = random.Random(3)
    groups = {}
    for k in range(120):
        kind, n = k % 6, rng.randrange(1, 40)
        if kind == 0:
            values = [round(rng.uniform(-1e5, 1e5), 2) for _ in range(n)]
        elif kind == 1:
            values = [rng.choice([1e16, -1e16, 1.0, 0.5, 3e-17, -1.0]) for _ in range(n)]
        elif kind == 2:
            values = [v for v in (wild(rng) for _ in range(n)) if math.isfinite(v) and abs(v) < 1e300] or [1.0]
        elif kind == 3:
            values = [rng.uniform(-1, 1) * 2.0 ** rng.randrange(-1074, 900) for _ in range(n)]
        elif kind == 4:
            values = [rng.choice([5e-324, -5e-324, 2.2250738585072014e-308, 1e-310]) for _ in range(n)]
        else:
            values = [2.0**53, 1.0, 2.0**-60 * rng.randrange(2)] * n  # ties to even, and just beside them
        groups[k] = values
    got = sums(spark, groups)
    for k, values in groups.items():
        assert bits(got[k][0] + 0.0) == bits(nearest(values) + 0.0), (k, values)
        assert got[k][1] == len(values)


def test_every_power_of_two(spark):
    rows = [(e, 2.0**e) for e in range(-1074, 1024)] + [(e, -(2.0 ** (e - 1)) * (2 - 2**-52)) for e in range(-1020, 1024)]
    df = spark.createDataFrame([(abs(e) * 2 + (e < 0), v) for e, v in rows], "k int, v double")
    got = {r.k: r.total for r in exact_sums(df, ["k"], {"total": "v"}).collect()}
    want = {}
    for e, v in rows:
        want.setdefault(abs(e) * 2 + (e < 0), []).append(v)
    assert got == {k: nearest(v) for k, v in want.items()}


def test_the_order_of_rows_does_not_show(spark):
    rng = random.Random(8)
    values = [1e16, 1.0, -1e16, 0.1, 1e-9, -3e15, 7.7, 3e15] * 40 + [rng.uniform(-1e9, 1e9) for _ in range(300)]
    seen = set()
    for parts in (1, 2, 7, 16):
        rng.shuffle(values)
        seen.add(bits(sums(spark, {1: values}, parts)[1][0]))
    assert len(seen) == 1
    assert sums(spark, {1: [1e16, 1.0, -1e16]}) == {1: (1.0, 3)} and sums(spark, {1: [1e16, -1e16, 1.0]}) == {1: (1.0, 3)}


def test_special_values(spark):
    inf, nan = float("inf"), float("nan")
    got = sums(spark, {1: [None, None], 2: [0.0, -0.0, None], 3: [inf, 1.0], 4: [-inf, 1e308], 5: [inf, -inf], 6: [nan, 1.0], 7: [1e308, 1e308], 8: [1e308, 1e308, -1e308]})
    assert got[1] == (None, 0) and got[2] == (0.0, 2) and got[3] == (inf, 2) and got[4] == (-inf, 2)
    assert math.isnan(got[5][0]) and math.isnan(got[6][0]) and got[7] == (inf, 2) and got[8] == (1e308, 3)


def test_keys_names_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "x", 1.5, 2), (None, "x", 2.5, None), ("a", None, None, 3)], "`k.1` string, base string, v double, w int")
    got = sorted(map(str, exact_sums(df, ["k.1", "base"], {"v": "v", "twice": F.col("w") * 2}).collect()))
    assert got == sorted(["Row(k.1=None, base='x', v=4.0, v__n=2, twice=4.0, twice__n=1, __rows=2)", "Row(k.1='a', base=None, v=None, v__n=0, twice=6.0, twice__n=1, __rows=1)"])
    assert exact_sums(df.limit(0), ["k.1"], {"v": "v"}).count() == 0


def test_a_hot_key_is_added_up_in_its_tasks(spark):
    df = spark.range(200_000).select(F.lit(1).alias("k"), (F.col("id") / 100).alias("v"))
    plan = exact_sums(df, ["k"], {"v": "v"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2 and "SortAggregate" not in plan and "Python" not in plan


def test_shown_rounds_the_binary_value(spark):
    from ledgerstar.functions.money import shown, shown_mean

    rng = random.Random(12)
    values = [224739.15 / 128, 0.1, -2.5, 1e300, 5e-324, 0.0, 123456789012.5, 123456789011.5, 1e22]
    values += [rng.uniform(-1, 1) * 10.0 ** rng.randrange(-20, 20) for _ in range(200)] + [rng.randrange(10**13) / 2.0**k for k in range(60)]
    df = spark.createDataFrame([(k, v) for k, v in enumerate([*values, None, float("inf"), float("nan")])], "k int, v double")
    got = [r.s for r in df.orderBy("k").select(shown("v").alias("s")).collect()]
    assert got[: len(values)] == [float(f"{v:.11e}") for v in values]
    assert got[-3] is None and got[-2] == float("inf") and math.isnan(got[-1])
    assert df.limit(1).select(shown_mean(F.lit(10.0), F.lit(4)).alias("m"), shown_mean(F.lit(None).cast("double"), F.lit(0)).alias("n")).first() == (2.5, None)
