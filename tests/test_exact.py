"""Exact sums next to Python's exact sum, whatever the size of values and the number of partitions."""

import math
import random
import struct
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from halfhourly.operators import exact
from halfhourly.operators.aggregates import group_by_meta
from halfhourly.operators.ordered import running_total
from halfhourly.operators.reshape import half_hour_to_long


def written(v):
    return (abs(v) < 9e5 and round(v * 1e10) / 1e10 == v or abs(v) < 9e11 and round(v * 1e4) / 1e4 == v
            or abs(v) < 1e17 and round(v) == v)


def nearest(values):
    """Decimals as they are written, everything else as it is, each sum rounded once."""
    decimals = float(sum((Decimal(repr(v)) for v in values if written(v)), Decimal(0)))
    odd = [v for v in values if not written(v)]
    if not odd:
        return decimals
    total = sum(map(Fraction, odd))
    try:
        return decimals + float(total)
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def some_value(draw):
    kind = draw.random()
    if kind < 0.3:
        return round(draw.uniform(-1e6, 1e6), 3)
    if kind < 0.5:
        return draw.uniform(-1, 1) * 10.0 ** draw.randint(-300, 300)
    if kind < 0.6:
        return struct.unpack("d", struct.pack("Q", draw.getrandbits(63) & 0x7FDFFFFFFFFFFFFF))[0]
    if kind < 0.7:
        return draw.choice([5e-324, -5e-324, 2.0 ** -1070, 0.0, -0.0, 2.0 ** 1000, -2.0 ** 1000])
    return float(draw.randint(-5, 5)) * 2.0 ** draw.randint(-60, 60)


@pytest.mark.parametrize("cuts", [1, 50])
def test_sums_of_any_values(spark, cuts):
    draw = random.Random(1)
    groups = {}
    for g in range(200):
        values = [some_value(draw) for _ in range(draw.randint(1, 30))]
        groups[g] = values + [-v for v in values[:draw.randint(0, len(values))]]
    rows = [(g, v) for g, values in groups.items() for v in values]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "g long, v double").repartition(cuts)
    found = {r.g: (r.total, r.total_n) for r in exact.exact_sums(df, ["g"], {"total": "v"}).collect()}
    assert found == {g: (nearest(values), len(values)) for g, values in groups.items()}


def test_missing_and_infinite_values(spark):
    inf, nan = math.inf, math.nan
    rows = [(1, 1.0), (1, inf), (2, 1.0), (2, nan), (2, None), (3, inf), (3, -inf), (4, nan), (5, 1e19), (6, 3e-11), (6, 3e-11)]
    df = spark.createDataFrame(rows, "g long, v double")
    found = {r.g: (r.v_sum, r.v_mean, r.v_count) for r in
             group_by_meta(df, "g", {"v": ["sum", "mean", "count"]}).collect()}
    assert found[1] == (inf, inf, 2) and found[2] == (1.0, 1.0, 1) and found[4] == (None, None, 0)
    assert math.isnan(found[3][0]) and math.isnan(found[3][1])
    assert found[5] == (1e19, 1e19, 1) and found[6] == (6e-11, 3e-11, 2)


def test_several_columns_and_a_column_of_whole_numbers(spark):
    df = spark.createDataFrame([("a", 0.1, 1.5, 3), ("a", 0.2, None, 4)], "g string, v double, w double, n int")
    assert [tuple(r) for r in group_by_meta(df, "g", "sum").collect()] == [("a", 0.3, 1.5, 7)]


def test_sums_add_up_from_parts(spark):
    values = [0.1, 0.2, 0.7, 1e300, -1e300, 1e-20, 5.5]
    halves = [exact.parts(spark.createDataFrame([(1, v) for v in vs], "g long, v double"), ["g"], "v")
              for vs in (values[:4], values[4:])]
    total = exact.totals(exact.added(halves[0].unionByName(halves[1]), ["g"]), ["g"]).first()["total"]
    assert total == nearest(values)


@pytest.mark.parametrize("cuts", [1, 7])
def test_running_sums(spark, cuts):
    values = [(k, v) for k, v in enumerate([0.1, 0.2, 1e-15, 0.7, 2.0 ** 70, -2.0 ** 70, 0.4])]
    df = spark.createDataFrame([("a", k, v) for k, v in values], "g string, k int, v double").repartition(cuts)
    found = [r.upto for r in running_total(df, ["g"], "k", "v", "upto").orderBy("k").collect()]
    want = [nearest([v for _, v in values[:i + 1]]) for i in range(len(values))]
    assert found == pytest.approx(want, rel=1e-15) and found[:2] == [0.1, 0.3]
    odd = df.withColumn("v", F.when(F.col("k") == 2, float("inf")).when(F.col("k") == 5, float("-inf")).otherwise(F.col("v")))
    found = [r.upto for r in running_total(odd, ["g"], "k", "v", "upto").orderBy("k").collect()]
    assert found[1] == 0.3 and found[2:5] == [math.inf] * 3 and math.isnan(found[5]) and math.isnan(found[6])


def test_half_hours_of_rows_that_repeat(spark):
    rows = [("A", 0.1, 1e19), ("A", 0.2, -1e19), ("A", 0.4, 3e-11), ("B", math.nan, 2.5)]
    df = spark.createDataFrame(rows, "poc string, TP1 double, TP2 double")
    found = {(r.Grid_Point, r.Trading_Period): r.Average_Output for r in half_hour_to_long(df, 1.0).collect()}
    assert found == {("A", 1): 0.7, ("A", 2): 3e-11, ("B", 2): 2.5}
