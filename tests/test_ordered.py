"""Ordered operators against brute force, with one group holding most of the rows."""
import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest

from halfhourly.operators.aggregates import group_by_meta
from halfhourly.operators.ordered import carry_down, newest, next_value, quantiles, running_total
from halfhourly.plans.analysis import demand_distribution, histogram, offer_curve
from halfhourly.plans.hydro import shift_to_day_before, storage_by_day_of_year, year_of_series


@pytest.fixture(scope="module")
def values():
    """A hot group, small groups, many equal values, nulls and a null key."""
    rng = random.Random(7)
    rows = [("hot", rng.choice([0.01, 5.0, rng.uniform(-50, 50)]), rng.randint(1, 9))
            for _ in range(4000)]
    rows += [(f"g{i % 40}", round(rng.gauss(0, 9), 1), rng.randint(1, 9)) for i in range(900)]
    rows += [("one", 3.5, 2), ("same", 1.0, 1), ("same", 1.0, 1), ("hot", None, 4), (None, 1.0, 1)]
    return pd.DataFrame(rows, columns=["k", "v", "n"])


@pytest.fixture(params=[1, 50])
def cut(spark, request):
    """The same results are wanted from 1 and from 50 partitions."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], str(request.param))
    spark.conf.set(names[1], "false")
    yield request.param
    for n, value in zip(names, before):
        spark.conf.set(n, value)


def test_quantiles(spark, values, cut):
    df = spark.createDataFrame(values.astype({"n": "int"}).values.tolist(), "k string, v double, n int")
    df = df.where("NOT isnan(v) OR v IS NULL")
    p = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r["k"], r["probability"]): r["value"]
           for r in quantiles(df, ["k"], "v", p).collect()}
    clean = values.dropna()
    want = {(k, q): float(np.quantile(g["v"], q)) for k, g in clean.groupby("k") for q in p}
    assert got.keys() == want.keys()
    assert all(abs(got[x] - want[x]) < 1e-9 for x in want)


def test_quantiles_of_nothing_and_of_everything(spark):
    df = spark.createDataFrame([("a", None)], "k string, v double")
    assert quantiles(df, ["k"], "v", [0.5]).count() == 0
    numbers = spark.range(101)
    whole = quantiles(numbers, [], "id", [0.25, 0.5]).collect()
    assert sorted(tuple(r) for r in whole) == [(0.25, 25.0), (0.5, 50.0)]


def test_running_total(spark, values, cut):
    df = spark.createDataFrame([(k, v, int(n)) for k, v, n in values.dropna().values],
                               "k string, v double, n long")
    got = {(r["k"], r["v"]): (r["n"], r["upto"])
           for r in running_total(df, ["k"], "v", "n", "upto").collect()}
    merged = values.dropna().groupby(["k", "v"])["n"].sum().reset_index().sort_values(["k", "v"])
    merged["upto"] = merged.groupby("k")["n"].cumsum()
    want = {(r.k, r.v): (r.n, r.upto) for r in merged.itertuples()}
    assert got == want


def test_offer_curve(spark, rows):
    day = dt.date(2014, 5, 24)
    bands = spark.createDataFrame(
        [(day, 1, 5.0, 10.0), (day, 1, 0.01, 3.0), (day, 1, 5.0, 2.0), (day, 2, 1.0, 4.0)],
        "trading_date date, trading_period int, price double, power double")
    assert rows(offer_curve(bands)) == [(day, 1, 0.01, 3.0, 3.0), (day, 1, 5.0, 12.0, 15.0),
                                        (day, 2, 1.0, 4.0, 4.0)]


def test_equal_bits_however_rows_are_cut(spark):
    """One key with most rows, values that are no whole numbers, a null key."""
    rng = random.Random(11)
    table = [("hot" if i % 10 else None, i, rng.uniform(0, 1e5), None if i % 7 else f"h{i}")
             for i in range(5000)]
    results = []
    for n in (1, 50):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        df = spark.createDataFrame(table, "k string, i long, v double, h string").repartition(n + 2)
        results.append([sorted(map(tuple, out.collect()), key=repr) for out in (
            running_total(df, ["k"], "i", "v", "upto"), quantiles(df, ["k"], "v", [0.1, 0.5]),
            next_value(df, ["k"], "i", "v"), carry_down(df, ["k"], "i", "h", "above"),
            group_by_meta(df, "k", {"v": ["sum", "mean", "median"]}))])
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]
    assert [len(r) for r in results[0]] == [4500, 2, 4998, 5000, 1]
    assert sum(r[-1] is not None for r in results[0][3]) == 4994  # six rows come before the first head


def test_next_value(spark, cut):
    start = dt.date(2014, 1, 28)
    table = [("a", start + dt.timedelta(days=i), None if i == 4 else float(i)) for i in range(70)]
    table += [("b", dt.date(2013, 12, 31), 1.0), ("b", dt.date(2014, 3, 1), 2.0),
              ("c", start, 9.0)]
    df = spark.createDataFrame(table, "lake string, trading_date date, lake_levels double")
    got = {(r["lake"], r["trading_date"]): r["lake_levels"]
           for r in next_value(df, ["lake"], "trading_date", "lake_levels").collect()}
    want = {("a", start + dt.timedelta(days=i)): None if i == 3 else float(i + 1)
            for i in range(69)}
    want[("b", dt.date(2013, 12, 31))] = 2.0
    assert got == want
    assert shift_to_day_before(df).columns == df.columns and shift_to_day_before(df).count() == 70


def test_carry_down(spark, cut):
    heads = {0: None, 3: "EA", 4: None, 11: "EB", 30: "EC"}
    table = [("p", i, heads.get(i)) for i in range(40)] + [("q", 5, None), ("q", 6, "EE")]
    df = spark.createDataFrame(table, "page string, row_no int, code string")
    got = {(r["page"], r["row_no"]): r["product"]
           for r in carry_down(df, ["page"], "row_no", "code", "product").collect()}
    last, want = None, {("q", 5): None, ("q", 6): "EE"}
    for i in range(40):
        last = heads.get(i) or last
        want[("p", i)] = last
    assert got == want


def test_newest(spark, rows):
    df = spark.createDataFrame(
        [("a", dt.date(2014, 1, 1), 1.0), ("a", dt.date(2014, 2, 1), 0.5), ("a", None, 9.0),
         ("b", None, 1.0), ("b", None, 2.0)], "k string, amended date, price double")
    assert rows(newest(df, ["k"], ["amended"])) == [("a", dt.date(2014, 2, 1), 0.5),
                                                    ("b", None, 2.0)]


def test_distributions(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 4.0), ("b", 9.0), ("b", None)],
                               "load_area string, demand double")
    assert rows(demand_distribution(df, ["load_area"], [0.5])) == [("a", 0.5, 2.0), ("b", 0.5, 9.0)]
    assert rows(demand_distribution(df, ["load_area"], [0.5], exact=False)) == [
        ("a", 0.5, 2.0), ("b", 0.5, 9.0)]
    assert rows(histogram(df, ["load_area"], "demand", 2.0)) == [
        ("a", 0.0, 1), ("a", 2.0, 1), ("a", 4.0, 1), ("b", 8.0, 1)]


def test_hydro(spark, rows):
    df = spark.createDataFrame(
        [("Taupo", dt.date(y, 1, 5), float(y)) for y in (2011, 2012, 2013)],
        "lake string, trading_date date, lake_levels double")
    assert rows(storage_by_day_of_year(df, probabilities=[0.5])) == [("Taupo", 5, 0.5, 2012.0)]
    assert rows(year_of_series(df, 2012)) == [("Taupo", dt.date(2012, 1, 5), 2012.0)]
