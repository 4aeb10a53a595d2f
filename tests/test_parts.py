"""Aggregates in parts, sketches, days as bits, dates as rows, UTC instants."""

import datetime as dt
import random
from zoneinfo import ZoneInfo

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from halfhourly.functions import dates as D
from halfhourly.operators import daybits as B, inparts as I, predicates as P, sketches as S
from halfhourly.operators.aggregates import group_by_meta
from halfhourly.sources.tables import conform, read_table, with_year, write_rows
from halfhourly.schemas import TABLES

VALUE = "g string, v double"


def test_no_task_holds_a_group(spark):
    class Longest(I.InParts):
        """The largest number of values that any one state was given, to see how a group is dealt."""

        name = "longest"

        def start(self):
            return (0, 0)

        def add(self, state, values):
            return (state[0] + len(values), max(state[1], state[0] + len(values)))

        def merge(self, one, other):
            return (0, max(one[1], other[1]))

        def finish(self, state):
            return float(state[1])

    rows = spark.range(0, 100_000, 1, 20).select(
        F.when(F.col("id") % 10 == 0, "small").otherwise("large").alias("g"), (F.col("id") % 7).cast("double").alias("v"))
    found = {r.g: r.v for r in group_by_meta(rows, "g", {"v": Longest()}).collect()}
    assert found["large"] <= 90_000 / 20 and found["small"] <= 10_000 / 20


def test_quantiles_and_trimmed_means_of_few_values(spark):
    draw = random.Random(2)
    rows = [("a", float(draw.randrange(40))) for _ in range(999)] + [("b", None), ("b", 2.5), ("c", None), ("d", float("nan"))]
    df = spark.createDataFrame(rows, VALUE).repartition(13)
    found = {r.g: (r.v_q, r.v_t) for r in group_by_meta(
        df, "g", {"v": [I.Quantile(0.3, "q"), I.TrimmedMean(0.1, "t")]}).collect()}
    values = pd.Series([v for g, v in rows if g == "a"])
    cut = sorted(values)[99:-99]
    assert found["a"] == (values.quantile(0.3), pytest.approx(sum(cut) / len(cut)))
    assert found["b"] == (2.5, 2.5) and found["c"] == found["d"] == (None, None)


@pytest.mark.parametrize("pieces", [1, 40])
def test_rank_error_of_many_different_values(pieces):
    draw = np.random.default_rng(pieces)
    values = draw.normal(size=200_000)
    quantile, states = I.Quantile(0.4, most=2000), []
    for part in np.array_split(values, pieces):
        state = quantile.start()
        for some in np.array_split(part, 5):
            state = quantile.add(state, some)
        states.append(state)
    whole = states[0]
    for other in states[1:]:
        whole = quantile.merge(whole, other)
    assert int(whole.weighted()[1].sum()) == len(values)
    levels = len(whole.levels)
    assert sum(map(len, whole.levels)) <= levels * 2000
    rank = (values < quantile.finish(whole)).mean()
    assert abs(rank - 0.4) <= levels / 2000 + 1e-4


def test_sketches_of_days_add_up(spark, tmp_path):
    days = spark.range(60_000).select(F.lit("x").alias("g"), (F.col("id") * 7919 % 60_000).cast("double").alias("v"),
                                      F.expr("date_add(DATE'2013-12-01', CAST(id % 100 AS INT))").alias("trading_date"))
    for half in (0, 1):
        S.add_sketches(S.day_sketches(days.where(F.col("v") % 2 == half), ["g"], "v"), str(tmp_path / "s"))
    held = S.range_sketches(spark, str(tmp_path / "s"), ["g"], "2013-12-01", "2014-01-19")
    found = {r.probability: (r.value, r.n) for r in S.sketch_quantiles(held, ["g"], [0.1, 0.5, 0.9]).collect()}
    inside = sorted(r.v for r in days.where("trading_date <= DATE'2014-01-19'").collect())
    for p, (value, n) in found.items():
        assert n == len(inside) == 30_000
        assert abs(np.searchsorted(inside, value) / n - p) <= 2 * S.RANK_ERROR


def test_days_as_bits(spark, tmp_path):
    d = dt.date
    held = [("a", d(1969, 12, 30)), ("a", d(1970, 1, 1)), ("a", d(2014, 2, 28)), ("b", d(2014, 3, 1)), ("b", None)]
    df = spark.createDataFrame(held, "k string, trading_date date")
    for _ in range(2):
        B.add_bits(B.day_bits(df, ["k"]), str(tmp_path / "bits"))
    bits = B.read_bits(spark, str(tmp_path / "bits"), ["k"])
    assert {(r.k, r.n_days) for r in B.held_days(bits, ["k"]).collect()} == {("a", 3), ("b", 1)}
    for begin, end in ((d(1969, 12, 25), d(1970, 1, 3)), (d(2014, 2, 27), d(2014, 3, 2)), (d(2013, 1, 1), d(2014, 12, 31))):
        found = {(r.k, r.trading_date) for r in B.days_missing(bits, ["k"], begin, end).collect()}
        every = {begin + dt.timedelta(i) for i in range((end - begin).days + 1)}
        assert found == {(k, x) for k in "ab" for x in every} - set(held)
    plan = B.days_missing(bits, ["k"], d(2014, 1, 1), d(2014, 2, 1))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_dates_as_rows_prune_years(spark, tmp_path):
    rows = spark.range(3000).select(F.expr("date_add(DATE'2010-01-01', CAST(id AS INT))").alias("trading_date"),
                                    F.lit(1).alias("trading_period"), F.lit("N").alias("node"), F.lit(1.0).alias("demand"))
    store, days = str(tmp_path / "store"), str(tmp_path / "days")
    write_rows(with_year(conform(rows, "nodal_demand"), TABLES["nodal_demand"]), store, "nodal_demand")
    spark.createDataFrame([(dt.date(2012, 5, k),) for k in range(1, 20)] * 2, "trading_date date").write.parquet(days)
    found = P.on_days_of(read_table(spark, store, "nodal_demand"), spark.read.parquet(days))
    assert found.count() == 19
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()


def test_periods_of_clock_change_days(spark):
    days = [dt.date(2013, 9, 28), dt.date(2013, 9, 29), dt.date(2014, 4, 5), dt.date(2014, 4, 6), dt.date(1996, 3, 17)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r[0] for r in df.select(D.periods_of_day("d")).collect()] == [48, 46, 48, 50, 50]
    every = df.select("d", F.explode(F.sequence(F.lit(1), D.periods_of_day("d"))).alias("p"))
    at = every.withColumn("utc", D.period_start_utc("d", "p"))
    rows = at.select("*", D.period_at_utc("utc").alias("back")).collect()
    assert len({r.utc for r in rows}) == len(rows) == 48 + 46 + 48 + 50 + 50
    zone = ZoneInfo(D.MARKET_ZONE)
    for r in rows:
        midnight = dt.datetime(r.d.year, r.d.month, r.d.day, tzinfo=zone).astimezone(dt.timezone.utc)
        assert r.utc == (midnight + dt.timedelta(minutes=30 * (r.p - 1))).replace(tzinfo=None)
        assert (r.back.trading_date, r.back.trading_period) == (r.d, r.p)
    beyond = spark.createDataFrame([(days[1], 47), (days[0], 0), (None, 1), (days[0], None)], "d date, p int")
    assert [r[0] for r in beyond.select(D.period_start_utc("d", "p")).collect()] == [None] * 4
