import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from halfhourly.operators.aggregates import aggregate_series, group_by_meta
from halfhourly.operators.joins import merge_meta, missing_days, missing_rows
from halfhourly.plans.market import (Market, query_nodal_demand, query_nodal_price, query_offer,
                                     stack)

DAY = dt.date(2014, 5, 24)


@pytest.fixture(scope="module")
def demand(spark):
    return spark.createDataFrame(
        [(DAY, 1, "OTA2201", 5.0), (DAY, 2, "OTA2201", 0.0), (DAY, 1, "TWC2201", -3.0),
         (DAY, 1, "BEN2201", 7.0), (DAY, 1, "XXX0001", 2.0), (DAY, 2, "XXX0001", None)],
        "trading_date date, trading_period int, node string, demand double")


@pytest.fixture(scope="module")
def meta(spark):
    return spark.createDataFrame(
        [("OTA2201", "Auckland", "North"), ("BEN2201", "Canterbury", "South"),
         ("TWC2201", None, "North"), ("HAY2201", "Wellington", "North")],
        "Node string, load_area string, island string")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_price_defaults_to_the_major_nodes(spark):
    prices = spark.createDataFrame(
        [(DAY, 1, "OTA2201", 0.0), (DAY, 1, "HLY2201", 50.0), (DAY, 1, "BEN2201", 60.0)],
        "trading_date date, trading_period int, node string, price double")
    assert query_nodal_price(prices, dates=DAY).count() == 2
    assert query_nodal_price(prices, dates=DAY, nodes="Core").count() == 3
    assert query_nodal_price(prices, dates=DAY, nodes=None, minimum_price=0).count() == 3
    assert query_nodal_price(prices, dates=DAY, nodes=None, minimum_price=1).count() == 2
    assert query_nodal_price(prices, dates=DAY, nodes="HLY2201").count() == 1
    assert query_nodal_price(prices, dates=DAY, maximum_price=0).count() == 1
    assert Market(spark, tables={"nodal_prices": prices}).query_nodal_price(dates=DAY).count() == 3


def test_demand_bounds(demand):
    # a bound of zero counts, and leaves zero demand out
    assert query_nodal_demand(demand, dates=DAY, minimum_demand=0).count() == 3
    assert query_nodal_demand(demand, dates=DAY, maximum_demand=0).count() == 2
    assert query_nodal_demand(demand, dates=DAY, excl_nodes="Wind").count() == 5
    assert query_nodal_demand(demand, dates=DAY, periods=2).count() == 2
    # iterators and ranges count as lists
    assert query_nodal_demand(demand, dates=iter([DAY]), periods=range(1, 3),
                              nodes=(n for n in ("OTA2201", "BEN2201"))).count() == 3


def test_meta_join_keeps_unknown_nodes_and_drops_empty_rows(demand, meta, rows):
    left = merge_meta(demand, meta, "demand")
    assert left.count() == 5 and left.columns[-3:] == ["meta_node", "load_area", "island"]
    assert left.where("meta_node IS NULL").select("node").first()[0] == "XXX0001"
    assert merge_meta(demand, meta, "demand", "inner").count() == 4
    # an inner join keeps empty rows of known nodes
    empty = demand.withColumn("demand", F.lit(None).cast("double"))
    assert merge_meta(empty, meta, "demand", "inner").count() == 4
    assert merge_meta(empty, meta, "demand").count() == 0
    # a name both sides have stays unambiguous
    both = merge_meta(demand.withColumn("island", F.lit("NI")), meta, "demand")
    assert {r["island"] for r in both.collect()} == {"NI"} and "meta_island" in both.columns
    with pytest.raises(ValueError):
        merge_meta(demand, meta.drop("Node"), "demand")
    with pytest.raises(ValueError):
        merge_meta(demand, meta, "demand", "outer")


def test_broadcast_goes_by_the_stored_size(spark, demand, meta):
    assert "BroadcastHashJoin" in plan(merge_meta(demand, meta, "demand"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    same = merge_meta(demand, meta, "demand")
    assert "BroadcastHashJoin" not in plan(same) and same.count() == 5
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_missing_days(spark, rows):
    held = spark.createDataFrame([("a", dt.date(2014, 1, 1)), ("a", dt.date(2014, 1, 3)), ("a", dt.date(2014, 1, 3)),
                                  ("b", dt.date(2013, 1, 1)), ("c", None)], "place string, trading_date date")
    got = rows(missing_days(held, ["place"], F.lit(dt.date(2014, 1, 1)), F.lit(dt.date(2014, 1, 3))))
    assert got == sorted([("a", dt.date(2014, 1, 2)), *[(p, dt.date(2014, 1, d)) for p in "bc" for d in (1, 2, 3)]], key=repr)


def test_grouped_demand(demand, meta, rows):
    def grouped(agg, group="island", **more):
        return query_nodal_demand(demand, dates=DAY, apply_meta=True, metadata=meta,
                                  meta_group=group, meta_agg=agg, **more)

    assert rows(grouped({"demand": "sum"})) == [("North", 2.0), ("South", 7.0)]
    assert rows(grouped("max").select("island", "demand")) == [("North", 5.0), ("South", 7.0)]
    both = grouped(["min", "max"])
    assert "demand_min" in both.columns and "trading_period_max" in both.columns
    assert rows(grouped({"demand": "median"})) == [("North", 0.0), ("South", 7.0)]
    assert rows(grouped([F.sum("demand").alias("mw")])) == [("North", 2.0), ("South", 7.0)]
    spread = grouped({"demand": lambda c: F.max(c) - F.min(c)})
    assert rows(spread) == [("North", 8.0), ("South", 0.0)]
    # null group keys drop out
    assert rows(grouped({"demand": "count"}, "load_area")) == [("Auckland", 2), ("Canterbury", 1)]


def test_grouping_errors(demand, meta):
    for bad in (dict(meta_group="island"), dict(meta_agg="sum"),
                dict(meta_group="island", meta_agg="sum")):
        with pytest.raises(ValueError):
            query_nodal_demand(demand, dates=DAY, metadata=meta, **bad)
    with pytest.raises(ValueError):
        query_nodal_demand(demand, dates=DAY, apply_meta=True)
    with pytest.raises(ValueError):
        group_by_meta(demand, "nowhere", "sum")
    with pytest.raises(ValueError):
        group_by_meta(demand, "node", "mode of the day")


def test_functions_of_series(spark, demand, rows):
    spread = aggregate_series(demand, ["node"], "demand", lambda s: s.max() - s.min(), "spread")
    assert ("OTA2201", 5.0) in rows(spread)

    def upper(values):
        return values.quantile(0.5)

    both = group_by_meta(demand, "node", {"demand": [pd.Series.sum, upper, "first", "last"]})
    assert both.columns == ["node", "demand_sum", "demand_upper", "demand_first", "demand_last"]
    assert {r["node"]: tuple(r)[1:] for r in both.collect()} == {
        "OTA2201": (5.0, 2.5, 5.0, 0.0), "TWC2201": (-3.0,) * 4, "BEN2201": (7.0,) * 4, "XXX0001": (2.0,) * 4}
    # a function of a column, next to one of a series
    mixed = group_by_meta(demand, "node", {"demand": [F.max, upper]})
    assert rows(mixed)[0] == ("BEN2201", 7.0, 7.0)


def test_offers(spark, rows):
    energy = spark.createDataFrame(
        [("MRPL", "HLY2201", "HLY", 1, DAY, 17, 10.0, 0.01, 20.0, 55.0, None, None),
         ("GENE", "HLY2201", "HLY", 2, DAY, 18, 30.0, 1.0, None, None, 5.0, 9.0)],
        "company string, grid_injection_point string, station string, unit int, "
        "trading_date date, trading_period int, band1_power double, band1_price double, "
        "band2_power double, band2_price double, band3_power double, band3_price double")
    market = Market(spark, tables={"energy_offers": energy})
    assert query_offer(energy, "Energy", dates=DAY, as_offerframe=False).count() == 2
    bands = query_offer(energy, "Energy", dates=DAY)
    assert rows(bands.select("company", "band", "power", "price")) == [
        ("GENE", 1, 30.0, 1.0), ("GENE", 3, 5.0, 9.0),
        ("MRPL", 1, 10.0, 0.01), ("MRPL", 2, 20.0, 55.0)]
    assert query_offer(energy, "Energy", dates=DAY, companies="MRPL").count() == 2
    assert query_offer(energy, "Energy", dates=DAY, begin_period=18, end_period=20).count() == 2
    assert market.query_offer("energy_offers", grid_points="HLY2201", dates=DAY,
                              stations=["HLY"]).count() == 4
    with pytest.raises(ValueError):
        query_offer(energy, "Solar", dates=DAY)
    with pytest.raises(ValueError):
        market.query_offer("nodal_prices", dates=DAY)
    with pytest.raises(ValueError):
        market.query_offer("ilreserves_offers", dates=DAY)


def test_reserve_offers(spark, rows):
    plsr = spark.createDataFrame(
        [("MRPL", "HLY2201", DAY, 1, 1.0, 10.0, 40.0, 2.0, 20.0)],
        "company string, grid_point string, trading_date date, trading_period int, "
        "band1_plsr_6s_price double, band1_plsr_6s_max double, band1_plsr_6s_percent double, "
        "band2_twdsr_60s_price double, band2_twdsr_60s_max double")
    bands = query_offer(plsr, "PLSR", dates=DAY, nodes=["HLY2201"])
    assert rows(bands.select("band", "product", "reserve_class", "power", "price", "percent")) == [
        (1, "PLSR", "6s", 10.0, 1.0, 40.0), (2, "TWDSR", "60s", 20.0, 2.0, None)]
    il = spark.createDataFrame(
        [("MRPL", "HLY2201", DAY, 1, 1.0, 10.0)],
        "company string, grid_exit_point string, trading_date date, trading_period int, "
        "band3_60s_price double, band3_60s_max double")
    assert rows(query_offer(il, "IL", dates=DAY).select("band", "product", "reserve_class")) == [
        (3, "IL", "60s")]


def test_stack_and_missing(spark, demand):
    assert stack([demand, demand]).count() == 12
    held = demand.where("node <> 'OTA2201'")
    assert missing_rows(demand, held, ["trading_date", "node"]).count() == 2
