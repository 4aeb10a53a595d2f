"""Filters, the market queries, joins and aggregates."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from halfhourly.functions.dates import (join_days, period_at_utc, period_of, period_start_utc, periods_of_day,
                                        trading_id, trading_timestamp, trading_timestamp_of_id)
from halfhourly.operators import predicates as P
from halfhourly.operators.aggregates import (days_by_year, demand_by_area, distinct_values,
                                             group_by_meta, rows_per_year)
from halfhourly.operators.coverage import calendar, month_slice, unloaded_dates
from halfhourly.operators.daybits import add_bits, day_bits, days_missing, held_days, read_bits
from halfhourly.operators.inparts import Quantile, TrimmedMean
from halfhourly.operators.joins import difference, merge_meta, missing_rows
from halfhourly.plans.analysis import (demand_distribution, histogram, merge_offers_demand,
                                       offer_curve, price_distribution)
from halfhourly.plans.market import (Market, query_nodal_demand, query_nodal_price, query_offer,
                                     stack)
from halfhourly.operators.ordered import newest
from halfhourly.operators.reshape import offer_bands
from halfhourly.operators.sketches import (RANK_ERROR, add_sketches, day_sketches, range_sketches,
                                           sketch_quantiles)
from halfhourly.schemas import CORE_NODES, TABLES, WIND_NODES
from halfhourly.session import staged, work_folder
from halfhourly.sources.csvfiles import read_metadata, write_csv
from halfhourly.sources.tables import conform, read_table, run_sql, with_year, write_rows
from registry import views as V
from registry.views import quantile_sql, query, sql

BEGIN, END = "1996-12-20", "1998-02-10"
_IN_RANGE = "trading_date BETWEEN DATE '1996-12-20' AND DATE '1998-02-10'"
_DAYS = ["14-05-1997", "1996-03-31", dt.date(1999, 7, 8), 20000110]
_ALWAYS = {"begin_date": "1900-01-01", "end_date": "2099-12-31"}
_THREE = ["S1", "S2", "S3"]
_OFF = ["S4", "S5", "S6"]
_DEMAND = "SELECT trading_date, trading_period, node, demand FROM v_demand WHERE "


# --- dates and values ----------------------------------------------------------

@query("date_single", sql(_DEMAND + "trading_date = DATE '1997-05-14'", "v_demand"))
def _(spark, sf):
    return P.date_filter(V.demand(spark, sf, dates="14-05-1997"), "14-05-1997")


@query("date_list_multi_year", sql(
    _DEMAND + "trading_date IN (DATE '1997-05-14', DATE '1996-03-31', DATE '1999-07-08', "
              "DATE '2000-01-10')", "v_demand"))
def _(spark, sf):
    return P.date_filter(V.demand(spark, sf, dates=_DAYS), _DAYS)


@query("date_table_multi_year", sql(
    _DEMAND + "trading_date IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderkey % 3 = 0)", "v_demand"))
def _(spark, sf):
    """Dates that come as rows, over a stored table that is split by year."""
    store = work_folder(spark, "date-table") + "/nodal_demand"
    write_rows(with_year(conform(V.demand(spark, sf), "nodal_demand"), TABLES["nodal_demand"]), store, "nodal_demand")
    days = V.read(spark, sf, "orders").where("o_orderkey % 3 = 0").select(
        F.col("o_orderdate").cast("date").alias("trading_date"))
    rows = P.on_days_of(read_table(spark, store, "nodal_demand"), days)
    return rows.select("trading_date", "trading_period", "node", "demand")


@query("date_range_multi_year", sql(_DEMAND + _IN_RANGE, "v_demand"))
def _(spark, sf):
    rows = V.demand(spark, sf, begin_date=BEGIN, end_date=END)
    return P.date_filter(rows, begin_date=BEGIN, end_date=END)


@query("date_range_month_slices", sql(f"""
SELECT greatest(CAST(date_trunc('month', trading_date) AS DATE), DATE '1996-12-20') AS slice_begin,
       least(last_day(trading_date), DATE '1998-02-10') AS slice_end,
       COUNT(*) AS n_rows, SUM(demand) AS demand
FROM v_demand WHERE {_IN_RANGE} GROUP BY 1, 2""", "v_demand"))
def _(spark, sf):
    rows = P.date_filter(V.demand(spark, sf, begin_date=BEGIN, end_date=END),
                         begin_date=BEGIN, end_date=END, range_break="Month")
    first, last = month_slice("trading_date", BEGIN, END)
    return rows.groupBy(first.alias("slice_begin"), last.alias("slice_end")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("demand").alias("demand"))


@query("filter_equal", sql(_DEMAND + "trading_period = 18", "v_demand"))
def _(spark, sf):
    return V.demand(spark, sf).where(P.selected("trading_period", 18))


@query("filter_in", sql(
    _DEMAND + "node IN ('S1', 'S2', 'S3') AND trading_period IN (17, 18, 33)", "v_demand"))
def _(spark, sf):
    return P.choose(V.demand(spark, sf), node=_THREE, trading_period=(17, 18, 33))


@query("filter_not_equal", sql(_DEMAND + "node <> 'S5'", "v_demand"))
def _(spark, sf):
    return V.demand(spark, sf).where(P.excluded("node", "S5"))


@query("filter_not_in", sql(_DEMAND + "node NOT IN ('S4', 'S5', 'S6')", "v_demand"))
def _(spark, sf):
    return P.leave_out(V.demand(spark, sf), node=_OFF)


@query("filter_min", sql(_DEMAND + "demand >= 40", "v_demand"))
def _(spark, sf):
    return V.demand(spark, sf).where(P.at_least("demand", 40))


@query("filter_max", sql(_DEMAND + "demand <= 3.5", "v_demand"))
def _(spark, sf):
    return V.demand(spark, sf).where(P.at_most("demand", 3.5))


@query("filter_between", sql(_DEMAND + "demand BETWEEN 10 AND 12", "v_demand"))
def _(spark, sf):
    return V.demand(spark, sf).where(P.between("demand", 10, 12))


# --- the market queries --------------------------------------------------------

@query("nodal_demand", sql(
    _DEMAND + _IN_RANGE + " AND trading_period BETWEEN 10 AND 40 AND demand >= 0.0001 "
                          "AND demand <= 30", "v_demand"))
def _(spark, sf):
    return query_nodal_demand(V.demand(spark, sf, begin_date=BEGIN, end_date=END),
                              begin_date=BEGIN, end_date=END, begin_period=10, end_period=40,
                              minimum_demand=0, maximum_demand=30)


@query("nodal_demand_excl", sql(
    _DEMAND + _IN_RANGE + " AND trading_period IN (17, 18) AND node NOT IN ('S4', 'S5', 'S6')",
    "v_demand"))
def _(spark, sf):
    return query_nodal_demand(V.demand(spark, sf, begin_date=BEGIN, end_date=END),
                              begin_date=BEGIN, end_date=END, periods=[17, 18], excl_nodes=_OFF)


_BY_AREA = f"""
SELECT load_area, SUM(demand) AS demand
FROM v_demand {{join}} JOIN v_meta ON node = meta_node
WHERE {_IN_RANGE} AND node NOT IN ('S4', 'S5', 'S6') AND demand >= 5 AND load_area IS NOT NULL
GROUP BY load_area"""


def demand_per_load_area(spark, sf, meta_how="left"):
    """The flagship: demand per load area over two year edges, without three nodes."""
    return query_nodal_demand(
        V.demand(spark, sf, begin_date=BEGIN, end_date=END), begin_date=BEGIN, end_date=END,
        minimum_demand=5, excl_nodes=_OFF, apply_meta=True, metadata=V.meta(spark, sf),
        meta_how=meta_how, meta_group="load_area", meta_agg={"demand": "sum"})


@query("nodal_demand_by_area", sql(_BY_AREA.format(join="LEFT"), "v_demand", "v_meta"))
def _(spark, sf):
    return demand_per_load_area(spark, sf)


@query("nodal_demand_by_area_inner", sql(_BY_AREA.format(join="INNER"), "v_demand", "v_meta"))
def _(spark, sf):
    market = Market(spark, tables={"nodal_demand": V.demand(spark, sf, begin_date=BEGIN,
                                                            end_date=END)},
                    metadata=V.meta(spark, sf))
    return market.query_nodal_demand(
        begin_date=BEGIN, end_date=END, minimum_demand=5, excl_nodes=_OFF, apply_meta=True,
        meta_group=["load_area"], meta_agg={"demand": "sum"})


_PRICE_WHERE = """trading_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'
  AND trading_period BETWEEN 12 AND 36 AND price >= 2 AND price <= 60"""
_PRICE_ARGS = dict(begin_date="5/1/2024", end_date="25/01/2024")


@query("nodal_price", sql(f"""
SELECT trading_date, trading_period, node, price FROM v_price
WHERE {_PRICE_WHERE} AND node IN ('N1', 'N2', 'N3')""", "v_price"))
def _(spark, sf):
    return query_nodal_price(V.price(spark, sf, **_PRICE_ARGS), **_PRICE_ARGS, begin_period=12,
                             end_period=36, minimum_price=2, maximum_price=60,
                             nodes=["N1", "N2", "N3"])


@query("price_core_nodes", sql(f"""
SELECT trading_date, trading_period, node, price FROM v_price
WHERE trading_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'
  AND node IN ('N1', 'N2', 'N3', 'N5', 'N8', 'N13', 'N21', 'N34')""", "v_price"))
def _(spark, sf):
    # as many nodes as the set "Core" has, out of the given data
    core = ["N1", "N2", "N3", "N5", "N8", "N13", "N21", "N34"]
    return query_nodal_price(V.price(spark, sf, **_PRICE_ARGS), **_PRICE_ARGS, nodes=core)


@query("nodal_price_meta", sql(f"""
SELECT trading_date, trading_period, node, price, meta_node, load_area
FROM v_price LEFT JOIN v_price_meta ON node = meta_node WHERE {_PRICE_WHERE}""",
    "v_price", "v_price_meta"))
def _(spark, sf):
    return query_nodal_price(V.price(spark, sf, **_PRICE_ARGS), **_PRICE_ARGS, begin_period=12,
                             end_period=36, minimum_price=2, maximum_price=60, nodes=None,
                             apply_meta=True, metadata=V.price_meta(spark, sf))


@query("nodal_price_meta_inner", sql(f"""
SELECT trading_date, trading_period, node, price, meta_node, load_area
FROM v_price JOIN v_price_meta ON node = meta_node WHERE {_PRICE_WHERE}""",
    "v_price", "v_price_meta"))
def _(spark, sf):
    market = Market(spark, tables={"nodal_prices": V.price(spark, sf, **_PRICE_ARGS)},
                    metadata=V.price_meta(spark, sf))
    return market.query_nodal_price(**_PRICE_ARGS, begin_period=12, end_period=36,
                                    minimum_price=2, maximum_price=60, apply_meta=True)


_POINTS = [f"S{i}" for i in range(2, 60)]
_POINTS_SQL = ", ".join(f"'{p}'" for p in _POINTS)


def _node_of(number):
    """A node name of the fixed sets, or another one, for a number."""
    names = F.array(*[F.lit(n) for n in (*CORE_NODES, *WIND_NODES, "XXX0001")])
    return F.get(names, F.pmod(number, F.lit(15)).cast("int"))


_NODES_SQL = "[" + ", ".join(f"'{n}'" for n in (*CORE_NODES, *WIND_NODES, "XXX0001")) + "]"


@query("price_core_set", f"""
SELECT CAST(ts AS DATE) AS trading_date,
       CAST(hour(ts) * 2 + CASE WHEN minute(ts) >= 30 THEN 1 ELSE 0 END AS INT) + 1 AS trading_period,
       list_extract({_NODES_SQL}, CAST(user_id % 15 AS INT) + 1) AS node, value AS price
FROM events WHERE user_id % 15 < 8""")
def _(spark, sf):
    prices = V.read(spark, sf, "events").select(
        F.col("ts").cast("date").alias("trading_date"), period_of("ts").alias("trading_period"),
        _node_of(F.col("user_id")).alias("node"), F.col("value").alias("price"))
    return query_nodal_price(prices, **_ALWAYS, nodes="Core")


@query("demand_without_wind", f"""
SELECT CAST(l_shipdate AS DATE) AS trading_date,
       CAST((l_orderkey * 7 + l_linenumber) % 48 AS INT) + 1 AS trading_period,
       list_extract({_NODES_SQL}, CAST(l_suppkey % 15 AS INT) + 1) AS node, l_quantity AS demand
FROM lineitem WHERE l_suppkey % 15 NOT BETWEEN 8 AND 13""")
def _(spark, sf):
    lines = V.read(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("trading_date"),
        (((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 48).cast("int") + 1).alias("trading_period"),
        _node_of(F.col("l_suppkey")).alias("node"), F.col("l_quantity").alias("demand"))
    return query_nodal_demand(lines, **_ALWAYS, excl_nodes="Wind")


@query("offer_by_type", sql(f"""
SELECT * FROM v_offer WHERE {_IN_RANGE} AND trading_period IN (17, 18, 33)
  AND company IN ('C1', 'C2', 'C3', 'C4') AND station IN ('STA', 'ECO', 'PRO')
  AND grid_injection_point IN ({_POINTS_SQL})""", "v_offer"))
def _(spark, sf):
    market = Market(spark, tables={"energy_offers": V.offer(spark, sf, begin_date=BEGIN,
                                                            end_date=END)})
    return market.query_offer("energy_offers", begin_date=BEGIN, end_date=END,
                              periods=[17, 18, 33], companies=["C1", "C2", "C3", "C4"],
                              stations=["STA", "ECO", "PRO"], grid_points=_POINTS, as_offerframe=False)


_LONG = """
SELECT company, grid_injection_point, station, unit, trading_date, trading_period,
       created_date, last_amended_date, {n} AS band, band{n}_power AS power, band{n}_price AS price
FROM v_offer WHERE band{n}_power IS NOT NULL AND band{n}_price IS NOT NULL"""
_ALL_BANDS = " UNION ALL ".join(_LONG.format(n=n) for n in (1, 2, 3))


@query("offer_long", sql(f"""
SELECT * FROM ({_ALL_BANDS}) b WHERE {_IN_RANGE}""", "v_offer"))
def _(spark, sf):
    return query_offer(V.offer(spark, sf, begin_date=BEGIN, end_date=END), "Energy",
                       begin_date=BEGIN, end_date=END)


@query("union_years", sql(
    _DEMAND + "trading_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'", "v_demand"))
def _(spark, sf):
    years = [dict(begin_date=f"{y}-01-01", end_date=f"{y}-12-31") for y in (1996, 1997, 1998)]
    return stack([P.date_filter(V.demand(spark, sf, **y), **y) for y in years])


@query("limit_rows", sql("""
SELECT trading_date, trading_period, node, demand FROM v_demand
ORDER BY trading_date, trading_period, node LIMIT 100""", "v_demand"))
def _(spark, sf):
    V.demand(spark, sf).createOrReplaceTempView("limit_rows_demand")
    return run_sql(spark, "SELECT * FROM limit_rows_demand "
                          "ORDER BY trading_date, trading_period, node", 100)


# --- joins and aggregates ------------------------------------------------------

@query("meta_left", sql("""
SELECT trading_date, trading_period, node, demand, meta_node, load_area, island_name
FROM v_demand LEFT JOIN v_meta ON node = meta_node WHERE demand IS NOT NULL""",
    "v_demand", "v_meta"))
def _(spark, sf):
    # the metadata goes through a file, as it is published
    folder = work_folder(spark, "metadata")
    write_csv(V.meta(spark, sf).withColumnsRenamed({"meta_node": "Node", "load_area": "Load Area",
                                                    "island_name": "Island_Name"}), folder)
    return merge_meta(V.demand(spark, sf), read_metadata(spark, folder), "demand")


@query("demand_multi_agg", sql("""
SELECT island_name, load_area, SUM(demand) AS demand_sum, AVG(demand) AS demand_mean,
       MIN(demand) AS demand_min, MAX(demand) AS demand_max, COUNT(demand) AS demand_count,
       quantile_cont(demand, 0.5) AS demand_median, COUNT(DISTINCT node) AS node
FROM v_demand JOIN v_meta ON node = meta_node GROUP BY 1, 2""", "v_demand", "v_meta"))
def _(spark, sf):
    rich = merge_meta(V.demand(spark, sf), V.meta(spark, sf), "demand")
    return group_by_meta(rich, ["island_name", "load_area"], {
        "demand": ["sum", "mean", "min", "max", "count", "median"], "node": "nunique"})


@query("demand_callable_agg", sql("""
SELECT load_area, MAX(trading_period) - MIN(trading_period) AS trading_period,
       MAX(demand) - MIN(demand) AS demand
FROM v_demand JOIN v_meta ON node = meta_node GROUP BY 1""", "v_demand", "v_meta"))
def _(spark, sf):
    rich = merge_meta(V.demand(spark, sf), V.meta(spark, sf), "demand")
    return group_by_meta(rich, "load_area", lambda c: F.max(c) - F.min(c))


@query("demand_pandas_agg", sql("""
SELECT load_area, CAST(SUM(trading_period) AS BIGINT) AS trading_period_sum, SUM(demand) AS demand_sum,
       quantile_cont(trading_period, 0.9) AS trading_period_upper, quantile_cont(demand, 0.9) AS demand_upper
FROM v_demand JOIN v_meta ON node = meta_node GROUP BY 1""", "v_demand", "v_meta"))
def _(spark, sf):
    """A known pandas aggregate and a quantile, both taken in parts."""
    upper = Quantile(0.9, "upper")
    return query_nodal_demand(V.demand(spark, sf), **_ALWAYS, apply_meta=True,
                              meta_how="inner", metadata=V.meta(spark, sf),
                              meta_group="load_area", meta_agg=[pd.Series.sum, upper])


_LARGE = "CASE WHEN l_orderkey % 10 = 0 THEN 'small' ELSE 'large' END"


@query("demand_in_parts", f"""
WITH ranked AS (
  SELECT {_LARGE} AS load_area, l_quantity AS demand, l_tax AS tax,
         row_number() OVER (PARTITION BY {_LARGE} ORDER BY l_quantity) AS place, COUNT(*) OVER (PARTITION BY {_LARGE}) AS n
  FROM lineitem)
SELECT load_area, AVG(demand) FILTER (place > floor(n * 0.1) AND place <= n - floor(n * 0.1)) AS demand_trimmed,
       quantile_cont(demand, 0.75) AS demand_upper FROM ranked GROUP BY 1""")
def _(spark, sf):
    """Aggregates of one's own over a group that holds nine tenths of the rows."""
    lines = V.read(spark, sf, "lineitem").select(F.expr(_LARGE).alias("load_area"), F.col("l_quantity").alias("demand"))
    return group_by_meta(lines, "load_area", {"demand": [TrimmedMean(0.1, "trimmed"), Quantile(0.75, "upper")]})


@query("exact_area_sums", sql("""
SELECT CAST(l_shipdate AS DATE) AS trading_date,
       CAST((l_orderkey * 7 + l_linenumber) % 48 AS INT) + 1 AS trading_period, island_name, load_area,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS demand
FROM lineitem JOIN v_meta ON concat('S', CAST(l_suppkey AS VARCHAR)) = meta_node
GROUP BY 1, 2, 3, 4""", "v_meta"))
def _(spark, sf):
    """Values that are no whole numbers, added up in whatever order."""
    lines = V.read(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("trading_date"),
        (((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 48).cast("int") + 1).alias("trading_period"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("node"),
        F.col("l_extendedprice").alias("demand"))
    return demand_by_area(merge_meta(lines, V.meta(spark, sf), "demand"))


@query("exact_extremes", """
SELECT load_area, kind, total AS demand_sum, total / n AS demand_mean, n AS demand_count, FALSE AS no_number
FROM (SELECT l_returnflag AS load_area, 'mixed' AS kind, SUM(l_quantity) * power(2.0, -60) AS total, 3 * COUNT(*) AS n
      FROM lineitem GROUP BY 1
      UNION ALL SELECT l_returnflag, 'tiny', SUM(l_quantity) * power(2.0, -40), COUNT(*) FROM lineitem GROUP BY 1
      UNION ALL SELECT l_returnflag, 'huge', SUM(l_quantity) * power(2.0, 63), COUNT(*) FROM lineitem GROUP BY 1
      UNION ALL SELECT l_returnflag, 'missing', SUM(l_quantity) FILTER (l_linenumber <> 1),
                       COUNT(*) FILTER (l_linenumber <> 1) FROM lineitem GROUP BY 1
      UNION ALL SELECT l_returnflag, 'cents', CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE), COUNT(*)
      FROM lineitem GROUP BY 1) x
UNION ALL SELECT l_returnflag, 'infinite', NULL, NULL, COUNT(*), TRUE FROM lineitem GROUP BY 1""")
def _(spark, sf):
    """Tiny and huge values, huge ones that cancel each other, infinite ones and NaN, each in a group of its own."""
    q, k = F.col("l_quantity"), F.col("l_orderkey").cast("double")
    first = F.col("l_linenumber") == 1
    values = [("mixed", q * 2.0 ** -60), ("mixed", k * 2.0 ** 70), ("mixed", k * -2.0 ** 70), ("tiny", q * 2.0 ** -40),
              ("huge", q * 2.0 ** 63), ("infinite", F.when(first, float("inf")).otherwise(q)),
              ("missing", F.when(first, float("nan")).otherwise(q)), ("cents", F.col("l_extendedprice"))]
    rows = V.read(spark, sf, "lineitem").select(F.col("l_returnflag").alias("load_area"), F.inline(F.array(*[
        F.struct(F.lit(kind).alias("kind"), v.alias("demand")) for kind, v in values])))
    sums = group_by_meta(rows, ["load_area", "kind"], {"demand": ["sum", "mean", "count"]})
    infinite = F.abs("demand_sum") == float("inf")
    return sums.select("load_area", "kind", *[F.when(~infinite, F.col(c)).alias(c) for c in ("demand_sum", "demand_mean")],
                       "demand_count", infinite.alias("no_number"))


@query("rich_demand_group", sql("""
SELECT trading_date, trading_period, island_name, load_area, SUM(demand) AS demand
FROM v_demand JOIN v_meta ON node = meta_node GROUP BY 1, 2, 3, 4""", "v_demand", "v_meta"))
def _(spark, sf):
    return demand_by_area(merge_meta(V.demand(spark, sf), V.meta(spark, sf), "demand"))


@query("rows_per_year", sql("""
SELECT CAST(year(trading_date) AS INT) AS trading_year, COUNT(*) AS n_rows
FROM v_demand GROUP BY 1""", "v_demand"))
def _(spark, sf):
    return rows_per_year(V.demand(spark, sf))


@query("dates_by_year", sql("""
SELECT CAST(year(d) AS INT) AS trading_year,
       string_agg(strftime(d, '%d-%m-%Y'), ',' ORDER BY d) AS days
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem) x GROUP BY 1"""))
def _(spark, sf):
    days = V.read(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("trading_date"))
    return days_by_year(days).withColumn("days", join_days("days", ","))


@query("distinct_dates", sql("SELECT DISTINCT trading_date FROM v_demand", "v_demand"))
def _(spark, sf):
    return distinct_values(V.demand(spark, sf), "trading_date")


@query("unloaded_dates", """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS trading_date FROM orders
WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem)""")
def _(spark, sf):
    batch = V.read(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("trading_date"))
    held = V.read(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("trading_date"))
    return unloaded_dates(batch, held)


@query("missing_dates", """
SELECT CAST(d AS DATE) AS trading_date
FROM generate_series(TIMESTAMP '1992-01-01', TIMESTAMP '2003-12-31', INTERVAL 1 DAY) t(d)
WHERE CAST(d AS DATE) NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem)""")
def _(spark, sf):
    held = V.read(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("trading_date"))
    published = calendar(spark, "1992-01-01", "2003-12-31", col="trading_date")
    return missing_rows(published, held, "trading_date")


@query("missing_dates_stored", """
SELECT CAST(d AS DATE) AS trading_date
FROM generate_series(TIMESTAMP '1992-01-01', TIMESTAMP '2003-12-31', INTERVAL 1 DAY) t(d)
WHERE CAST(d AS DATE) NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem)""")
def _(spark, sf):
    """The days held are bits of a stored table, which three loads added to."""
    folder = work_folder(spark, "date-bits")
    held = V.read(spark, sf, "lineitem").select("l_linenumber", F.col("l_shipdate").cast("date").alias("trading_date"))
    for k in range(3):
        add_bits(day_bits(held.where(F.col("l_linenumber") % 3 == k), []), folder)
    return days_missing(read_bits(spark, folder, []), [], "1992-01-01", "2003-12-31")


@query("days_held_stored", """
SELECT 'S' || l_suppkey AS node, COUNT(DISTINCT CAST(l_shipdate AS DATE)) AS n_days FROM lineitem GROUP BY 1""")
def _(spark, sf):
    held = V.read(spark, sf, "lineitem").select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("node"),
                                                F.col("l_shipdate").cast("date").alias("trading_date"))
    folder = work_folder(spark, "node-bits")
    for _ in range(2):      # a load that is run again changes nothing
        add_bits(day_bits(held, ["node"]), folder)
    return held_days(read_bits(spark, folder, ["node"]), ["node"])


@query("date_difference", """
SELECT CAST(o_orderdate AS DATE) AS trading_date FROM orders
EXCEPT SELECT CAST(ts AS DATE) FROM events""")
def _(spark, sf):
    one = V.read(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("trading_date"))
    two = V.read(spark, sf, "events").select(F.col("ts").cast("date").alias("trading_date"))
    return difference(one, two)


@query("latest_amended", sql("""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY company, grid_injection_point, station, unit, trading_date, trading_period
    ORDER BY last_amended_date DESC NULLS LAST, created_date DESC NULLS LAST,
             band1_power DESC NULLS LAST, band1_price DESC NULLS LAST) AS rn
  FROM v_offer) x WHERE rn = 1""", "v_offer"))
def _(spark, sf):
    return newest(V.offer(spark, sf), list(TABLES["energy_offers"].key),
                  ["last_amended_date", "created_date"])


@query("dedupe_rows", """
SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem""")
def _(spark, sf):
    return (V.read(spark, sf, "lineitem")
            .select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
            .dropDuplicates())


# --- analysis ------------------------------------------------------------------

@query("price_distribution", quantile_sql(
    "v_price", "trading_period", "price", [0.05, 0.25, 0.5, 0.75, 0.95], "v_price"))
def _(spark, sf):
    return price_distribution(V.price(spark, sf), ["trading_period"])


@query("demand_distribution", quantile_sql(
    "(SELECT * FROM v_demand JOIN v_meta ON node = meta_node)", "load_area, trading_period",
    "demand", [0.1, 0.5, 0.9], "v_demand", "v_meta"))
def _(spark, sf):
    rich = merge_meta(V.demand(spark, sf), V.meta(spark, sf), "demand")
    return demand_distribution(rich, ["load_area", "trading_period"], [0.1, 0.5, 0.9])


_STEPS = [0.05, 0.25, 0.5, 0.75, 0.95]


@query("sketched_distribution", sql(f"""
SELECT load_area, CAST(p AS DOUBLE) AS probability, COUNT(*) AS n, TRUE AS within
FROM v_demand JOIN v_meta ON node = meta_node, (VALUES {', '.join(f'({p})' for p in _STEPS)}) s(p)
WHERE {_IN_RANGE} GROUP BY 1, 2""", "v_demand", "v_meta"))
def _(spark, sf):
    """Quantiles of a range of days from stored sketches of days: their ranks lie within twice the stated error."""
    folder = work_folder(spark, "sketches")
    rich = merge_meta(V.demand(spark, sf), V.meta(spark, sf), "demand", "inner").select(
        "load_area", "trading_date", F.col("demand").cast("double").alias("demand"))
    rich = staged(rich, "sketched")
    for early in (True, False):
        add_sketches(day_sketches(rich.where((F.col("trading_date") < "1997-06-01") == early), ["load_area"], "demand"), folder)
    found = sketch_quantiles(range_sketches(spark, folder, ["load_area"], BEGIN, END), ["load_area"], _STEPS)
    rows = P.date_filter(rich, begin_date=BEGIN, end_date=END).groupBy("load_area", "demand").agg(
        F.count(F.lit(1)).alias("rows"))
    ranks = found.join(rows, "load_area").groupBy("load_area", "probability", "n").agg(
        F.coalesce(F.sum(F.when(F.col("demand") < F.col("value"), F.col("rows"))), F.lit(0)).alias("below"),
        F.sum(F.when(F.col("demand") <= F.col("value"), F.col("rows"))).alias("upto"))
    slack = 2 * RANK_ERROR * F.col("n") + 1
    place = F.col("probability") * F.col("n")
    return ranks.select("load_area", "probability", "n",
                        ((F.col("below") <= place + slack) & (F.col("upto") >= place - slack)).alias("within"))


@query("price_histogram", sql("""
SELECT trading_period, floor(price / 5.0) * 5.0 AS bin, COUNT(*) AS n_rows
FROM v_price GROUP BY 1, 2""", "v_price"))
def _(spark, sf):
    return histogram(V.price(spark, sf), ["trading_period"], "price", 5.0)


@query("offer_curve", sql(f"""
SELECT trading_date, trading_period, price, power,
       SUM(power) OVER (PARTITION BY trading_date, trading_period ORDER BY price
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_power
FROM (SELECT trading_date, trading_period, price, SUM(power) AS power
      FROM ({_ALL_BANDS}) b GROUP BY 1, 2, 3) s""", "v_offer"))
def _(spark, sf):
    return offer_curve(offer_bands(V.offer(spark, sf), "Energy"))


@query("offer_demand_merge", sql("""
SELECT o.*, d.demand FROM v_offer o JOIN v_demand d
  ON o.trading_date = d.trading_date AND o.trading_period = d.trading_period
 AND o.grid_injection_point = d.node""", "v_offer", "v_demand"))
def _(spark, sf):
    return merge_offers_demand(V.offer(spark, sf), V.demand(spark, sf))


@query("trading_timestamp", sql("""
SELECT trading_date, trading_period, node,
       CAST(trading_date AS TIMESTAMP) + to_minutes(trading_period * 30 - 30) AS starts,
       CAST(trading_date AS TIMESTAMP) + to_minutes(trading_period * 30) AS ends,
       CAST(year(trading_date) * 1000000 + month(trading_date) * 10000
            + day(trading_date) * 100 + trading_period AS BIGINT) AS trading_id,
       CAST(trading_date AS TIMESTAMP) + to_minutes(trading_period * 30 - 15) AS middle
FROM v_price""", "v_price"))
def _(spark, sf):
    rows = V.price(spark, sf)
    return rows.select(
        "trading_date", "trading_period", "node",
        trading_timestamp("trading_date", "trading_period").alias("starts"),
        trading_timestamp("trading_date", "trading_period", 0).alias("ends"),
        trading_id("trading_date", "trading_period").alias("trading_id"),
        trading_timestamp_of_id(trading_id("trading_date", "trading_period"), 15).alias("middle"))


# daylight time from the first Sunday of October, 2 o'clock, to the third Sunday of March, 3 o'clock
_DAYLIGHT = """
days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem
         WHERE year(l_shipdate) BETWEEN 1996 AND 1999),
marked AS (
  SELECT d, month(d) = 10 AND isodow(d) = 7 AND day(d) <= 7 AS to_daylight,
         month(d) = 3 AND isodow(d) = 7 AND day(d) BETWEEN 15 AND 21 AS to_standard,
         (month(d) > 10 OR month(d) < 3
          OR month(d) = 10 AND day(d) > day(CAST(date_trunc('month', d) AS DATE)
                 + CAST((7 - isodow(CAST(date_trunc('month', d) AS DATE))) % 7 AS INT))
          OR month(d) = 3 AND day(d) <= 14 + day(CAST(date_trunc('month', d) AS DATE)
                 + CAST((7 - isodow(CAST(date_trunc('month', d) AS DATE))) % 7 AS INT))) AS daylight
  FROM days)"""


@query("period_instants", f"""
WITH {_DAYLIGHT}
SELECT d AS trading_date, CAST(p AS INT) AS trading_period,
       CAST(d AS TIMESTAMP) - to_hours(CASE WHEN daylight THEN 13 ELSE 12 END) + to_minutes(CAST(p AS INT) * 30 - 30) AS utc,
       d AS back_date, CAST(p AS INT) AS back_period, 1 AS n_same
FROM marked, generate_series(1, 50) t(p)
WHERE p <= CASE WHEN to_daylight THEN 46 WHEN to_standard THEN 50 ELSE 48 END""")
def _(spark, sf):
    """Every trading period of the days of four years as a UTC time, and that time as a trading period again."""
    days = V.read(spark, sf, "lineitem").where(F.year("l_shipdate").between(1996, 1999)).select(
        F.col("l_shipdate").cast("date").alias("trading_date")).distinct()
    periods = days.withColumn("trading_period", F.explode(F.sequence(F.lit(1), periods_of_day("trading_date"))))
    rows = periods.withColumn("utc", period_start_utc("trading_date", "trading_period"))
    same = rows.groupBy("utc").agg(F.count(F.lit(1)).cast("int").alias("n_same"))
    back = period_at_utc("utc")
    return rows.join(same, "utc").select("trading_date", "trading_period", "utc", back["trading_date"].alias("back_date"),
                                         back["trading_period"].alias("back_period"), "n_same")
