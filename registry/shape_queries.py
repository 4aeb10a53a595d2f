"""Reshaping, ordered operators, lake and futures series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from halfhourly.functions.dates import expiry_label
from halfhourly.functions.text import first_word
from halfhourly.operators.aggregates import span
from halfhourly.operators.ordered import carry_down
from halfhourly.operators.reshape import (expiries_of, half_hour_to_long, quarters, quotes_to_columns,
                                           wind_to_long)
from halfhourly.plans.futures import (append_new_quotes, append_wide_quotes, last_day_held, product_info,
                                      read_wide_quotes, weekdays_to_fetch)
from halfhourly.plans.hydro import (lake_matrix, shift_to_day_before, storage_by_day_of_year,
                                    year_of_series)
from halfhourly.plans.market import query_offer
from halfhourly.schemas import FUTURES_PRODUCTS, TABLES
from halfhourly.session import staged, work_folder
from registry import views as V
from registry.views import quantile_sql, query, sql

# --- reserve offers ------------------------------------------------------------

_RESERVE_IDS = """'C' || CAST(l_suppkey % 25 AS VARCHAR) AS company,
       'S' || CAST(l_suppkey AS VARCHAR) AS {node}, CAST(l_shipdate AS DATE) AS trading_date,
       CAST((l_orderkey * 7 + l_linenumber) % 48 AS INT) + 1 AS trading_period"""


def _reserve(spark, sf, node, **bands):
    """Lines as reserve offers, one column per given band."""
    return V.read(spark, sf, "lineitem").select(
        F.concat(F.lit("C"), (F.col("l_suppkey") % 25).cast("string")).alias("company"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias(node),
        F.col("l_shipdate").cast("date").alias("trading_date"),
        (((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 48).cast("int") + 1)
        .alias("trading_period"),
        *[F.expr(e).alias(c) for c, e in bands.items()])


def _reserve_sql(node, *bands):
    parts = [f"SELECT {_RESERVE_IDS.format(node=node)}, {band} AS band, '{product}' AS product, "
             f"'{speed}' AS reserve_class, {power} AS power, {price} AS price{extra} FROM lineitem "
             f"WHERE {where}" for band, product, speed, power, price, extra, where in bands]
    return " UNION ALL ".join(parts)


@query("reserve_offer_long", _reserve_sql(
    "grid_point",
    (1, "PLSR", "6s", "l_quantity", "l_extendedprice", ", l_discount AS percent", "TRUE"),
    (1, "TWDSR", "60s", "l_quantity * 2", "l_extendedprice", ", CAST(NULL AS DOUBLE) AS percent", "TRUE"),
    (3, "PLSR", "60s", "l_quantity", "l_tax", ", l_discount AS percent", "l_linenumber > 3")))
def _(spark, sf):
    offers = _reserve(
        spark, sf, "grid_point",
        band1_plsr_6s_price="l_extendedprice", band1_plsr_6s_max="l_quantity",
        band1_plsr_6s_percent="l_discount",
        band1_twdsr_60s_price="l_extendedprice", band1_twdsr_60s_max="l_quantity * 2",
        band3_plsr_60s_price="l_tax", band3_plsr_60s_percent="l_discount",
        band3_plsr_60s_max="CASE WHEN l_linenumber > 3 THEN l_quantity END")
    return query_offer(offers, "PLSR", begin_date="1990-01-01", end_date="2010-12-31")


@query("il_offer_long", _reserve_sql(
    "grid_exit_point",
    (1, "IL", "6s", "l_quantity", "l_extendedprice", "", "TRUE"),
    (2, "IL", "60s", "l_quantity", "l_tax", "", "l_linenumber > 3")))
def _(spark, sf):
    offers = _reserve(spark, sf, "grid_exit_point", band1_6s_price="l_extendedprice",
                      band1_6s_max="l_quantity", band2_60s_max="l_quantity",
                      band2_60s_price="CASE WHEN l_linenumber > 3 THEN l_tax END")
    return query_offer(offers, "IL", begin_date="1990-01-01", end_date="2010-12-31")


# --- lakes ---------------------------------------------------------------------

_LAKES = ["AF", "AO", "NF", "NO", "RF", "RO"]


@query("exact_half_hours", """
SELECT 'S' || l_suppkey AS "Grid_Point", CAST(l_shipdate AS DATE) AS "Trading_Date", 'MW' AS "Unit_Measure",
       CAST(l_linenumber AS INT) AS "Trading_Period",
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) * 0.002 AS "Average_Output"
FROM lineitem GROUP BY 1, 2, 4""")
def _(spark, sf):
    """Several wide rows per id, whose values are no whole numbers."""
    at = F.col("l_linenumber")
    wide = V.read(spark, sf, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("poc"),
        F.col("l_shipdate").cast("date").alias("trading_date"),
        *[F.when(at == k, F.col("l_extendedprice")).alias(f"TP{k}") for k in range(1, 51)])
    return half_hour_to_long(wide)


@query("unpivot_halfhour", sql("""
SELECT poc AS "Grid_Point", nwk_code AS "Distribution_Network", trading_date AS "Trading_Date",
       'MW' AS "Unit_Measure", trading_period AS "Trading_Period",
       kwh * CAST(0.002 AS DOUBLE) AS "Average_Output"
FROM v_halfhour""", "v_halfhour"))
def _(spark, sf):
    return half_hour_to_long(V.wide(spark, sf))


_STATIONS = [c for c in TABLES["scada_wind_data"].names if c != "stamp"]
_STATION_CASE = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_STATIONS))


@query("unpivot_stations", f"""
SELECT date_trunc('hour', ts) AS stamp, CASE user_id % 10 {_STATION_CASE} END AS station,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS mw
FROM events GROUP BY 1, 2""")
def _(spark, sf):
    return wind_to_long(V.stations(spark, sf))


@query("lake_wide", sql("""
SELECT trading_date, """ + ", ".join(
    f"MAX(CASE WHEN lake = '{n}' THEN lake_levels END) AS \"{n}\"" for n in _LAKES) + """
FROM v_storage GROUP BY 1""", "v_storage"))
def _(spark, sf):
    return lake_matrix(V.storage(spark, sf), _LAKES)


@query("lake_shift", sql("""
SELECT lake, trading_date, next_level AS lake_levels FROM (
  SELECT lake, trading_date,
         lead(lake_levels) OVER (PARTITION BY lake ORDER BY trading_date) AS next_level,
         row_number() OVER (PARTITION BY lake ORDER BY trading_date DESC) AS from_end
  FROM v_storage) x WHERE from_end > 1""", "v_storage"))
def _(spark, sf):
    return shift_to_day_before(V.storage(spark, sf))


@query("lake_year", sql("""
SELECT lake, trading_date, lake_levels FROM v_storage WHERE year(trading_date) = 1998""",
    "v_storage"))
def _(spark, sf):
    return year_of_series(V.storage(spark, sf), 1998)


@query("series_span", sql("""
SELECT lake, MIN(trading_date) AS first_day, MAX(trading_date) AS last_day,
       concat_ws('_', lake, 'Lake_Levels', strftime(MIN(trading_date), '%Y%m%d'),
                 strftime(MAX(trading_date), '%Y%m%d')) || '.csv' AS file_name
FROM v_storage GROUP BY 1""", "v_storage"))
def _(spark, sf):
    spans = span(V.storage(spark, sf), ["lake"])
    name = F.concat_ws("_", "lake", F.lit("Lake Levels"), F.date_format("first_day", "yyyyMMdd"),
                       F.date_format("last_day", "yyyyMMdd"))
    return spans.withColumn("file_name", F.concat(F.replace(name, F.lit(" "), F.lit("_")),
                                                  F.lit(".csv")))


@query("storage_by_day_of_year", quantile_sql(
    "(SELECT lake, CAST(dayofyear(trading_date) AS INT) AS day_of_year, lake_levels "
    "FROM v_storage)", "lake, day_of_year", "lake_levels", [0.1, 0.5, 0.9], "v_storage"))
def _(spark, sf):
    return storage_by_day_of_year(V.storage(spark, sf))


# --- futures -------------------------------------------------------------------

# The groups of the given lines stand for products of each expiry frequency.
_CODES = {"AF": "EA", "AO": "EB", "NF": "ED", "NO": "EE", "RF": "EF", "RO": "EH"}
_CODE_CASE = "CASE l_returnflag || l_linestatus " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in _CODES.items()) + " END"
_UNIT = {"Q": "quarter", "M": "month", "A": "year"}


def _code():
    pairs = [F.lit(x) for item in _CODES.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), F.concat("l_returnflag", "l_linestatus"))


def _lines(spark, sf):
    return V.read(spark, sf, "lineitem").join(
        V.read(spark, sf, "orders").select("o_orderkey", "o_orderdate"),
        F.expr("l_orderkey = o_orderkey"))


@query("futures_long", f"""
SELECT product, CASE product {" ".join(f"WHEN '{c}' THEN '{FUTURES_PRODUCTS[c][1]}'"
                                       for c in _CODES.values())} END AS series,
       quote_date, CASE product {" ".join(
           f"WHEN '{c}' THEN CAST(date_trunc('{_UNIT[FUTURES_PRODUCTS[c][0]]}', day) AS DATE)"
           for c in _CODES.values())} END AS expiry,
       MAX(price) AS sett, CAST(SUM(quantity) AS BIGINT) AS volume
FROM (SELECT {_CODE_CASE} AS product, CAST(o_orderdate AS DATE) AS quote_date,
             l_shipdate AS day, l_extendedprice AS price, l_quantity AS quantity
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey) q GROUP BY 1, 2, 3, 4""")
def _(spark, sf):
    quotes = _lines(spark, sf).select(
        _code().alias("product"), F.col("o_orderdate").cast("date").alias("quote_date"),
        expiry_label("l_shipdate", product_info(_code(), 0)).alias("expiry"),
        "l_extendedprice", "l_quantity")
    grouped = quotes.groupBy("product", "quote_date", "expiry").agg(
        F.max("l_extendedprice").alias("sett"), F.sum("l_quantity").cast("bigint").alias("volume"))
    return grouped.select("product", product_info("product", 1).alias("series"), "quote_date",
                          "expiry", "sett", "volume")


#: The calendar of expiries that become columns; quotes of other expiries are counted.
_EXPIRIES = quarters(dt.date(1995, 1, 1), dt.date(2002, 12, 31))
_FIELDS = ["sett", "volume", "op_int"]
_CELLS = ",\n       ".join(f"MAX(CASE WHEN expiry = DATE '{e}' THEN {f} END) AS \"{e}_{f}\""
                          for e in _EXPIRIES for f in _FIELDS)
_FIRST, _LAST = _EXPIRIES[0], _EXPIRIES[-1]


@query("futures_wide", sql(f"""
SELECT product, quote_date, {_CELLS},
       COUNT(*) FILTER (expiry NOT BETWEEN DATE '{_FIRST}' AND DATE '{_LAST}') AS outside
FROM v_quote GROUP BY product, quote_date""", "v_quote"))
def _(spark, sf):
    """All three fields of every expiry of a calendar."""
    return quotes_to_columns(V.quote(spark, sf), _FIELDS, _EXPIRIES, outside="outside")


@query("futures_wide_grown", sql(f"""
SELECT product, quote_date, {_CELLS}, 3 AS n_appends, TRUE AS same_columns
FROM v_quote GROUP BY product, quote_date""", "v_quote"))
def _(spark, sf):
    """The wide table in three appends, each with expiries of its own, the last one run twice."""
    folder = work_folder(spark, "wide-quotes")
    quotes = staged(V.quote(spark, sf), "quotes")
    added = []
    for first, last in (("1900-01-01", "1996-12-31"), ("1997-01-01", "1999-06-30"), ("1999-07-01", "2099-12-31")):
        some = quotes.where(F.col("quote_date").between(first, last))
        added.append(append_wide_quotes(some, folder, _FIELDS))
    # a held day keeps its quotes
    append_wide_quotes(quotes.withColumn("sett", F.col("sett") + 1), folder, _FIELDS)
    grown = read_wide_quotes(spark, folder)
    wanted = {f"{e}_{f}" for e in expiries_of(quotes) for f in _FIELDS}
    cells = [F.col(c) if c in grown.columns else F.lit(None).cast("double" if c.endswith("sett") else "bigint").alias(c)
             for c in (f"{e}_{f}" for e in _EXPIRIES for f in _FIELDS)]
    return grown.select("product", "quote_date", *cells, F.lit(sum(n > 0 for n in added)).alias("n_appends"),
                        F.lit(wanted == set(grown.columns) - {"product", "quote_date"}).alias("same_columns"))


_HELD_UNTIL = dt.date(1998, 6, 30)


@query("futures_append_new", sql(f"""
SELECT product, quote_date, expiry,
       CASE WHEN quote_date <= DATE '{_HELD_UNTIL}' THEN sett ELSE sett + 1 END AS sett,
       volume, op_int FROM v_quote""", "v_quote"))
def _(spark, sf):
    quotes = V.quote(spark, sf)
    held = quotes.where(F.col("quote_date") <= F.lit(_HELD_UNTIL))
    # the new pages repeat the held days with other prices, which must not enter
    return append_new_quotes(held, quotes.withColumn("sett", F.col("sett") + 1))


@query("last_day_held", f"""
SELECT p.product, coalesce(MAX(q.quote_date), DATE '2009-07-13') AS last_day
FROM (SELECT DISTINCT {_CODE_CASE} AS product FROM lineitem) p
LEFT JOIN (SELECT {_CODE_CASE} AS product, CAST(o_orderdate AS DATE) AS quote_date
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey
           WHERE l_returnflag <> 'N') q ON p.product = q.product
GROUP BY 1""".replace("coalesce(MAX(q.quote_date), DATE '2009-07-13')",
                      "coalesce(MAX(q.quote_date), CASE p.product WHEN 'ED' "
                      "THEN DATE '2013-12-08' ELSE DATE '2009-07-13' END)"))
def _(spark, sf):
    # lines marked N are no quotes here, so that some products have none and take their start day
    held = _lines(spark, sf).where(F.col("l_returnflag") != "N").select(
        _code().alias("product"), F.col("o_orderdate").cast("date").alias("quote_date"))
    products = V.read(spark, sf, "lineitem").select(_code().alias("product"))
    return last_day_held(held, products)


@query("weekday_calendar", f"""
SELECT product, CAST(d AS DATE) AS quote_date
FROM (SELECT {_CODE_CASE} AS product, MIN(CAST(l_shipdate AS DATE)) AS last_day
      FROM lineitem GROUP BY 1) l, LATERAL (SELECT unnest(generate_series(
        CAST(last_day + 1 AS TIMESTAMP), TIMESTAMP '2003-12-31', INTERVAL 1 DAY)) AS d) t
WHERE isodow(d) <= 5""")
def _(spark, sf):
    last = V.read(spark, sf, "lineitem").groupBy(_code().alias("product")).agg(
        F.min(F.col("l_shipdate").cast("date")).alias("last_day"))
    return weekdays_to_fetch(last, F.lit(dt.date(2003, 12, 31)))


@query("forward_fill", """
SELECT conv_id, turn, role, last_value(head IGNORE NULLS) OVER (
         PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS heading
FROM (SELECT conv_id, turn, role,
             CASE WHEN role = 'user' THEN substr(split_part(text, ' ', 1), 1, 2) END AS head
      FROM conversations) x""")
def _(spark, sf):
    turns = V.read(spark, sf, "conversations")
    headed = turns.select("conv_id", "turn", "role", F.when(
        F.col("role") == "user", F.substring(first_word("text"), 1, 2)).alias("head"))
    return carry_down(headed, ["conv_id"], "turn", "head", "heading").drop("head")
