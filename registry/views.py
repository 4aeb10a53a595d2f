"""Market-shaped views of the given tables, as DataFrames and as SQL of the same rows."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from halfhourly.functions.dates import period_of
from halfhourly.operators.predicates import date_filter
from halfhourly.schemas import MAX_PERIODS, TABLES


class Entry(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Registers a query under a name, with the SQL of the same result."""

    def add(function):
        if name in ENTRIES:
            raise ValueError(f"query {name!r} is registered twice")
        ENTRIES[name] = Entry(function, sql)
        return function

    return add


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def _dated(df: DataFrame, col: str, dates: dict) -> DataFrame:
    """The date filter on the stored timestamp, where the scan can use it."""
    return date_filter(df, date_col=col, **dates) if dates else df


def _line_period():
    return ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 48).cast("int") + 1


def _exact_sum(col: str):
    return F.sum(F.col(col).cast("decimal(18,2)")).cast("double")


def _node(prefix: str, col: str):
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


def demand(spark: SparkSession, sf: str, **dates) -> DataFrame:
    rows = _dated(read(spark, sf, "lineitem"), "l_shipdate", dates)
    grouped = (rows.groupBy(F.col("l_shipdate").cast("date").alias("trading_date"),
                            _line_period().alias("trading_period"), "l_suppkey")
               .agg(F.sum("l_quantity").alias("demand")))
    return grouped.select("trading_date", "trading_period", _node("S", "l_suppkey").alias("node"),
                          "demand")


def price(spark: SparkSession, sf: str, **dates) -> DataFrame:
    rows = _dated(read(spark, sf, "events"), "ts", dates)
    grouped = (rows.groupBy(F.col("ts").cast("date").alias("trading_date"),
                            period_of("ts").alias("trading_period"), "user_id")
               .agg(F.max("value").alias("price")))
    return grouped.select("trading_date", "trading_period", _node("N", "user_id").alias("node"),
                          "price")


def meta(spark: SparkSession, sf: str) -> DataFrame:
    places = (read(spark, sf, "nation")
              .join(read(spark, sf, "region"), F.expr("n_regionkey = r_regionkey"))
              .select("n_nationkey", "n_name", "r_name"))
    # every tenth node is left unknown, so that left and inner joins differ
    suppliers = read(spark, sf, "supplier").where("s_suppkey % 10 <> 0")
    return (suppliers.join(places, F.expr("s_nationkey = n_nationkey"))
            .select(_node("S", "s_suppkey").alias("meta_node"), F.col("n_name").alias("load_area"),
                    F.col("r_name").alias("island_name")))


def price_meta(spark: SparkSession, sf: str) -> DataFrame:
    # every tenth node is left unknown, as above
    users = read(spark, sf, "events").where("user_id % 10 <> 0").select("user_id").distinct()
    return users.select(_node("N", "user_id").alias("node"),
                        F.concat(F.lit("A"), (F.col("user_id") % 7).cast("string"))
                        .alias("load_area"))


def offer(spark: SparkSession, sf: str, **dates) -> DataFrame:
    lines = _dated(read(spark, sf, "lineitem"), "l_shipdate", dates)
    return (lines
            .join(read(spark, sf, "supplier").select("s_suppkey", "s_nationkey"),
                  F.expr("l_suppkey = s_suppkey"))
            .join(read(spark, sf, "part").select("p_partkey", "p_type", "p_retailprice"),
                  F.expr("l_partkey = p_partkey"))
            .join(read(spark, sf, "orders").select("o_orderkey", "o_orderdate"),
                  F.expr("l_orderkey = o_orderkey"))
            .select(_node("C", "s_nationkey").alias("company"),
                    _node("S", "l_suppkey").alias("grid_injection_point"),
                    F.substring("p_type", 1, 3).alias("station"),
                    F.col("l_linenumber").alias("unit"),
                    F.col("l_shipdate").cast("date").alias("trading_date"),
                    _line_period().alias("trading_period"),
                    F.col("l_quantity").alias("band1_power"),
                    F.col("p_retailprice").alias("band1_price"),
                    (F.col("l_quantity") * 2).alias("band2_power"),
                    (F.col("p_retailprice") * 2).alias("band2_price"),
                    F.lit(None).cast("double").alias("band3_power"),
                    F.lit(None).cast("double").alias("band3_price"),
                    F.col("o_orderdate").cast("date").alias("created_date"),
                    F.col("l_shipdate").cast("date").alias("last_amended_date")))


def half_hour(spark: SparkSession, sf: str) -> DataFrame:
    grouped = (read(spark, sf, "events")
               .groupBy("user_id", F.col("event_type").alias("nwk_code"),
                        F.col("ts").cast("date").alias("trading_date"),
                        period_of("ts").alias("trading_period"))
               .agg(_exact_sum("value").alias("kwh")))
    return grouped.select(_node("N", "user_id").alias("poc"), "nwk_code", "trading_date",
                          "trading_period", "kwh")


def wide(spark: SparkSession, sf: str) -> DataFrame:
    at = F.col("trading_period")
    return (half_hour(spark, sf).groupBy("poc", "nwk_code", "trading_date")
            .agg(*[F.sum(F.when(at == k, F.col("kwh"))).alias(f"TP{k}")
                   for k in range(1, MAX_PERIODS + 1)]))


def stations(spark: SparkSession, sf: str) -> DataFrame:
    """The wind table: a tenth of the users stands for each station column."""
    columns = [c for c in TABLES["scada_wind_data"].names if c != "stamp"]
    value, place = F.col("value").cast("decimal(18,2)"), F.col("user_id") % 10
    hour = F.timestamp_add("HOUR", F.hour("ts"), F.col("ts").cast("date").cast("timestamp_ntz"))
    return (read(spark, sf, "events").groupBy(hour.alias("stamp"))
            .agg(*[F.sum(F.when(place == i, value)).cast("double").alias(c)
                   for i, c in enumerate(columns)]))


def storage(spark: SparkSession, sf: str) -> DataFrame:
    """A lake series over seven years: one value per lake and day."""
    return (read(spark, sf, "lineitem")
            .groupBy(F.concat("l_returnflag", "l_linestatus").alias("lake"),
                     F.col("l_shipdate").cast("date").alias("trading_date"))
            .agg(F.sum("l_quantity").alias("lake_levels")))


def quote(spark: SparkSession, sf: str) -> DataFrame:
    lines = read(spark, sf, "lineitem").join(
        read(spark, sf, "orders").select("o_orderkey", "o_orderdate"),
        F.expr("l_orderkey = o_orderkey"))
    return (lines.groupBy(F.concat("l_returnflag", "l_linestatus").alias("product"),
                          F.col("o_orderdate").cast("date").alias("quote_date"),
                          F.trunc("l_shipdate", "quarter").alias("expiry"))
            .agg(F.max("l_extendedprice").alias("sett"),
                 F.sum("l_quantity").cast("bigint").alias("volume"),
                 F.count(F.lit(1)).alias("op_int")))


# --- the same rows in SQL ------------------------------------------------------

VIEWS = {
    "v_demand": """
SELECT CAST(l_shipdate AS DATE) AS trading_date,
       CAST((l_orderkey * 7 + l_linenumber) % 48 AS INT) + 1 AS trading_period,
       concat('S', CAST(l_suppkey AS VARCHAR)) AS node,
       SUM(l_quantity) AS demand
FROM lineitem GROUP BY 1, 2, 3""",
    "v_price": """
SELECT CAST(ts AS DATE) AS trading_date,
       CAST(hour(ts) * 2 + CASE WHEN minute(ts) >= 30 THEN 1 ELSE 0 END AS INT) + 1 AS trading_period,
       concat('N', CAST(user_id AS VARCHAR)) AS node,
       MAX(value) AS price
FROM events GROUP BY 1, 2, 3""",
    "v_meta": """
SELECT concat('S', CAST(s_suppkey AS VARCHAR)) AS meta_node,
       n_name AS load_area, r_name AS island_name
FROM supplier JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
WHERE s_suppkey % 10 <> 0""",
    "v_price_meta": """
SELECT DISTINCT concat('N', CAST(user_id AS VARCHAR)) AS meta_node,
       concat('A', CAST(user_id % 7 AS VARCHAR)) AS load_area
FROM events WHERE user_id % 10 <> 0""",
    "v_offer": """
SELECT concat('C', CAST(s_nationkey AS VARCHAR)) AS company,
       concat('S', CAST(l_suppkey AS VARCHAR)) AS grid_injection_point,
       substr(p_type, 1, 3) AS station,
       l_linenumber AS unit,
       CAST(l_shipdate AS DATE) AS trading_date,
       CAST((l_orderkey * 7 + l_linenumber) % 48 AS INT) + 1 AS trading_period,
       l_quantity AS band1_power, p_retailprice AS band1_price,
       l_quantity * 2 AS band2_power, p_retailprice * 2 AS band2_price,
       CAST(NULL AS DOUBLE) AS band3_power, CAST(NULL AS DOUBLE) AS band3_price,
       CAST(o_orderdate AS DATE) AS created_date,
       CAST(l_shipdate AS DATE) AS last_amended_date
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey""",
    "v_halfhour": """
SELECT concat('N', CAST(user_id AS VARCHAR)) AS poc, event_type AS nwk_code,
       CAST(ts AS DATE) AS trading_date,
       CAST(hour(ts) * 2 + CASE WHEN minute(ts) >= 30 THEN 1 ELSE 0 END AS INT) + 1 AS trading_period,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS kwh
FROM events GROUP BY 1, 2, 3, 4""",
    "v_storage": """
SELECT l_returnflag || l_linestatus AS lake, CAST(l_shipdate AS DATE) AS trading_date,
       SUM(l_quantity) AS lake_levels
FROM lineitem GROUP BY 1, 2""",
    "v_quote": """
SELECT concat(l_returnflag, l_linestatus) AS product,
       CAST(o_orderdate AS DATE) AS quote_date,
       CAST(date_trunc('quarter', l_shipdate) AS DATE) AS expiry,
       MAX(l_extendedprice) AS sett,
       CAST(SUM(l_quantity) AS BIGINT) AS volume,
       COUNT(*) AS op_int
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3""",
}


def sql(body: str, *views: str) -> str:
    """A SELECT with the named views in front of it."""
    parts = [f"{name} AS ({VIEWS[name]})" for name in views]
    lead = f"WITH {', '.join(parts)}\n" if parts else ""
    return lead + body.strip()


def quantile_sql(source: str, keys: str, col: str, probabilities: list[float], *views: str) -> str:
    """Quantiles with linear interpolation, by the rank of each row."""
    steps = ", ".join(f"(CAST({p} AS DOUBLE))" for p in probabilities)
    return sql(f"""
SELECT {keys}, probability, lo + (hi - lo) * part AS value FROM (
  SELECT {keys}, probability, MAX(CASE WHEN i = floor(spot) THEN v END) AS lo,
         MAX(CASE WHEN i = ceil(spot) THEN v END) AS hi, MAX(spot - floor(spot)) AS part
  FROM (SELECT *, probability * (n - 1) AS spot FROM (
          SELECT {keys}, {col} AS v,
                 row_number() OVER (PARTITION BY {keys} ORDER BY {col}) - 1 AS i,
                 COUNT(*) OVER (PARTITION BY {keys}) AS n
          FROM {source} q WHERE {col} IS NOT NULL) r, (VALUES {steps}) p(probability)) s
  GROUP BY {keys}, probability) e""", *views)
