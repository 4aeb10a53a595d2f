"""Loads: files written from the given tables, read back, appended, streamed.

The files go to a new folder below the shared one that ``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from halfhourly.operators.joins import merge_meta
from halfhourly.schemas import TABLES
from halfhourly.session import work_folder
from halfhourly.sources.csvfiles import accepted, read_csv, write_csv
from halfhourly.sources.markup import read_xml
from halfhourly.sources.tables import (append_new_rows, conform, insert_from_csv, read_rejects,
                                       read_table, stored_bytes, write_rows, with_year)
from halfhourly.sources.versions import amended_shares, compact
from halfhourly.streaming.loads import add_half_hours, half_hour_totals, load_new
from halfhourly.streaming.windows import all_half_hours, close_half_hours, end_marker, late_rows, split_late
from registry import views as V
from registry.views import query, sql

_PRICE = "SELECT trading_date, trading_period, node, price FROM v_price"
_YEAR = "CAST(year(trading_date) AS INT) AS trading_year"


@query("load_csv_roundtrip", sql(f"""
SELECT trading_date, trading_period, node, price, {_YEAR} FROM v_price""", "v_price"))
def _(spark, sf):
    folder = work_folder(spark, "csv-roundtrip")
    write_csv(V.price(spark, sf), f"{folder}/raw")
    insert_from_csv(spark, f"{folder}/raw", f"{folder}/nodal_prices", "nodal_prices")
    return read_table(spark, f"{folder}/nodal_prices", "nodal_prices")


def _mixed_files(spark, sf, label):
    """Prices in two folders: files with a header in another order and a further column, and files without."""
    folder = work_folder(spark, label)
    prices = V.price(spark, sf)
    named = prices.where("trading_period <= 24").select(
        F.col("node").alias("Node"), F.col("Price").alias("PRICE"),
        F.col("trading_date").alias("Trading Date"), F.col("trading_period").alias("Trading_Period"),
        F.concat(F.lit('as "published",\nin '), F.col("trading_period").cast("string"), F.lit(" lines\n\nor two")).alias("Remark"),
        F.col("node").alias("Spare"))
    named = named.select("Node", "PRICE", "Remark", "Trading Date", "Trading_Period", "Spare")
    write_csv(named, f"{folder}/named")
    prices.where("trading_period > 24").write.option("header", False).csv(f"{folder}/bare")
    return folder


@query("csv_header_detect", sql(_PRICE, "v_price"))
def _(spark, sf):
    folder = _mixed_files(spark, sf, "csv-headers")
    rows = read_csv(spark, [f"{folder}/named", f"{folder}/bare"], "nodal_prices", by_name=True)
    return accepted(rows).select("trading_date", "trading_period", "node", "price")


@query("load_folder", sql(f"""
SELECT trading_date, trading_period, node, price, {_YEAR} FROM v_price""", "v_price"))
def _(spark, sf):
    folder = work_folder(spark, "load-folder")
    prices = V.price(spark, sf)
    write_csv(prices.where("trading_period <= 24"), f"{folder}/raw")
    prices.where("trading_period > 24").write.mode("append").option("header", False).csv(f"{folder}/raw")
    # the second load of the same folder adds nothing
    for _ in range(2):
        insert_from_csv(spark, f"{folder}/raw", f"{folder}/nodal_prices", "nodal_prices")
    return read_table(spark, f"{folder}/nodal_prices", "nodal_prices")


_KEY = ", ".join(TABLES["energy_offers"].key)


@query("append_new_rows", sql(f"""
SELECT company, grid_injection_point, station, unit, trading_date, trading_period,
       band1_power, CASE WHEN trading_date < DATE '1998-07-01' THEN band1_price
                         ELSE band1_price + 1000 END AS band1_price, last_amended_date, {_YEAR}
FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY last_amended_date DESC,
        created_date DESC, band1_power DESC, band1_price DESC) AS rn FROM v_offer) x
WHERE rn = 1""", "v_offer"))
def _(spark, sf):
    store = work_folder(spark, "append") + "/energy_offers"
    offers = conform(V.offer(spark, sf), "energy_offers")
    append_new_rows(spark, offers.where("trading_date < DATE '1998-07-01'"), store, "energy_offers")
    # half a year of the batch is stored already and must keep its prices
    later = (offers.where("trading_date >= DATE '1998-01-01'")
             .withColumn("band1_price", F.col("band1_price") + 1000))
    append_new_rows(spark, later, store, "energy_offers")
    return read_table(spark, store, "energy_offers").select(
        *TABLES["energy_offers"].key, "band1_power", "band1_price", "last_amended_date",
        "trading_year")


@query("table_sizes", sql(f"""
SELECT {_YEAR}, COUNT(*) AS n_rows, TRUE AS has_bytes FROM v_demand GROUP BY 1""", "v_demand"))
def _(spark, sf):
    store = work_folder(spark, "sizes") + "/nodal_demand"
    demand = conform(V.demand(spark, sf), "nodal_demand")
    write_rows(with_year(demand, TABLES["nodal_demand"]), store, "nodal_demand")
    table = read_table(spark, store, "nodal_demand")
    rows = table.groupBy("trading_year").agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.join(stored_bytes(spark, store, "nodal_demand"), "trading_year").select(
        "trading_year", "n_rows", (F.col("bytes") > 0).alias("has_bytes"))


@query("unsplit_size", sql("SELECT COUNT(*) AS n_rows, TRUE AS size_agrees FROM v_storage", "v_storage"))
def _(spark, sf):
    """A table that is not split by year: its size is that of the files the rows were written to."""
    store = work_folder(spark, "unsplit") + "/lake_levels"
    lakes = conform(V.storage(spark, sf).withColumn("unit", F.lit("GWh")), "lake_levels")
    append_new_rows(spark, lakes, store, "lake_levels")
    table = read_table(spark, store, "lake_levels")
    read = table.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("size")).distinct()
    listed = read.agg(F.sum("size").alias("listed"))
    bytes_held = stored_bytes(spark, store, "lake_levels").first()["bytes"]
    counted = table.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.withColumn("size_agrees", F.lit(bytes_held == listed.first()["listed"] and bytes_held > 0))


@query("xml_roundtrip", """
SELECT CAST(o_orderdate AS TIMESTAMP) AS submission_date, 'P' || o_custkey AS pnode_name,
       CAST(o_orderdate AS DATE) AS trading_period_start_date, o_totalprice AS price,
       CAST(o_orderkey % 48 AS INT) + 1 AS trading_period FROM orders""")
def _(spark, sf):
    folder = work_folder(spark, "xml")
    orders = V.read(spark, sf, "orders")
    (orders.select(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("SUBMISSION_DATE"),
                   F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("PNODE_NAME"),
                   F.lit("MRPL").alias("TRADER_NAME"),
                   F.date_format("o_orderdate", "dd/MM/yyyy").alias("TRADING_PERIOD_START_DATE"),
                   F.col("o_totalprice").cast("string").alias("PRICE"),
                   (F.col("o_orderkey") % 48 + 1).cast("string").alias("TRADING_PERIOD"))
     .write.format("xml").option("rowTag", "Row").option("rootTag", "Rows").save(folder))
    rows = read_xml(spark, folder, "frequency_keeping_final_offers")
    return accepted(rows).select("submission_date", "pnode_name", "trading_period_start_date",
                                 "price", "trading_period")


def _name_files(spark, folder, form):
    """Renames the part files of a folder, as published files carry their year in the name."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = [f.getPath() for f in files.listStatus(place) if f.getPath().getName().startswith("part-")]
    for n, part in enumerate(parts):
        files.rename(part, jvm.org.apache.hadoop.fs.Path(place, form.format(n)))


@query("load_rejects", """
SELECT reason AS reject_reason, COUNT(*) AS n_rows FROM (
  SELECT CASE CAST(l_orderkey % 10 AS INT)
           WHEN 1 THEN 'cannot read trading_date' WHEN 2 THEN 'cannot read the line'
           WHEN 3 THEN 'node too long' WHEN 4 THEN 'no node' WHEN 5 THEN 'year differs from file name'
           ELSE 'loaded' END AS reason FROM lineitem) x GROUP BY 1""")
def _(spark, sf):
    """Lines as a price file with bad rows of five sorts; what the load says of them, by reason."""
    folder = work_folder(spark, "load-rejects")
    kind, day = F.col("l_orderkey") % 10, F.col("l_shipdate")
    bad_day, year = F.lit("31/02/1995"), F.lit("1995")
    date = (F.when(kind == 1, bad_day)
            .otherwise(F.concat(F.date_format(day, "dd/MM/"), F.when(kind == 5, F.lit("1996")).otherwise(year))))
    # 1995 has no 29th of February
    date = F.when((kind != 1) & (F.date_format(day, "ddMM") == "2902"),
                  F.when(kind == 5, F.lit("01/03/1996")).otherwise(F.lit("01/03/1995"))).otherwise(date)
    node = (F.when(kind == 3, F.lit("TOOLONGNODE")).when(kind == 4, F.lit(""))
            .otherwise(F.concat(F.lit("N"), F.col("l_linenumber").cast("string"))))
    line = F.concat_ws(",", date, F.when(kind == 2, F.lit("x")).otherwise(F.col("l_orderkey").cast("string")), node,
                       F.col("l_extendedprice").cast("string"))
    V.read(spark, sf, "lineitem").select(line.alias("value")).write.text(f"{folder}/text")
    _name_files(spark, f"{folder}/text", "prices1995-{}.csv")
    load = insert_from_csv(spark, f"{folder}/text", f"{folder}/nodal_prices", "nodal_prices")
    rejects = read_rejects(spark, f"{folder}/nodal_prices", "nodal_prices")
    loaded = spark.range(1).select(F.lit("loaded").alias("reject_reason"),
                                   F.lit(load.loaded + load.not_loaded).cast("long").alias("n_rows"))
    return (rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))
            .unionByName(loaded).where("n_rows > 0"))


# --- streams -------------------------------------------------------------------

def _demand_stream(spark, sf, max_files=1):
    """The lines of the given table, one file a batch, as a stream of demand rows."""
    schema = V.read(spark, sf, "lineitem").schema
    return _demand_rows(spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
                        .parquet(f"{sf}/lineitem.parque[t]"))  # a pattern takes a file as well as a folder of files


def _demand_rows(lines):
    return lines.select(
        F.col("l_shipdate").cast("date").alias("trading_date"),
        (((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 48).cast("int") + 1)
        .alias("trading_period"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("node"),
        F.col("l_quantity").alias("demand"))


@query("stream_load_new", f"""
SELECT CAST(l_shipdate AS DATE) AS trading_date,
       CAST((l_orderkey * 7 + l_linenumber) % 48 AS INT) + 1 AS trading_period,
       'S' || l_suppkey AS node, MAX(l_quantity) AS demand,
       CAST(year(l_shipdate) AS INT) AS trading_year
FROM lineitem GROUP BY 1, 2, 3, 5""")
def _(spark, sf):
    folder = work_folder(spark, "stream-load")
    store = f"{folder}/nodal_demand"
    rows = conform(_demand_stream(spark, sf), "nodal_demand")
    # the second run finds no new file
    for _ in range(2):
        load_new(rows, store, "nodal_demand", f"{folder}/checkpoint").awaitTermination()
    return read_table(spark, store, "nodal_demand").drop("time", "island")


_AMENDED = "l_orderkey % 100 = 0"


@query("stream_amend", f"""
SELECT trading_date, trading_period, node, demand, CAST(year(trading_date) AS INT) AS trading_year,
       TRUE AS few_written, CAST(year(trading_date) AS INT) % 2 = 0 AS year_compacted
FROM (SELECT CAST(l_shipdate AS DATE) AS trading_date,
             CAST((l_orderkey * 7 + l_linenumber) % 48 AS INT) + 1 AS trading_period, 'S' || l_suppkey AS node,
             MAX(l_quantity + CASE WHEN {_AMENDED} THEN 100 ELSE 0 END) AS demand
      FROM lineitem GROUP BY 1, 2, 3) x""")
def _(spark, sf):
    """One row in a hundred is amended in a second stream: what is written then, and compaction of every second year."""
    folder = work_folder(spark, "stream-amend")
    store = f"{folder}/nodal_demand"
    lines = V.read(spark, sf, "lineitem")
    rows = conform(_demand_stream(spark, sf), "nodal_demand")
    load_new(rows, store, "nodal_demand", f"{folder}/checkpoint").awaitTermination()
    # the second stream repeats a twentieth of the rows as they are
    (lines.where(f"{_AMENDED} OR l_orderkey % 20 = 7")
     .withColumn("l_quantity", F.expr(f"l_quantity + IF({_AMENDED}, 100, 0)")).write.parquet(f"{folder}/more"))
    again = conform(_demand_rows(spark.readStream.schema(lines.schema).parquet(f"{folder}/more")), "nodal_demand")
    load_new(again, store, "nodal_demand", f"{folder}/more-checkpoint").awaitTermination()
    written = spark.read.parquet(f"{store}_amended").count()
    few = 0 < written <= 0.02 * spark.read.parquet(store).count()
    even = work_folder(spark, "stream-amend") + "/nodal_demand"
    shares = amended_shares(spark, store, "nodal_demand").count()
    odd = F.col("trading_year") % 2 == 1
    table = read_table(spark, store, "nodal_demand")
    # the odd years go on as they are, the even ones are compacted in a table of their own
    write_rows(spark.read.parquet(store).where(~odd).select(table.columns), even, "nodal_demand")
    write_rows(spark.read.parquet(f"{store}_amended").where(~odd).select(table.columns), f"{even}_amended", "nodal_demand")
    compacted = compact(spark, even, "nodal_demand", share=0.0)
    both = table.where(odd).unionByName(read_table(spark, even, "nodal_demand"))
    return both.drop("time", "island").select(
        "*", F.lit(few and shares > 0).alias("few_written"),
        F.col("trading_year").isin(compacted).alias("year_compacted"))


@query("stream_halfhour_demand", sql("""
SELECT CAST(trading_date AS TIMESTAMP) + to_minutes(trading_period * 30 - 30) AS half_hour,
       load_area, SUM(demand) AS demand
FROM v_demand JOIN v_meta ON node = meta_node GROUP BY 1, 2""", "v_demand", "v_meta"))
def _(spark, sf):
    folder = work_folder(spark, "stream-demand")
    rich = merge_meta(_demand_stream(spark, sf), V.meta(spark, sf), "demand", "inner")
    add_half_hours(rich, f"{folder}/out", ["load_area"], f"{folder}/checkpoint").awaitTermination()
    return half_hour_totals(spark, f"{folder}/out", ["load_area"])


_LATENESS = dt.timedelta(days=3)


@query("stream_windows", sql("""
SELECT CAST(trading_date AS TIMESTAMP) + to_minutes(trading_period * 30 - 30) AS half_hour,
       load_area, SUM(demand) AS demand, TRUE AS some_late, TRUE AS some_closed, TRUE AS none_lost
FROM v_demand JOIN v_meta ON node = meta_node GROUP BY 1, 2""", "v_demand", "v_meta"))
def _(spark, sf):
    """Three arrivals out of order: half hours that closed, and late rows beside them, make up the batch's sums."""
    folder = work_folder(spark, "stream-windows")
    lines = V.read(spark, sf, "lineitem")
    part = (F.when((F.col("l_shipdate") < "1997-07-01") & (F.col("l_orderkey") % 10 != 0), 0)
            .when((F.col("l_shipdate") < "2000-01-01") & (F.col("l_orderkey") % 10 != 1), 1).otherwise(2))
    rich = None
    for k in range(3):
        # an arrival is one batch, of as many files as tasks write and read
        lines.where(part == k).write.mode("append").parquet(f"{folder}/files")
        if rich is None:
            arriving = _demand_rows(spark.readStream.schema(lines.schema).parquet(f"{folder}/files"))
            rich = merge_meta(arriving, V.meta(spark, sf), "demand", "inner")
        split_late(rich, f"{folder}/out", _LATENESS, f"{folder}/check-rows").awaitTermination()
    end_marker(spark, f"{folder}/out", rich.schema, dt.datetime(2100, 1, 1))
    close_half_hours(spark, f"{folder}/out", rich.schema, ["load_area"], "demand", _LATENESS,
                     f"{folder}/check-sums").awaitTermination()
    late = late_rows(spark, f"{folder}/out").count()
    closed = spark.read.parquet(f"{folder}/out/closed").agg(F.sum("n")).first()[0]
    stored = spark.read.parquet(f"{folder}/out/rows").where("demand IS NOT NULL").count()
    return all_half_hours(spark, f"{folder}/out", ["load_area"], "demand").select(
        "*", F.lit(late > 0).alias("some_late"), F.lit(closed > 0).alias("some_closed"),
        F.lit(late + closed == stored).alias("none_lost"))
