import datetime as dt
import gzip

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from halfhourly.plans.market import Market
from halfhourly.schemas import SEEDS, TABLES
from halfhourly.sources import csvfiles as C
from halfhourly.sources.lakes import lake_table, read_lakes, series_files
from halfhourly.sources.markup import page_links, page_table_rows, read_pages, read_xml
from halfhourly.sources.seeds import known_seeds, read_seeds
from halfhourly.sources.tables import (append_new_rows, bytes_per_year, conform, create_tables,
                                       insert_from_csv, new_rows, read_rejects, read_table, run_sql,
                                       with_year, write_rows)
from halfhourly.operators.aggregates import rows_per_year

PRICE_HEAD = "Trading_Date,Trading_Period,Node,Price"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def values(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_schemas():
    assert len(TABLES) == 20 and len(SEEDS) == 19
    assert len(TABLES["grid_imports"].columns) == 58
    assert all(set(t.key) <= set(t.columns) for t in TABLES.values())
    assert TABLES["energy_offers"].max_length("company") == 4
    assert all(s.table is None or s.table in TABLES for s in SEEDS.values())


def test_headers_are_told_by_their_names(spark):
    table = TABLES["energy_offers"]

    def told(line):
        return spark.createDataFrame([(line,)], "v string").select(
            C.is_header("v", table)).first()[0]

    assert told("COMPANY,Grid Injection Point,STATION")
    assert told('"company","station"')
    assert told("Remark," + ",".join(table.key).upper() + ",Other")
    assert not told("Remark," + ",".join(table.key[1:]))
    assert not told("MRPL,HLY2201,HLY,1")
    assert not told("company,HLY2201,HLY,1")


def test_mixed_folder(spark, tmp_path):
    """CRLF endings, a headerless file, a compressed file, blank lines."""
    write(tmp_path / "a2014.csv", PRICE_HEAD + "\r\n24/05/2014,1,OTA2201,50.5\r\n\r\n")
    write(tmp_path / "b201405.csv", "2014-05-25,2,BEN2201,-0.01\n")
    with gzip.open(tmp_path / "c.csv.gz", "wt") as f:
        f.write(PRICE_HEAD.upper() + "\n20140526,50,HAY2201,7\n")
    write(tmp_path / "notes.txt", "not a table")
    rows = C.read_csv(spark, str(tmp_path), "nodal_prices")
    good = C.accepted(rows)
    assert values(good, "trading_date", "trading_period", "node", "price", "trading_year") == [
        (dt.date(2014, 5, 24), 1, "OTA2201", 50.5, 2014),
        (dt.date(2014, 5, 25), 2, "BEN2201", -0.01, 2014),
        (dt.date(2014, 5, 26), 50, "HAY2201", 7.0, 2014)]
    assert C.rejected(rows).count() == 0


def test_bad_rows_are_kept_aside(spark, tmp_path):
    write(tmp_path / "x.csv", "\n".join([
        "24/05/2014,1,OTA2201,50.5", "31/02/2014,1,OTA2201,1", "24/05/2014,x,OTA2201,1",
        "24/05/2014,1,TOOLONGNODE,1", "24/05/2014,1,,1", "24/05/2014,1,OTA2201,1,surplus",
        "24/05/2014,2,OTA2201,"]))
    rows = C.read_csv(spark, str(tmp_path), "nodal_prices")
    assert C.accepted(rows).count() == 2
    reasons = [r["reject_reason"] for r in C.rejected(rows).collect()]
    assert sorted(reasons) == ["cannot read the line", "cannot read the line",
                               "cannot read trading_date", "no node", "node too long"]


def test_file_year_is_checked(spark, tmp_path):
    write(tmp_path / "prices2013.csv", "24/05/2014,1,OTA2201,50.5\n24/05/2013,1,OTA2201,1\n")
    write(tmp_path / "prices.csv", "24/05/2012,1,OTA2201,50.5\n")
    rows = C.check_file_year(C.read_csv(spark, str(tmp_path), "nodal_prices"))
    assert values(C.rejected(rows), "trading_year", "reject_reason") == [
        (2014, "year differs from file name")]


def test_columns_by_their_own_header(spark, tmp_path):
    write(tmp_path / "with blank" / "a.csv", "Price,Node,Trading Period,Trading_Date\n9,OTA2201,3,24/05/2014\n")
    write(tmp_path / "with blank" / "b.csv", "25/05/2014,4,BEN2201,8\n")
    write(tmp_path / "with blank" / "c.csv", "node,trading_date,trading_period\nHAY2201,26/05/2014,5\n")
    rows = C.read_csv(spark, str(tmp_path / "with blank"), "nodal_prices", by_name=True)
    assert sorted(((r["trading_date"].day, r["trading_period"], r["node"], r["price"])
                   for r in C.accepted(rows).collect())) == [
        (24, 3, "OTA2201", 9.0), (25, 4, "BEN2201", 8.0), (26, 5, "HAY2201", None)]


def test_headers_as_published(spark, tmp_path):
    """Unknown columns, quoted cells with commas, a line that is too short, another order."""
    write(tmp_path / "a.csv", 'Node,Trading_date,Trading_period,Price,Extra\n'
                              'OTA2201,24/05/2014,1,"1","a, ""b"""\nOTA2201,24/05/2014,x,1,\nOTA2201,24/05/2014\n')
    write(tmp_path / "b.csv", "trading date,Node,TRADING_PERIOD\n25/05/2014,BEN2201,2\n")
    rows = C.read_csv(spark, str(tmp_path), "nodal_prices", by_name=True)
    assert values(C.accepted(rows), "trading_date", "trading_period", "node", "price") == [
        (dt.date(2014, 5, 24), 1, "OTA2201", 1.0), (dt.date(2014, 5, 25), 2, "BEN2201", None)]
    assert [r["reject_reason"] for r in C.rejected(rows).collect()] == ["cannot read the line"] * 2
    assert [r[0] for r in spark.createDataFrame([('a,"b ""c"", d",,"",e',), ('"x \\"y\\", z",1',)], "v string")
            .select(C.csv_cells("v")).collect()] == [["a", 'b "c", d', "", "", "e"], ['x "y", z', "1"]]
    # the positional reader passes the headers over as well
    assert C.rejected(C.read_csv(spark, str(tmp_path / "b.csv"), "nodal_prices")).count() == 1


def test_unread_cells_have_a_reason(spark, tmp_path):
    text = spark.createDataFrame([("Napier-HawkesBay", dt.date(2014, 5, 24), "13:00", "N/A"),
                                  ("Napier-HawkesBay", dt.date(2014, 5, 24), "14:00", "1.5")],
                                 "location string, trading_date date, local_time string, precipitation string")
    rows = conform(text, "temperature_data", reasons=True)
    load = append_new_rows(spark, rows, str(tmp_path / "t"), "temperature_data")
    assert (load.loaded, load.rejected) == (1, 1)
    assert read_rejects(spark, str(tmp_path / "t"), "temperature_data").first()["reject_reason"] == \
        "cannot read precipitation"


def test_size_of_a_table_without_years(spark, tmp_path):
    store = str(tmp_path / "lake_levels")
    insert_from_csv(spark, write(tmp_path / "l.csv", "01/02/2014,350.5,Taupo,GWh\n"), store, "lake_levels")
    sizes = bytes_per_year(read_table(spark, store, "lake_levels")).collect()
    assert len(sizes) == 1 and sizes[0]["bytes"] == sum(f.stat().st_size for f in (tmp_path / "lake_levels").glob("*.parquet"))


def test_timestamps_and_times(spark, tmp_path):
    write(tmp_path / "r.csv", "24/05/2014 16:30,24/05/2014 17:00:00,34,NI,North Island,1.5,2\n")
    row = C.accepted(C.read_csv(spark, str(tmp_path / "r.csv"), "reserve_prices")).first()
    assert row["period_start"] == dt.datetime(2014, 5, 24, 16, 30)
    assert row["period_end"] == dt.datetime(2014, 5, 24, 17, 0) and row["region"] == "North Island"
    write(tmp_path / "d.csv", "24/05/2014,34,16:30:00,NI,OTA2201,2\n24/05/2014,35,late,NI,OTA2201,2\n")
    rows = C.read_csv(spark, str(tmp_path / "d.csv"), "nodal_demand")
    assert [r["time"] for r in C.accepted(rows).collect()] == ["16:30"]
    assert C.rejected(rows).first()["reject_reason"] == "cannot read time"


def test_wide_files(spark, tmp_path):
    """A 46-period day and a 50-period day."""
    ids = "OTA2201,VECT,,TRAD,kWh,X,F"
    spring = ids + ",28/09/2014," + ",".join(["1"] * 46) + ",,,,"
    autumn = ids + ",06/04/2014," + ",".join(["2"] * 50)
    write(tmp_path / "w.csv", spring + "\n" + autumn + "\n")
    rows = C.read_csv(spark, str(tmp_path), "grid_imports")
    # generation_type is part of the unique key
    assert {r["reject_reason"] for r in rows.collect()} == {"no generation_type"}
    write(tmp_path / "w.csv", spring.replace("VECT,", "VECT,H") + "\n" + autumn.replace("VECT,", "VECT,H"))
    from halfhourly.operators.reshape import half_hour_to_long
    good = C.accepted(C.read_csv(spark, str(tmp_path), "grid_imports")).drop("trading_year", "source_file")
    long = half_hour_to_long(good)
    assert {(r["Trading_Date"].month, r["n"], round(r["mw"], 6)) for r in long.groupBy("Trading_Date")
            .agg(F.count("*").alias("n"), F.sum("Average_Output").alias("mw")).collect()} == {
        (9, 46, 0.092), (4, 50, 0.2)}
    assert {r["Unit_Measure"] for r in long.collect()} == {"MW"} and "Grid_Point" in long.columns


def test_half_hours_of_repeated_ids_are_summed(spark, rows):
    from halfhourly.operators.reshape import half_hour_to_long
    df = spark.createDataFrame([("A", 500.0, None, 7.0), ("A", 250.0, None, 7.0), (None, 1.0, 1.0, 7.0)],
                               "poc string, tp1 double, TP2 double, TPX double")
    # TPX is no period column, so it is an id
    assert rows(half_hour_to_long(df).drop("TPX")) == [("A", "MW", 1, 1.5)]


def test_xml(spark, tmp_path):
    text = """<?xml version="1.0"?><Rows>
      <Row><SUBMISSION_DATE>2014-05-23T10:15:00</SUBMISSION_DATE><PNODE_NAME>HLY2201 HLY1</PNODE_NAME>
      <TRADER_NAME>GENE</TRADER_NAME><TRADING_PERIOD_START_DATE>24/05/2014</TRADING_PERIOD_START_DATE>
      <MW>10</MW><PRICE>1.5</PRICE><MIN_MW>1</MIN_MW><MAX_MW>20</MAX_MW>
      <SRC_OFFER_BLOCK_ID>7</SRC_OFFER_BLOCK_ID><TRADING_PERIOD>3</TRADING_PERIOD></Row>
      <Row><PNODE_NAME>HLY2201 HLY1</PNODE_NAME><TRADER_NAME>GENE</TRADER_NAME>
      <TRADING_PERIOD>4</TRADING_PERIOD></Row></Rows>"""
    rows = read_xml(spark, write(tmp_path / "20140524_Final_FK_offers.XML", text),
                    "frequency_keeping_final_offers")
    row = C.accepted(rows).first()
    assert (row["submission_date"], row["price"], row["src_offer_block_id"], row["trading_year"]) == (
        dt.datetime(2014, 5, 23, 10, 15), 1.5, 7, 2014)
    assert C.rejected(rows).first()["reject_reason"] == "no trading_period_start_date"


LAKE = ("Taupo storage record\r\nline 2\r\nline 3\r\nline 4\r\n"
        "date,average inflow,2014 {word},\r\n01/02/2014,1.5,{a},\r\n02/02/2014,1.6,,\r\n")


def test_lakes(spark, tmp_path):
    write(tmp_path / "a.csv", LAKE.format(word="stored", a="350.5"))
    write(tmp_path / "b.csv", LAKE.replace("Taupo", "Hawea").replace("\r\n", "\n")
          .format(word="inflow", a="20.25"))
    rows = read_lakes(spark, str(tmp_path))
    assert values(rows.where("value IS NOT NULL"), "lake", "measure", "unit", "trading_date", "value") == [
        ("Hawea", "inflow", "GWh/d", dt.date(2014, 2, 1), 20.25),
        ("Taupo", "stored", "GWh", dt.date(2014, 2, 1), 350.5)]
    assert lake_table(rows, "inflow").columns == TABLES["lake_inflows"].names
    assert values(series_files(rows), "file_name") == [
        ("Hawea_Inflows_20140201_20140202.csv",), ("Taupo_Lake_Levels_20140201_20140202.csv",)]


def test_pages(spark, tmp_path):
    write(tmp_path / "p.html", """<html><!-- <a href="/hidden">x</a> --><script>'<a href="/s">'</script>
      <A class="k" HREF='/d%2Foffers20140813.csv'>13 <b>August</b> 2014</A><a name="top">t</a>
      <a href="/q?a=1&amp;b=2">Q</a>
      <table><tr><td>one</td></tr></table>
      <TABLE border=1><tr><th>H</th><th>I &amp; J</th></tr><tr><td> 1 </td><td></td></tr></TABLE></html>""")
    write(tmp_path / "empty.html", "")
    pages = read_pages(spark, str(tmp_path))
    assert values(page_links(pages), "link_no", "href", "text") == [
        (0, "/d%2Foffers20140813.csv", "13 August 2014"), (2, "/q?a=1&b=2", "Q")]
    assert values(page_table_rows(pages, 1), "row_no", "cells") == [
        (0, ["H", "I & J"]), (1, ["1", ""])]
    assert page_table_rows(pages, 7).count() == 0


def prices(spark, *rows):
    return spark.createDataFrame(
        [(dt.date(2000 + y, 1, 1), p, n, float(v), f) for y, p, n, v, f in rows],
        "trading_date date, trading_period int, node string, price double, source_file string")


def test_append_skips_known_rows(spark, tmp_path):
    store = str(tmp_path / "nodal_prices")
    assert read_table(spark, store, "nodal_prices").count() == 0
    first = append_new_rows(spark, prices(spark, (13, 1, "A", 1, "f"), (14, 1, "A", 2, "f"),
                                          (14, 1, "A", 3, "f")), store, "nodal_prices")
    assert (first.loaded, first.not_loaded) == (2, 1)
    second = append_new_rows(spark, prices(spark, (14, 1, "A", 9, "g"), (15, 1, "A", 4, "g"),
                                           (15, 1, None, 4, "g")), store, "nodal_prices")
    assert (second.loaded, second.not_loaded, second.rejected) == (1, 1, 1)
    assert values(read_rejects(spark, store, "nodal_prices"), "source_file", "reject_reason") == [("g", "no node")]
    table = read_table(spark, store, "nodal_prices")
    assert values(table, "trading_year", "price") == [(2013, 1.0), (2014, 3.0), (2015, 4.0)]
    assert values(rows_per_year(table), "trading_year", "n_rows") == [(2013, 1), (2014, 1), (2015, 1)]
    assert all(r["bytes"] > 0 for r in bytes_per_year(table).collect())


def test_only_the_dates_of_a_batch_are_read(spark, tmp_path):
    store = str(tmp_path / "nodal_prices")
    append_new_rows(spark, prices(spark, (13, 1, "A", 1, "f"), (14, 1, "A", 1, "f"),
                                  (15, 1, "A", 1, "f")), store, "nodal_prices")
    batch = with_year(prices(spark, (14, 1, "A", 2, "g"), (14, 2, "A", 2, "g")), TABLES["nodal_prices"])
    new = new_rows(spark, batch, store, "nodal_prices")
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "trading_year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(trading_date,2014-01-01)" in plan
    assert values(new, "trading_period") == [(2,)]
    # the same for a table whose date column is a timestamp
    wind = conform(spark.sql("SELECT timestamp_ntz'2014-05-24 16:30:00' AS stamp"), "scada_wind_data")
    for loaded in (1, 0):
        assert append_new_rows(spark, wind, str(tmp_path / "wind"), "scada_wind_data").loaded == loaded


def test_stored_files_are_sorted_by_date(spark, tmp_path):
    days = spark.range(3000).select(
        F.date_add(F.lit(dt.date(2013, 6, 1)), F.pmod(F.hash("id"), F.lit(700))).alias("trading_date"),
        (F.col("id") % 48).cast("int").alias("trading_period"),
        F.concat(F.lit("N"), F.col("id").cast("string")).alias("node"),
        F.lit(1.0).alias("price"))
    write_rows(with_year(days, TABLES["nodal_prices"]), str(tmp_path / "p"), "nodal_prices")
    files = list((tmp_path / "p").glob("trading_year=*/*.parquet"))
    spans = []
    for f in files:
        dates = pq.read_table(f, columns=["trading_date"]).column(0).to_pylist()
        assert dates == sorted(dates)
        spans.append((dates[0], dates[-1]))
    # and their date bounds overlap in single days at most
    spans.sort()
    assert len(files) >= 3 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_append_rejects_whole_files(spark, tmp_path):
    store = str(tmp_path / "nodal_prices")
    append_new_rows(spark, prices(spark, (14, 1, "A", 1, "f")), store, "nodal_prices")
    batch = prices(spark, (14, 1, "A", 9, "known"), (14, 2, "A", 9, "known"),
                   (14, 3, "A", 1, "own"), (14, 3, "A", 1, "own"), (14, 4, "A", 1, "own"),
                   (14, 5, "A", 1, "p"), (14, 5, "A", 2, "q"), (14, 6, "A", 2, "q"))
    report = append_new_rows(spark, batch, store, "nodal_prices", mode="reject_file")
    assert (report.loaded, report.not_loaded) == (1, 7)
    assert values(read_table(spark, store, "nodal_prices"), "trading_period") == [(1,), (5,)]
    with pytest.raises(ValueError):
        append_new_rows(spark, batch, store, "nodal_prices", mode="replace")
    with pytest.raises(ValueError):
        append_new_rows(spark, batch.drop("source_file"), store, "nodal_prices", mode="reject_file")


def test_loading_a_folder_twice_is_loading_it_once(spark, tmp_path):
    write(tmp_path / "in" / "a2014.csv", PRICE_HEAD + "\n24/05/2014,1,OTA2201,50.5\n")
    write(tmp_path / "in" / "b2014.csv", "25/05/2014,1,OTA2201,51\n25/05/2014,bad,OTA2201,51\n")
    store = str(tmp_path / "nodal_prices")
    first = insert_from_csv(spark, str(tmp_path / "in"), store, "nodal_prices")
    assert (first.loaded, first.not_loaded, first.rejected) == (2, 0, 1)
    assert insert_from_csv(spark, str(tmp_path / "in"), store, "nodal_prices").loaded == 0
    assert read_table(spark, store, "nodal_prices").count() == 2
    # one file, and a table that is not split by year
    lake = write(tmp_path / "lake.csv", "01/02/2014,350.5,Taupo,GWh\n")
    assert insert_from_csv(spark, lake, str(tmp_path / "lake_levels"), "lake_levels").loaded == 1
    assert insert_from_csv(spark, lake, str(tmp_path / "lake_levels"), "lake_levels").loaded == 0
    with pytest.raises(ValueError):
        insert_from_csv(spark, lake, store, "no_such_table")


def test_catalog_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS market")
    create_tables(spark, database="market", location=str(tmp_path))
    assert spark.sql("SHOW TABLES IN market").where("NOT isTemporary").count() == 20
    append_new_rows(spark, prices(spark, (14, 1, "A", 1, "f"), (15, 1, "A", 2, "f")),
                    str(tmp_path / "nodal_prices"), "nodal_prices")
    spark.sql("MSCK REPAIR TABLE market.nodal_prices")
    query = "SELECT price FROM market.nodal_prices ORDER BY price"
    assert [r[0] for r in run_sql(spark, query).collect()] == [1.0, 2.0]
    assert [r[0] for r in run_sql(spark, query, 1).collect()] == [1.0]
    spark.sql("DROP DATABASE market CASCADE")


def test_market_over_a_folder(spark, tmp_path):
    market = Market(spark, str(tmp_path / "store"))
    write(tmp_path / "in" / "a.csv", PRICE_HEAD + "\n24/05/2014,1,OTA2201,50.5\n24/05/2014,1,HLY2201,9\n")
    assert market.insert_many_csv("nodal_prices", str(tmp_path / "in")).loaded == 2
    assert market.insert_from_csv("nodal_prices", str(tmp_path / "in" / "a.csv")).loaded == 0
    assert market.query_nodal_price(dates="24/05/2014", nodes="Major").count() == 1
    assert market.query_nodal_demand(dates="24/05/2014").count() == 0
    assert market.get_all_table_sizes("nodal_prices").first()["trading_year"] == 2014
    with pytest.raises(ValueError):
        Market(spark).insert_many_csv("nodal_prices", str(tmp_path / "in"))
    with pytest.raises(ValueError):
        Market(spark).table("nodal_prices")


def test_conform_and_write_csv(spark, tmp_path):
    df = conform(spark.createDataFrame([("OTA2201", "3")], "NODE string, price string"), "nodal_prices")
    assert df.columns == TABLES["nodal_prices"].names and df.first()["price"] == 3.0
    C.write_csv(df, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).columns == df.columns


def test_metadata(spark, tmp_path):
    path = write(tmp_path / "meta.csv", "Node,Load Area,Island_Name\r\nOTA2201,Auckland,North\r\n")
    meta = C.read_metadata(spark, path)
    assert meta.columns == ["node", "load_area", "island_name"] and meta.count() == 1
    bare = C.read_metadata(spark, write(tmp_path / "bare.csv", "OTA2201,Auckland\n"), ["node", "area"])
    assert bare.first()["area"] == "Auckland"


def test_seeds(spark, tmp_path):
    path = write(tmp_path / "config.json", """{"folder": "/data",
      "EMI_Final_Prices": {"pattern": "Final_prices", "date_type": "Monthly", "match_type": "href",
                           "rename": "Final_pricing", "extension": ".csv"},
      "offer_database": {"schemas": {"energy_offers": {"split_by_year": true}}}}""")
    seeds = read_seeds(spark, path)
    assert values(seeds, "name", "pattern", "rename", "cextension") == [
        ("EMI_Final_Prices", "Final_prices", "Final_pricing", None)]
    assert known_seeds(spark).count() == 19
