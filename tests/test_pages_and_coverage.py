import datetime as dt

import pytest
from pyspark.sql import functions as F

from halfhourly.operators import coverage as K
from halfhourly.operators.reshape import lakes_to_columns, quotes_to_columns, wind_to_long
from halfhourly.plans import futures as X, weather as W
from halfhourly.schemas import SEEDS, TABLES


def d(y, m, day):
    return dt.date(y, m, day)


def values(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_calendars(spark):
    assert K.calendar(spark, "2014-01-01", "2014-01-31").count() == 31
    assert K.calendar(spark, "2014-01-01", "2014-01-31", weekdays=True).count() == 23
    assert values(K.month_slices(spark, "20/12/2013", "10/02/2014"), "slice_begin", "slice_end") == [
        (d(2013, 12, 20), d(2013, 12, 31)), (d(2014, 1, 1), d(2014, 1, 31)),
        (d(2014, 2, 1), d(2014, 2, 10))]
    # a range without a month end, and one that ends on one
    assert K.month_slices(spark, "2014-02-03", "2014-02-10").count() == 1
    assert K.month_slices(spark, "2014-02-03", "2014-02-28").count() == 1


def test_days_held(spark, tmp_path):
    for name in ("offers20140813.csv", "offers201402.csv", "offers_notes.csv", "offers20140814.txt"):
        (tmp_path / name).write_text("x")
    held = K.days_held(spark, str(tmp_path), SEEDS["WITS_Energy_Offers"])
    assert held.count() == 29
    assert held.where("trading_date = DATE '2014-08-13'").count() == 1


def test_published_days_and_manifest(spark):
    links = spark.createDataFrame(
        [(1, "/x%2Foffers20140813.csv.Z", "old"), (2, "/y/offers20140813.csv.Z", "new"),
         (3, "/y/offers201409.csv.Z", "month"), (4, "/y/other20140815.csv.Z", "offers"),
         (5, "/y/offers_note.csv.Z", "note")], "link_no int, href string, text string")
    seed = SEEDS["WITS_Energy_Offers"]
    published = K.seed_days(links, seed)
    assert published.count() == 31
    assert values(published.where("trading_date < DATE '2014-09-01'"), "href") == [
        ("/y/offers20140813.csv.Z",)]
    held = spark.createDataFrame([(d(2014, 8, 13),), (d(2014, 9, 1),)], "trading_date date")
    assert values(K.manifest(published, held), "href") == [("/y/offers201409.csv.Z",)]
    assert K.matching_links(links, "offers", "text").count() == 1
    with pytest.raises(ValueError):
        K.matching_links(links, "offers", "title")


def test_demand_links_are_dated_by_their_text(spark):
    links = spark.createDataFrame(
        [(1, "/f/DemandDaily.1.gz", " 1  January 2014"), (2, "/f/DemandDaily.2.gz", "help")],
        "link_no int, href string, text string")
    days = K.seed_days(links, SEEDS["WITS_Recent_Nodal_Demand"])
    assert values(days, "trading_date", "href") == [(d(2014, 1, 1), "/f/DemandDaily.1.gz")]


def test_unloaded_dates(spark):
    batch = spark.createDataFrame([(d(2014, 1, 1),), (d(2014, 1, 2),), (d(2014, 1, 2),), (None,)],
                                  "trading_date date")
    table = spark.createDataFrame([(d(2014, 1, 1),)], "trading_date date")
    assert values(K.unloaded_dates(batch, table), "trading_date") == [(d(2014, 1, 2),)]


def row(*cells):
    return "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"


FUTURES_PAGE = "<html><table><tr><td>menu</td></tr></table><table>" + "".join([
    row("Expiry", "Bid", "Op Int", "Volume", "Sett"),
    row("EA - NZ Electricity (Otahuhu)"),
    row("Click here to view settlement price and volume graph"),
    row("Mar 2014", "-", "1,234", "10", "80.5"),
    row("Mar 2014", "-", "1,234", "10", "80.5"),
    row("Sep 2014", "", "5", "-", "-1.5"),
    row(""),
    row("ED - NZ Month (Otahuhu)"),
    row("Feb 14", "1", "2", "3", "4"),
    row("EB - NZ Strip"),
    row("2015", "1", "2", "3", "75"),
]) + "</table><table></table>" + " " * 5000 + "</html>"


def test_futures_pages(spark):
    pages = spark.createDataFrame(
        [("/htm/EODWebMarketSummary140108ZFT.htm", FUTURES_PAGE),
         ("/htm/EODWebMarketSummary140109ZFT.htm", "<html>no quotes</html>")],
        "name string, html string")
    got = sorted((r["product"], r["expiry"], r["sett"], r["volume"], r["op_int"])
                 for r in X.quotes_of_pages(pages).collect())
    assert got == [("EA", d(2014, 1, 1), 80.5, 10.0, 1234.0), ("EA", d(2014, 7, 1), -1.5, None, 5.0),
                   ("EB", d(2015, 1, 1), 75.0, 3.0, 2.0), ("ED", d(2014, 2, 1), 4.0, 3.0, 2.0)]
    assert {r["quote_date"] for r in X.quotes_of_pages(pages).collect()} == {d(2014, 1, 8)}


def test_growing_series(spark):
    schema = "product string, quote_date date, expiry date, sett double"
    held = spark.createDataFrame([("EA", d(2014, 1, 8), d(2014, 1, 1), 80.0)], schema)
    new = spark.createDataFrame(
        [("EA", d(2014, 1, 8), d(2014, 1, 1), 99.0), ("EA", d(2014, 1, 9), d(2014, 4, 1), 81.0),
         ("EC", d(2013, 12, 8), d(2014, 1, 1), 5.0), ("EC", d(2013, 12, 9), d(2014, 1, 1), 6.0)], schema)
    series = X.append_new_quotes(held, new)
    assert values(series, "product", "quote_date", "sett") == [
        ("EA", d(2014, 1, 8), 80.0), ("EA", d(2014, 1, 9), 81.0), ("EC", d(2013, 12, 9), 6.0)]
    # a second run adds nothing
    assert X.append_new_quotes(series, new).count() == 3
    products = spark.createDataFrame([("EA",), ("EC",), ("EH",)], "product string")
    last = X.last_day_held(series, products)
    assert values(last, "product", "last_day") == [
        ("EA", d(2014, 1, 9)), ("EC", d(2013, 12, 9)), ("EH", d(2013, 12, 8))]
    days = X.weekdays_to_fetch(last, F.lit(d(2014, 1, 14)))
    assert values(days.where("product = 'EA'"), "quote_date") == [
        (d(2014, 1, 10),), (d(2014, 1, 13),), (d(2014, 1, 14),)]
    wide = quotes_to_columns(series, ["sett"], [d(2014, 1, 1), d(2014, 4, 1)])
    assert wide.columns == ["product", "quote_date", "2014-01-01_sett", "2014-04-01_sett"]
    assert wide.where("`2014-01-01_sett` IS NULL").count() == 1


def weather_page(*rows_):
    head = row("Local Time", "Temperature", "Dewpoint", "Humidity", "Barometer", "Visibility",
               "Wind Direction", "Wind Speed", "Gust Speed", "Precipitation", "Events", "Conditions")
    return "<table><tr><td>x</td></tr></table>" * 14 + "<table>" + head + "".join(rows_) + "</table>"


def test_weather_pages(spark):
    page = weather_page(
        row("1:00 PM", "12°C", "9°C", "85%", "1013hPa", "10km", "NNW", "7.4km/h", "", "0.2", "Rain", "Cloudy"),
        row("1:30 PM", "", "9°C", "85%", "", "10km", "Calm", "Calm", "", "N/A", "", ""))
    pages = spark.createDataFrame([("Dunedin-Otago", d(2014, 5, 24), page),
                                   ("Dunedin-Otago", d(2014, 5, 25), "")],
                                  "location string, trading_date date, html string")
    table = W.weather_of_pages(pages)
    assert set(TABLES["temperature_data"].names) == set(table.columns)
    first, second = sorted(table.collect(), key=lambda r: r["local_time"])
    assert (first["local_time"], first["temperature"], first["barometer"], first["wind_speed"],
            first["gust_speed"], first["wind_direction"]) == ("13:00", 12.0, 1013.0, 7.4, None, "NNW")
    assert second["temperature"] is None and second["wind_speed"] is None
    wanted = W.wanted_pages(spark, "24/05/2014", "26/05/2014")
    assert wanted.count() == 18
    assert W.missing_location_days(wanted, pages.select("location", "trading_date")).count() == 16


def test_columns(spark):
    names = TABLES["scada_wind_data"].names
    wind = spark.createDataFrame([(dt.datetime(2014, 1, 1), *([1.5] * 9), None)],
                                 ", ".join(["stamp timestamp_ntz"] + [f"{n} double" for n in names[1:]]))
    assert wind_to_long(wind).count() == 9
    lakes = spark.createDataFrame([(d(2014, 1, 1), "Taupo", 1.0), (d(2014, 1, 1), "Hawea", 2.0),
                                   (d(2014, 1, 2), "Taupo", 3.0)],
                                  "trading_date date, lake string, lake_levels double")
    assert sorted(tuple(r) for r in lakes_to_columns(lakes, ["Taupo", "Hawea"]).collect()) == [
        (d(2014, 1, 1), 1.0, 2.0), (d(2014, 1, 2), 3.0, None)]


def test_refresh_reads_later_weekdays_only(spark):
    held = spark.createDataFrame([("EA", d(2014, 1, 8), d(2014, 1, 1), 80.5, 1.0, 1.0)],
                                 "product string, quote_date date, expiry date, sett double, "
                                 "volume double, op_int double")
    pages = spark.createDataFrame(
        [(f"/htm/EODWebMarketSummary1401{day}ZFT.htm", FUTURES_PAGE) for day in ("07", "08", "09", "11")],
        "name string, html string")
    # the 7th and 8th are held of EA, the 11th is a Saturday; other products are caught up
    series = X.refresh_quotes(held, pages)
    assert values(series.where("product = 'EA'").select("quote_date").distinct(), "quote_date") == [
        (d(2014, 1, 8),), (d(2014, 1, 9),)]
    others = series.where("product <> 'EA'").select("quote_date").distinct()
    assert values(others, "quote_date") == [(d(2014, 1, 7),), (d(2014, 1, 8),), (d(2014, 1, 9),)]
    assert series.count() == 5 + 2 * series.where("product <> 'EA' AND quote_date = DATE '2014-01-09'").count()
    assert X.refresh_quotes(held.limit(0), pages).select("quote_date").distinct().count() == 3


def test_weather_file_name(spark):
    name = spark.range(1).select(W.page_file_name(F.lit("Dunedin-Otago"), F.lit(d(2014, 5, 24)))).first()[0]
    assert name == "Dunedin_Otago_20140524.csv"
