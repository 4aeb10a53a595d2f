import datetime as dt

import pytest
from pyspark.sql import functions as F

from halfhourly.sources.csvfiles import accepted
from halfhourly.sources.tables import read_rejects, read_table
from halfhourly.streaming import loads as L


def test_files_are_loaded_once(spark, tmp_path):
    folder, store = tmp_path / "in", str(tmp_path / "nodal_prices")
    folder.mkdir()
    head = "trading_date,trading_period,node,price\n"
    (folder / "a.csv").write_text(head + "24/05/2014,1,OTA2201,50\n24/05/2014,1,OTA2201,50\n")

    def run():
        stream = accepted(L.stream_csv(spark, str(folder), "nodal_prices"))
        L.load_new(stream, store, "nodal_prices", str(tmp_path / "check")).awaitTermination()
        return sorted((r["trading_date"].day, r["price"])
                      for r in read_table(spark, store, "nodal_prices").collect())

    assert run() == [(24, 50.0)]
    # no header, a repeated key with another price, a day that comes late, a bad row
    (folder / "b.csv").write_text("bad,1,OTA2201,1\n24/05/2014,1,OTA2201,99\n23/05/2013,1,OTA2201,7\n")
    assert run() == [(23, 7.0), (24, 99.0)]
    assert run() == [(23, 7.0), (24, 99.0)]
    # a lost checkpoint reads all files again and still adds nothing
    stream = accepted(L.stream_csv(spark, str(folder), "nodal_prices", max_files=1))
    L.load_new(stream, store, "nodal_prices", str(tmp_path / "other")).awaitTermination()
    assert read_table(spark, store, "nodal_prices").count() == 2


@pytest.mark.parametrize("max_files", [1, 100])
def test_the_batch_cut_changes_nothing(spark, tmp_path, max_files):
    folder, store = tmp_path / "in", str(tmp_path / "nodal_prices")
    folder.mkdir()
    for n, price in enumerate((10, 99, 50)):
        (folder / f"{n}.csv").write_text(f"24/05/2014,1,OTA2201,{price}\n24/05/201{n},2,OTA2201,1\n"
                                         f"24/05/2014,3,TOOLONGNODE,{price}\n24/05/2014,x,OTA2201,1\n")
    stream = L.stream_csv(spark, str(folder), "nodal_prices", max_files=max_files)
    L.load_new(stream, store, "nodal_prices", str(tmp_path / "check")).awaitTermination()
    got = sorted((r["trading_year"], r["trading_period"], r["price"])
                 for r in read_table(spark, store, "nodal_prices").collect())
    assert got == [(2010, 2, 1.0), (2011, 2, 1.0), (2012, 2, 1.0), (2014, 1, 99.0)]
    reasons = sorted(r["reject_reason"] for r in read_rejects(spark, store, "nodal_prices").collect())
    assert reasons == ["cannot read the line"] * 3 + ["node too long"] * 3
    # the same for a table that is not split by year
    lakes = str(tmp_path / "lake_levels")
    for n, level in enumerate((10, 99, 50)):
        (folder / f"{n}.csv").write_text(f"01/02/2014,{level},Taupo,GWh\n0{n + 1}/03/2014,1,Taupo,GWh\n")
    stream = L.stream_csv(spark, str(folder), "lake_levels", max_files=max_files)
    L.load_new(stream, lakes, "lake_levels", str(tmp_path / "lakes")).awaitTermination()
    assert sorted(r["lake_levels"] for r in read_table(spark, lakes, "lake_levels").collect()) == [1.0, 1.0, 1.0, 99.0]


def demand_stream(spark, folder):
    return spark.readStream.schema("trading_date date, trading_period int, area string, "
                                   "demand double").json(str(folder))


def test_half_hour_demand(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    line = '{{"trading_date": "{}", "trading_period": {}, "area": "{}", "demand": {}}}\n'
    # the third file is a year late and counts all the same
    for n, (day, rows) in enumerate((("2014-05-24", [(1, "N", 5), (1, "N", 0.1), (2, "S", 1)]),
                                     ("2015-05-24", [(1, "N", 3)]), ("2014-05-24", [(1, "N", 0.2)]))):
        (folder / f"{n}.json").write_text("".join(line.format(day, *r) for r in rows))
        L.add_half_hours(demand_stream(spark, folder), str(tmp_path / "out"), ["area"],
                         str(tmp_path / "check")).awaitTermination()
    got = L.half_hour_totals(spark, str(tmp_path / "out"), ["area"])
    day = dt.datetime(2014, 5, 24)
    assert sorted((r["half_hour"], r["area"], r["demand"]) for r in got.collect()) == [
        (day, "N", 5.3), (day + dt.timedelta(minutes=30), "S", 1.0), (day.replace(year=2015), "N", 3.0)]


def test_distinct_within(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "0.json").write_text('{"area": "N", "trading_date": "2014-05-24"}\n' * 3)
    stream = L.distinct_within(demand_stream(spark, folder), ["area"],
                               F.col("trading_date").cast("timestamp_ntz"), "1 day")
    (stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
     .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True)
     .start().awaitTermination())
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
