"""Half hours that close: late rows are kept apart, nothing is lost or counted twice."""

import datetime as dt

from pyspark.sql import functions as F

from halfhourly.streaming import windows as W

SCHEMA = "trading_date date, trading_period int, area string, demand double"
LATENESS = dt.timedelta(hours=2)


def put(spark, folder, *rows):
    data = [(dt.date(2014, 5, d), p, a, v) for d, p, a, v in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp_path, close=False):
    out = str(tmp_path / "out")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    W.split_late(stream, out, LATENESS, str(tmp_path / "c1")).awaitTermination()
    if close:
        W.end_marker(spark, out, stream.schema, dt.datetime(2100, 1, 1))
    W.close_half_hours(spark, out, stream.schema, ["area"], "demand", LATENESS, str(tmp_path / "c2")).awaitTermination()
    return out


def sums(df):
    return {(r.half_hour.day, r.half_hour.hour * 2 + r.half_hour.minute // 30 + 1, r.area): r.demand
            for r in df.where("area IS NOT NULL").collect()}


def test_late_rows_are_apart_and_closed_half_hours_are_final(spark, tmp_path):
    folder = str(tmp_path / "in")
    put(spark, folder, (1, 1, "A", 0.1), (1, 1, "A", 0.2), (1, 20, "B", 4.0))
    put(spark, folder, (1, 2, "A", 8.0), (1, 17, "A", 16.0), (1, 18, "A", 32.0))   # two of them are over two hours old
    out = run(spark, tmp_path)
    late = {(r.trading_period, r.demand) for r in W.late_rows(spark, out).collect()}
    assert late == {(2, 8.0)}
    assert sums(W.closed_half_hours(spark, out, ["area"], "demand")) == {(1, 1, "A"): 0.3}
    # a later run goes on from there; the half hours that were open still take their rows
    put(spark, folder, (1, 18, "A", 64.0), (1, 1, "A", 128.0), (2, 1, "B", 256.0))
    out = run(spark, tmp_path, close=True)
    assert {r.demand for r in W.late_rows(spark, out).collect()} == {8.0, 128.0}
    closed = sums(W.closed_half_hours(spark, out, ["area"], "demand"))
    assert closed == {(1, 1, "A"): 0.3, (1, 17, "A"): 16.0, (1, 18, "A"): 96.0, (1, 20, "B"): 4.0, (2, 1, "B"): 256.0}
    assert sums(W.all_half_hours(spark, out, ["area"], "demand")) == {
        **closed, (1, 1, "A"): 128.3, (1, 2, "A"): 8.0}


def test_a_batch_that_is_run_again_stores_its_rows_once(spark, tmp_path):
    put(spark, str(tmp_path / "in"), (1, 1, "A", 1.0))
    out = run(spark, tmp_path)
    rows = spark.read.parquet(f"{out}/rows").count()
    # as if the run had ended before the batch was committed
    from halfhourly.session import delete_path
    delete_path(spark, str(tmp_path / "c1" / "commits"))
    delete_path(spark, f"{out}/latest/batch_id=0")
    run(spark, tmp_path)
    assert spark.read.parquet(f"{out}/rows").count() == rows
    assert spark.read.parquet(f"{out}/latest").count() == 1


def test_rows_without_a_time_are_late(spark, tmp_path):
    spark.createDataFrame([(None, 1, "A", 1.0), (dt.date(2014, 5, 1), 1, "A", 2.0)], SCHEMA).coalesce(1) \
        .write.parquet(str(tmp_path / "in"))
    out = run(spark, tmp_path, close=True)
    assert [r.demand for r in W.late_rows(spark, out).collect()] == [1.0]
    assert sums(W.closed_half_hours(spark, out, ["area"], "demand")) == {(1, 1, "A"): 2.0}
    assert W.all_half_hours(spark, out, ["area"], "demand").agg(F.sum("demand")).first()[0] == 3.0
