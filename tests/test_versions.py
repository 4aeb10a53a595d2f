"""Amended rows: merge on read, what is written, compaction, and writers that are cut off."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from halfhourly.sources import tables as T, versions as V
from halfhourly.sources.csvfiles import table_of
from halfhourly.streaming import loads as L

NAME = "nodal_demand"


def demand(spark, *rows):
    data = [(dt.date(y, 5, 1 + k % 28), 1 + k % 48, f"N{k}", float(v)) for y, k, v in rows]
    return T.conform(spark.createDataFrame(data, "trading_date date, trading_period int, node string, demand double"), NAME)


def load(spark, store, *rows):
    table = table_of(NAME)
    staged, noted = T.staged_batch(demand(spark, *rows), table)
    return V.upsert(staged.where("reject_reason IS NULL").select(*T.stored_schema(table).names), store, table, noted)


def current(spark, store):
    return {(r.trading_year, r.node): r.demand for r in T.read_table(spark, store, NAME).collect()}


FIRST = [(y, k, 10) for y in (2013, 2014) for k in range(50)]


def files_of(spark, path):
    return {r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet").load(path).select("path").collect()}


def test_only_what_changes_is_written(spark, tmp_path):
    store = str(tmp_path / "store")
    assert load(spark, store, *FIRST) == V.Upsert(100, 0)
    before = files_of(spark, store)
    assert load(spark, store, *FIRST, (2014, 7, 99), (2014, 8, 1), (2015, 1, 5)) == V.Upsert(1, 1)
    assert before < files_of(spark, store)                  # nothing stored was written again
    assert spark.read.parquet(V.amended_path(store)).count() == 1
    want = {(y, f"N{k}"): 10.0 for y, k, _ in FIRST} | {(2014, "N7"): 99.0, (2015, "N1"): 5.0}
    assert current(spark, store) == want
    assert load(spark, store, (2014, 7, 99), (2015, 1, 5)) == V.Upsert(0, 0)
    assert load(spark, store, (2014, 7, 50)) == V.Upsert(0, 0)      # older than what is held
    assert current(spark, store) == want


def test_compaction_of_years_with_many_amended_rows(spark, tmp_path):
    store = str(tmp_path / "store")
    load(spark, store, *FIRST)
    load(spark, store, *[(2014, k, 20) for k in range(10)], (2013, 1, 30))
    want = current(spark, store)
    assert {r.trading_year: r.share for r in V.amended_shares(spark, store, NAME).collect()} == {2013: 0.02, 2014: 0.2}
    assert V.compact(spark, store, NAME, share=0.5) == []
    assert V.compact(spark, store, NAME, share=0.1) == [2014]
    assert current(spark, store) == want
    assert {r[0] for r in T.read_table(spark, V.amended_path(store), NAME).select("trading_year").collect()} == {2013}
    load(spark, store, (2014, 1, 40))
    assert current(spark, store) == {**want, (2014, "N1"): 40.0}


@pytest.mark.parametrize("step", range(5))
def test_a_compaction_cut_off_at_any_step_loses_nothing(spark, tmp_path, monkeypatch, step):
    store = str(tmp_path / "store")
    load(spark, store, *FIRST)
    load(spark, store, *[(y, k, 20) for y in (2013, 2014) for k in range(10)])
    want, done = current(spark, store), []

    def cut(function):
        def run(*args, **options):
            if len(done) == step:
                raise RuntimeError("cut off")
            done.append(function.__name__)
            return function(*args, **options)
        return run

    with monkeypatch.context() as patch:
        for name in ("write_rows", "delete_path"):
            patch.setattr(V, name, cut(getattr(V, name)))
        with pytest.raises(RuntimeError):
            V.compact(spark, store, NAME, share=0.0)
    assert len(done) == step and current(spark, store) == want
    assert load(spark, store, (2014, 1, 40)) == V.Upsert(0, 1)
    assert current(spark, store) == {**want, (2014, "N1"): 40.0}
    V.compact(spark, store, NAME, share=0.0)
    assert current(spark, store) == {**want, (2014, "N1"): 40.0}


def test_an_upsert_cut_off_between_its_writes_is_taken_up(spark, tmp_path, monkeypatch):
    store, real = str(tmp_path / "store"), V.write_rows
    load(spark, store, *FIRST)
    with monkeypatch.context() as patch:
        def failing(rows, path, *args, **options):
            if path.endswith("_amended"):
                raise RuntimeError("cut off")
            return real(rows, path, *args, **options)
        patch.setattr(V, "write_rows", failing)
        with pytest.raises(RuntimeError):
            load(spark, store, (2014, 7, 99), (2015, 1, 5))
    assert load(spark, store, (2014, 7, 99), (2015, 1, 5)) == V.Upsert(0, 1)
    assert current(spark, store)[(2014, "N7")] == 99.0 and current(spark, store)[(2015, "N1")] == 5.0


def test_a_table_without_years(spark, tmp_path):
    store, table = str(tmp_path / "lakes"), table_of("lake_levels")

    def put(level):
        day = dt.date(2014, 5, 1)
        rows = spark.createDataFrame([(day, lake, level, "GWh") for lake in ("A", "B")],
                                     "trading_date date, lake string, lake_levels double, unit string")
        staged, noted = T.staged_batch(T.conform(rows, table), table)
        return V.upsert(staged.where("reject_reason IS NULL").select(*T.stored_schema(table).names), store, table, noted)

    assert put(1.0) == V.Upsert(2, 0) and put(2.0) == V.Upsert(0, 2)
    assert V.compact(spark, store, table) == [None]
    assert {r.lake_levels for r in T.read_table(spark, store, table).collect()} == {2.0}
    assert spark.read.parquet(store).count() == 2


def test_what_is_noted_of_a_batch(spark):
    rows = demand(spark, (1913, 1, 1), (2014, 3, 1), (2014, 9, 1), (2199, 1, 1)).unionByName(
        demand(spark, (2014, 5, 1)).withColumn("node", F.lit(None).cast("string")))
    _, noted = T.staged_batch(rows, table_of(NAME))
    assert (noted.total, noted.rejected) == (5, 1)
    spans = {y: (a, b) for y, a, b in noted.spans}
    assert spans[2014] == (dt.date(2014, 5, 4), dt.date(2014, 5, 10)) or 1913 in spans
    assert {1913, 2014, 2199} <= set(spans)


def test_a_crowded_day_is_dealt_over_tasks(spark):
    crowded = spark.range(20_000).select(
        F.lit("2014-05-01").cast("date").alias("trading_date"), (F.col("id") % 48 + 1).cast("int").alias("trading_period"),
        F.concat(F.lit("N"), F.col("id").cast("string")).alias("node"), F.lit(1.0).alias("demand"))
    table = table_of(NAME)
    staged, noted = T.staged_batch(T.conform(crowded, NAME), table)
    dealt = T.Noted(4 * T._TASK_ROWS, 0, noted.spans, noted.cuts).dealt(staged, table)
    sizes = [r[0] for r in dealt.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) == 4 and max(sizes) < 1.2 * 20_000 / 4


def test_streams_leave_no_work_folders(spark, tmp_path):
    from halfhourly import session as S
    demand(spark, *FIRST).write.parquet(str(tmp_path / "in"))
    before = S.work_folders()
    stream = spark.readStream.schema(demand(spark, *FIRST).schema).parquet(str(tmp_path / "in"))
    L.load_new(stream, str(tmp_path / "store"), NAME, str(tmp_path / "check")).awaitTermination()
    assert S.work_folders() == before and len(current(spark, str(tmp_path / "store"))) == 100
