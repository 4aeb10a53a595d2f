"""Work is dealt over tasks, however few files or groups the rows come in."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from halfhourly import session


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Two hundred lines of four suppliers over five years in eight files, and forty customers in one."""
    folder = str(tmp_path_factory.mktemp("tables"))
    day = F.date_add(F.lit(dt.date(1995, 1, 1)), (F.col("id") * 9).cast("int")).cast("timestamp_ntz")
    spark.range(0, 200, 1, 8).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), (F.col("id") % 4 + 1).alias("l_suppkey"),
        (F.col("id") % 50).cast("double").alias("l_quantity"), day.alias("l_shipdate")).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(1, 5).select(F.col("id").alias("s_suppkey"), F.lit(0).alias("s_nationkey")).write.parquet(f"{folder}/supplier.parquet")
    spark.sql("SELECT 0 AS n_nationkey, 'A' AS n_name, 0 AS n_regionkey").write.parquet(f"{folder}/nation.parquet")
    spark.sql("SELECT 0 AS r_regionkey, 'R' AS r_name").write.parquet(f"{folder}/region.parquet")
    spark.range(0, 40, 1, 1).select(F.col("id").alias("c_custkey"), F.lit(3).alias("c_nationkey"),
                                    F.lit(-1.5).alias("c_acctbal")).write.parquet(f"{folder}/customer.parquet")
    return folder


def test_arrivals_of_a_stream_are_written_by_all_tasks(spark, tables):
    """one task wrote, and later read, a third of the table."""
    known = len(session._FOLDERS)
    found = driver.queries()["stream_windows"](spark, tables).collect()
    assert sum(r.demand for r in found) == sum(i % 50 for i in range(200))
    assert all(r.some_late and r.some_closed and r.none_lost for r in found)
    folder = next(f for f in session._FOLDERS[known:] if "stream-windows" in f).removeprefix("file:")
    assert len(glob.glob(f"{folder}/files/part-*")) > 3
    assert len(glob.glob(f"{folder}/out/latest/batch_id=*")) == 3


def test_pages_are_parsed_by_all_tasks(spark, tables):
    """F8: the customers of one file became pages, and were parsed, in one task."""
    from registry.text_queries import _summary_pages
    pages = _summary_pages(spark, tables)
    tasks = pages.select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert driver.queries()["futures_pages"](spark, tables).count() == 80


def test_refresh_parses_pages_by_all_tasks(spark, tables):
    """as above; the plan of each parse deals the customers first."""
    found = driver.queries()["futures_refresh"](spark, tables)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_customers_are_not_sorted_to_be_dealt(spark, tables):
    """rows dealt in turn are sorted first, in the one task that reads them."""
    from registry.text_queries import _summary_pages
    assert "RoundRobinPartitioning" not in _summary_pages(spark, tables)._jdf.queryExecution().executedPlan().toString()


def test_pages_without_hidden_parts_are_as_they_are(spark):
    from halfhourly.functions.text import HIDDEN_HTML, visible_html
    pages = ["", None, "<p>a</p>", "a<!-- b -->c", "<SCRIPT>x</script>y<b>", "<Style>z</STYLE >z</styLe>w", "<span>s</span>", "<!doctype>", "<scripts>",
             "a<!-- b", "<\u017fcript>x</script>"]
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    for r in df.select(visible_html("html"), F.regexp_replace("html", HIDDEN_HTML, "")).collect():
        assert r[0] == r[1]


def test_cuts_are_found_by_halving(spark):
    """every cut was looked at for every row, so a row took the longer the more tasks there were."""
    from bisect import bisect_left, bisect_right
    from halfhourly.schemas import TABLES
    from halfhourly.sources.tables import Noted, _leading
    for cuts in ([], [5], [3, 5, 5, 5, 9], [7] * 8, list(range(0, 398, 2))):
        c = F.col("id").cast("int")
        found = spark.range(-2, 400).select("id", _leading(cuts, lambda x: x < c), _leading(cuts, lambda x: x <= c)).collect()
        assert all(tuple(r) == (r.id, bisect_left(cuts, r.id), bisect_right(cuts, r.id)) for r in found)
    rows = spark.sql("SELECT DATE '2014-05-01' AS trading_date, 1 AS trading_period, 'A' AS node")
    noted = Noted(10**9, 0, (), tuple(range(16000, 16199)))
    assert "filter(" not in noted.dealt(rows, TABLES["nodal_prices"])._jdf.queryExecution().executedPlan().toString()


def offered(spark, days, price, repeats=1):
    rows = spark.range(days * repeats).select(
        F.date_add(F.lit(dt.date(2013, 12, 20)), (F.col("id") % days).cast("int")).alias("trading_date"), F.lit(1).alias("trading_period"),
        F.lit("A").alias("node"), (F.lit(price) + F.floor(F.col("id") / days)).cast("double").alias("price"))
    return rows


@pytest.mark.parametrize("task_rows", [250_000, 3])      # of three rows a task no key is rare
def test_new_rows_move_and_are_sorted_once(spark, tmp_path, monkeypatch, task_rows):
    """a batch was sorted and shuffled by key, joined, then shuffled by date and sorted again."""
    from halfhourly.sources import tables as T
    plans, write = [], T._write_dealt

    def seen(ranged, *more):
        plans.append(ranged._jdf.queryExecution().executedPlan().toString())
        return write(ranged, *more)

    monkeypatch.setattr(T, "_write_dealt", seen)
    monkeypatch.setattr(T, "_TASK_ROWS", task_rows)
    store = str(tmp_path / "t")
    loads = [T.append_new_rows(spark, offered(spark, 20, 1.0, 4), store, "nodal_prices"),
             T.append_new_rows(spark, offered(spark, 30, 100.0, 5), store, "nodal_prices"),      # more rows than are held
             T.append_new_rows(spark, offered(spark, 25, 500.0), store, "nodal_prices")]         # fewer
    assert [(x.loaded, x.not_loaded) for x in loads] == [(20, 60), (10, 140), (0, 25)]
    found = {r.trading_date: (r.price, r.trading_year) for r in T.read_table(spark, store, "nodal_prices").collect()}
    first = dt.date(2013, 12, 20)
    assert found == {first + dt.timedelta(k): (4.0 if k < 20 else 104.0, (first + dt.timedelta(k)).year) for k in range(30)}
    if task_rows > 3:
        assert [p.split("Initial Plan")[-1].count("Exchange") for p in plans[:2]] == [1, 1]
        assert all("Join" not in p for p in plans[:2]) and all(p.split("Initial Plan")[-1].count("Sort [") == 1 for p in plans[:2])


def test_a_year_of_its_own_is_kept(spark, tmp_path):
    """A batch may name its years; the newest row of a key is told first, whatever its year."""
    from halfhourly.sources import tables as T
    batch = offered(spark, 3, 1.0, 2).withColumn("trading_year", F.when(F.col("price") > 1, 2000).otherwise(1999))
    T.append_new_rows(spark, batch, str(tmp_path / "t"), "nodal_prices")
    found = T.read_table(spark, str(tmp_path / "t"), "nodal_prices").collect()
    assert len(found) == 3 and {(r.price, r.trading_year) for r in found} == {(2.0, 2000)}


def test_lines_are_not_dealt_by_file(spark, tmp_path):
    """headers were joined by a shuffle, which brought a file to one task."""
    from halfhourly.sources import csvfiles as C
    (tmp_path / "named.csv").write_text("Node,Price,Trading_Date,Trading_Period\nN1,1.5,2014-05-01,1\n")
    (tmp_path / "bare.csv").write_text("2014-05-02,2,N2 , 2.5\n2014-05-03,3,N3,\n")
    rows = C.read_csv(spark, str(tmp_path), "nodal_prices", by_name=True)
    assert "hashpartitioning(source_file" not in rows._jdf.queryExecution().executedPlan().toString()
    assert {(r.node, r.price) for r in C.accepted(rows).collect()} == {("N1", 1.5), ("N2", 2.5), ("N3", None)}


def test_cells_without_quotes_are_the_same_as_with(spark):
    from halfhourly.sources.csvfiles import csv_cells
    texts = ["", ",", "a", " a ,b,", "a\nb, c\t,,", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    quoted = F.slice(csv_cells(F.concat(F.col("t"), F.lit(',"q"'))), 1, F.size(csv_cells("t")))
    assert all(r[0] == r[1] for r in df.select(csv_cells("t"), quoted).collect())


def test_records_are_put_together_once(spark, tmp_path):
    """what is done for records over lines was in the plan of the rows, and done again for each of its parts."""
    from halfhourly.sources import csvfiles as C
    (tmp_path / "named.csv").write_text('Node,Price,Remark,Trading_Date,Trading_Period\nN1,1.5,"a\nb",2014-05-01,1\n')
    rows = C.read_csv(spark, str(tmp_path), "nodal_prices", by_name=True)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "collect_list" not in plan
    assert [(r.node, r.price) for r in C.accepted(rows).collect()] == [("N1", 1.5)]


def test_decimals_add_up_without_lists(spark):
    """sums of plain decimals went through a list of entries for each group and a second shuffle."""
    from halfhourly.operators.exact import exact_sums, written_sums
    values = [0.1, 0.2, -0.7, 99999999.9999, 1e8, 123456.123456, -3.0, float("nan"), None, 2.5e-9, 1e16, 899999.0000000001]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values * 3)] + [(7, None), (8, -0.5)], "g int, v double")
    plain = written_sums(df, ["g"], "v", "s")
    want = {tuple(r) for r in exact_sums(df, ["g"], {"s": "v"}).collect()}
    assert {(r.g, r.s, r.s_n) for r in plain.collect()} == want and not any(r.s_odd for r in plain.collect())
    plan = written_sums(df, ["g"], "v", "s")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "collect_list" not in plan
    odd = written_sums(df.unionByName(spark.createDataFrame([(7, 1e-30), (7, float("inf")), (7, 0.25)], df.schema)), ["g"], "v", "s")
    assert {r.g: (r.s, r.s_n, r.s_odd) for r in odd.collect()}[7] == (0.25, 3, 2)


def test_empty_periods_are_not_spread(spark):
    """an array of all periods was made of every row."""
    from halfhourly.operators.reshape import half_hour_to_long
    df = spark.createDataFrame([("A", 0.5, None), ("B", 0.1, 0.2), ("B", 0.2, None), ("C", None, None), ("D", float("nan"), 1e-30),
                                ("E", 1e-30, 1.0), ("E", 1e-30, 2.0)], "poc string, TP1 double, TP02 double")
    long = half_hour_to_long(df, 1.0)
    assert "Generate" not in long._jdf.queryExecution().executedPlan().toString()
    assert {(r.Grid_Point, r.Trading_Period): r.Average_Output for r in long.collect()} == {
        ("A", 1): 0.5, ("B", 1): 0.3, ("B", 2): 0.2, ("D", 2): 1e-30, ("E", 1): 2e-30, ("E", 2): 3.0}
