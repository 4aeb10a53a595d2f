import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from halfhourly.operators import predicates as P
from halfhourly.sources.tables import write_rows


@pytest.fixture(scope="module")
def demand(spark):
    """A row per day over three years and three nodes."""
    days = spark.range(0, 1096).select(
        F.date_add(F.lit(dt.date(2012, 1, 1)), F.col("id").cast("int")).alias("trading_date"),
        (F.col("id") % 48 + 1).cast("int").alias("trading_period"),
        F.element_at(F.array(F.lit("OTA2201"), F.lit("TWC2201"), F.lit(None)),
                     (F.col("id") % 3 + 1).cast("int")).alias("node"),
        (F.col("id") % 7).cast("double").alias("demand"))
    return days.withColumn("trading_year", F.year("trading_date"))


@pytest.fixture(scope="module")
def stored(spark, demand, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store") / "nodal_demand")
    write_rows(demand, path, "nodal_demand")
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_values(demand):
    assert demand.where(P.selected("trading_period", 18)).count() == 23
    assert demand.where(P.selected("trading_period", (18, 19))).count() == 46
    assert demand.where(P.selected("trading_period", "18")).count() == 23
    nulls = demand.where("node IS NULL").count()
    assert demand.where(P.excluded("node", "TWC2201")).count() == 1096 - nulls - 365
    assert demand.where(P.excluded("node", ["TWC2201", "x"])).count() == 1096 - nulls - 365
    for low in ("3", 3, 3.0):
        assert demand.where(P.at_least("demand", low)).count() == \
            demand.where("demand >= 3").count()
        assert demand.where(P.at_most("demand", low)).count() == \
            demand.where("demand <= 3").count()
    for begin, end in (("2", "4"), (2, 4), (1.5, 4.5)):
        assert demand.where(P.between("demand", begin, end)).count() == \
            demand.where("demand BETWEEN 2 AND 4").count()


def test_list_forms_refuse_a_scalar():
    for bad in (467, "text"):
        with pytest.raises(TypeError):
            P.one_of("c", bad)
        with pytest.raises(TypeError):
            P.none_of("c", bad)


def test_required_range():
    for bad in ((None, None, None), ([], None, None), ("2014-01-01", "2014-01-01", "2014-01-02"),
                (None, "2014-01-01", None), (None, None, "2014-01-01")):
        with pytest.raises(ValueError):
            P.check_required_range(*bad)
    P.check_required_range("2014-01-01")
    P.check_required_range(None, "2014-01-01", "2014-01-02")


def test_optional_range():
    P.check_optional_range()
    P.check_optional_range([1, 2])
    P.check_optional_range(None, 0, 3)
    for bad in (([1], 1, 2), (None, 1, None), (None, None, 2)):
        with pytest.raises(ValueError):
            P.check_optional_range(*bad)


def test_date_filter_errors(demand):
    with pytest.raises(ValueError):
        P.date_filter(demand)
    with pytest.raises(ValueError):
        P.date_filter(demand, begin_date="2013-01-02", end_date="2013-01-01")
    with pytest.raises(ValueError):
        P.date_filter(demand, "2013-01-02", range_break="Week")


def test_a_range_is_the_union_of_its_slices(demand, rows):
    whole = rows(P.date_filter(demand, begin_date="20/12/2012", end_date="10/02/2014"))
    assert len(whole) == (dt.date(2014, 2, 10) - dt.date(2012, 12, 20)).days + 1
    years = [("2012-12-20", "2012-12-31"), ("2013-01-01", "2013-12-31"), ("2014-01-01", "2014-02-10")]
    assert sorted((r for b, e in years for r in rows(
        P.date_filter(demand, begin_date=b, end_date=e))), key=repr) == whole
    assert rows(P.date_filter(demand, begin_date="2012-12-20", end_date="2014-02-10",
                              range_break="Month")) == whole


@settings(max_examples=15, deadline=None, derandomize=True)
@given(begin=st.dates(dt.date(2011, 12, 1), dt.date(2015, 1, 31)), length=st.integers(0, 900))
def test_any_range_holds_the_days_between(demand, begin, length):
    end = begin + dt.timedelta(days=length)
    first, last = max(begin, dt.date(2012, 1, 1)), min(end, dt.date(2014, 12, 31))
    assert P.date_filter(demand, begin_date=begin, end_date=end.strftime("%d/%m/%Y")).count() == \
        max((last - first).days + 1, 0)


def test_dates_in_any_form(demand):
    wanted = ["14-05-2013", 20120331, dt.date(2014, 7, 8), dt.datetime(2014, 7, 8, 3)]
    assert P.date_filter(demand, wanted).count() == 3
    assert P.date_filter(demand, "14-05-2013").count() == 1
    assert P.date_filter(demand, "14-05-1913").count() == 0


def test_years_are_pruned(stored):
    # only the years asked for are listed, and the date bounds reach the scan
    ranged = plan(P.date_filter(stored, begin_date="2012-12-20", end_date="2013-02-10"))
    assert "trading_year" in ranged.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(trading_date" in ranged
    listed = plan(P.date_filter(stored, ["2012-12-20", "2014-02-10"]))
    assert "trading_year" in listed.split("PartitionFilters: [")[1].split("]")[0]
    assert P.date_filter(stored, ["2012-12-20", "2014-02-10"]).count() == 2


def test_timestamps_are_filtered_as_stored(spark, tmp_path):
    path = str(tmp_path / "stamps")
    (spark.range(96).select(F.timestamp_add(
        "MINUTE", F.col("id") * 30, F.lit(dt.datetime(2014, 5, 24)).cast("timestamp_ntz"))
        .alias("stamp")).write.parquet(path))
    stamps = spark.read.parquet(path)
    day = P.date_filter(stamps, "2014-05-25", date_col="stamp")
    assert day.count() == 48
    assert "GreaterThanOrEqual(stamp" in plan(day) and "LessThan(stamp" in plan(day)
    assert P.date_filter(stamps, begin_date="2014-05-24", end_date="2014-05-25",
                         date_col="stamp").count() == 96
    assert P.date_filter(stamps, ["2014-05-24", "2014-05-26"], date_col="stamp").count() == 48
    assert P.date_filter(stamps, ["2014-05-25", "2014-05-24"], date_col="stamp").count() == 96


def test_periods_and_sets(demand):
    assert P.period_filter(demand, [1, 2]).count() == 46
    assert P.period_filter(demand, begin_period=1, end_period=2).count() == 46
    assert P.period_filter(demand).count() == 1096
    assert len(P.named_nodes("Core")) == 8 and len(P.named_nodes("Major")) == 3
    assert P.named_nodes("BEN2201") == "BEN2201"
    assert P.choose(demand, node=P.named_nodes("Major")).count() == 366
    assert P.leave_out(demand, node=P.named_nodes("Wind")).count() == 366
    assert P.choose(demand, node=None).count() == P.choose(demand, node=[]).count() == 1096
