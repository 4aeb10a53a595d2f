import datetime as dt

import pytest
from pyspark.sql import functions as F

from halfhourly.functions import dates as D, text as X


def one(spark, column, **values):
    """The value of a column expression over one row of given values."""
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("value,expected", [
    ("2008-01-15", dt.date(2008, 1, 15)),
    ("2008-11-12", dt.date(2008, 11, 12)),
    ("04-05-2014", dt.date(2014, 5, 4)),
    ("4/5/2014", dt.date(2014, 5, 4)),
    ("4.5.2014", dt.date(2014, 5, 4)),
    ("05/14/2014", dt.date(2014, 5, 14)),
    ("20140524", dt.date(2014, 5, 24)),
    ("24/05/2014 16:30", dt.date(2014, 5, 24)),
    ("2014-05-24T16:30:00", dt.date(2014, 5, 24)),
    ("1 January 2014", dt.date(2014, 1, 1)),
    ("1 May 2014", dt.date(2014, 5, 1)),
    ("14 Sep 2014", dt.date(2014, 9, 14)),
])
def test_parse_date(spark, value, expected):
    assert one(spark, D.parse_date("v"), v=value) == expected
    assert D.day(value) == expected


@pytest.mark.parametrize("value", ["31-02-2014", "", "Benmore", "2014", "99/99/2014",
                                   "2014-05-24x", "4-5/2014"])
def test_parse_date_of_no_date(spark, value):
    assert one(spark, D.parse_date("v"), v=value) is None
    with pytest.raises(ValueError):
        D.day(value)


def test_day_of_objects():
    assert D.day(dt.date(2008, 1, 1)) == dt.date(2008, 1, 1)
    assert D.day(dt.datetime(2010, 3, 4)) == dt.date(2010, 3, 4)
    assert D.day(20130517) == dt.date(2013, 5, 17)


@pytest.mark.parametrize("date,period,offset,expected", [
    ("2014-05-24", 33, 30, dt.datetime(2014, 5, 24, 16, 0)),
    ("2013-05-17", 18, 30, dt.datetime(2013, 5, 17, 8, 30)),
    ("2013-06-04", 18, 30, dt.datetime(2013, 6, 4, 8, 30)),
    ("2014-05-24", 33, 0, dt.datetime(2014, 5, 24, 16, 30)),
    ("2014-05-24", 33, 15, dt.datetime(2014, 5, 24, 16, 15)),
    ("2014-04-06", 49, 30, dt.datetime(2014, 4, 6, 0, 0)),      # 50-period day folds
    ("2014-04-06", 50, 30, dt.datetime(2014, 4, 6, 0, 0)),
])
def test_trading_timestamp(spark, date, period, offset, expected):
    got = one(spark, D.trading_timestamp(D.parse_date("d"), "p", offset), d=date, p=period)
    assert got == expected


@pytest.mark.parametrize("value,expected", [
    ("2014032833", dt.datetime(2014, 3, 28, 16, 0)),
    (2014032817, dt.datetime(2014, 3, 28, 8, 0)),
])
def test_trading_timestamp_of_id(spark, value, expected):
    assert one(spark, D.trading_timestamp_of_id("v"), v=value) == expected


def test_period_of_reverses_the_timestamp(spark):
    df = spark.range(1, 49).select(F.col("id").cast("int").alias("p"))
    back = df.select("p", D.period_of(D.trading_timestamp(F.lit(dt.date(2014, 5, 24)), "p"))
                     .alias("q"))
    assert back.where("p <> q").count() == 0


@pytest.mark.parametrize("name,expected", [
    ("path/to/filename2004", "2004"), ("path/to/filename200406", "2004"),
    ("path/to/filename20040628", "2004"), ("path/1999/filename20040628", "2004"),
    ("path/to/filename05_20040628", None), ("path/to/none", None), ("x20049928.csv", None),
])
def test_file_year(spark, name, expected):
    assert one(spark, D.file_year("v"), v=name) == expected


def days(spark, name, *args):
    return one(spark, D.days_of_file("v", *args), v=name)


def test_days_of_file(spark):
    assert days(spark, "/a/offers20140813.csv", "offers", ".csv") == [dt.date(2014, 8, 13)]
    assert days(spark, "%2Fa%2Foffers20140813.csv.Z", "offers", ".csv.Z") == [dt.date(2014, 8, 13)]
    assert len(days(spark, "offers201402.csv", "offers", ".csv")) == 28
    assert days(spark, "offers_notes.csv", "offers", ".csv") == []
    assert days(spark, "20140813_Final_FK_offers.xml", "Final_FK_offers", ".XML") == [dt.date(2014, 8, 13)]
    assert days(spark, "FP_20140813_F.gdx", "FP_", ".gdx") == [dt.date(2014, 8, 13)]
    assert days(spark, "FP_20140813_I.gdx", "FP_", ".gdx") == []
    assert days(spark, "201408_Final_pricing.csv", "Final_prices", ".csv", "Final_pricing",
                "Monthly") == [dt.date(2014, 8, 1)]
    assert days(spark, "prices2014.csv", "prices", ".csv", None, "Yearly") == [dt.date(2014, 1, 1)]
    with pytest.raises(ValueError):
        D.days_of_file("v", "prices", ".csv", None, "Hourly")


def test_names_and_labels(spark):
    assert one(spark, D.link_text_date("v"), v="  1   January 2014 ") == dt.date(2014, 1, 1)
    assert one(spark, D.link_text_date("v"), v="January") is None
    assert one(spark, D.summary_page_date("v"),
               v="/htm/EODWebMarketSummary140108ZFT.htm") == dt.date(2014, 1, 8)
    assert one(spark, D.summary_page_name(F.lit(dt.date(2014, 1, 8)))) == \
        "EODWebMarketSummary140108ZFT.htm"
    assert one(spark, D.clock_text("v"), v="1:05 PM") == "13:05"
    assert one(spark, D.clock_text("v"), v="12:00 am") == "00:00"
    assert one(spark, D.clock_text("v"), v="9:30") == "09:30"
    assert one(spark, D.clock_text("v"), v="noon") is None
    joined = D.join_days(F.array(F.lit(dt.date(2009, 5, 14)), F.lit(dt.date(2012, 3, 31))))
    assert one(spark, joined) == "14-05-2009','31-03-2012"
    other = D.join_days(F.array(F.lit(dt.date(2009, 5, 14)), F.lit(dt.date(2012, 3, 31))),
                        '","', "dd/MM/yyyy")
    assert one(spark, other) == '14/05/2009","31/03/2012'
    for frequency, first in (("Q", (2014, 4, 1)), ("M", (2014, 5, 1)), ("A", (2014, 1, 1))):
        assert one(spark, D.expiry_label(F.lit(dt.date(2014, 5, 24)), frequency)) == dt.date(*first)


def test_numbers(spark):
    for text, want in (("1,234.5", 1234.5), ("-", None), ("", None), ("-3.25", -3.25),
                       (" 7 ", 7.0), ("n/a", None)):
        assert one(spark, X.clean_number("v"), v=text) == want
    for text, n, want in (("12°C", 2, 12.0), ("85%", 1, 85.0), ("1013hPa", 3, 1013.0),
                          ("-2.5°C", 2, -2.5), ("", 2, None), ("°C", 2, None), ("x°C", 2, None)):
        assert one(spark, X.strip_unit("v", n), v=text) == want


def test_words_and_links(spark):
    assert one(spark, X.first_word("v"), v="Lake Taupo") == "Lake"
    assert one(spark, X.last_word("v"), v="2014 stored") == "stored"
    assert one(spark, X.word("v", -2, ","), v="a,b,c") == "b"
    assert one(spark, X.word("v", 9), v="a b") is None
    assert one(spark, X.base_name("v"), v="/a/b/c.csv") == "c.csv"
    assert one(spark, X.digit_runs("v"), v="a1b22") == ["1", "22"]
    for tag, want in (('<a href="/x?a=1&amp;b=2">t</a>', "/x?a=1&b=2"), ("<a href='/y'>t</a>", "/y"),
                      ("<A class=k HREF=/z>t</A>", "/z"), ('<a data-href="/no">t</a>', ""),
                      ('<a\nid="q"\nhref = "/w">t</a>', "/w")):
        assert one(spark, X.href_of("v"), v=tag) == want
