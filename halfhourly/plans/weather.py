"""Hourly weather: which location days are missing, and stored pages as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from halfhourly.functions.dates import clock_text, day
from halfhourly.functions.text import spread, strip_unit
from halfhourly.operators.joins import missing_rows, value_day_grid
from halfhourly.schemas import WEATHER_LOCATIONS
from halfhourly.sources.csvfiles import header_name
from halfhourly.sources.markup import page_table

WEATHER_TABLE = 14       # the fifteenth table of a page
# column -> letters of the unit behind its numbers
UNIT_LETTERS = {"temperature": 2, "dewpoint": 2, "humidity": 1, "barometer": 3, "visibility": 2,
                "wind_speed": 4, "gust_speed": 4}
TEXT_COLUMNS = ("wind_direction", "precipitation", "events", "conditions")


def wanted_pages(spark: SparkSession, begin, end, locations=WEATHER_LOCATIONS) -> DataFrame:
    """Each location with each day of a range."""
    places = spark.range(1).select(
        F.explode(F.array(*[F.lit(name) for name in locations])).alias("location"))
    return value_day_grid(places, F.lit(day(begin)), F.lit(day(end)))


def missing_location_days(wanted: DataFrame, held: DataFrame) -> DataFrame:
    return missing_rows(wanted, held, ["location", "trading_date"])


def page_file_name(location: Column | str, date: Column | str) -> Column:
    """The name a location day is stored under."""
    place = F.col(location) if isinstance(location, str) else location
    return F.concat_ws("_", F.replace(place, F.lit("-"), F.lit("_")),
                       F.concat(F.date_format(date, "yyyyMMdd"), F.lit(".csv")))


def weather_of_pages(pages: DataFrame, table_no: int = WEATHER_TABLE) -> DataFrame:
    """Hourly rows of weather pages (``location``, ``trading_date``, ``html``).

    The first row of the table names the columns; pages without the table give no
    rows.
    """
    keys = ["location", "trading_date"]
    tables = pages.select(*keys, page_table("html", table_no).alias("_table"))
    headings = F.transform(F.get("_table", F.lit(0)), header_name)
    numbered, _ = spread(F.col("_table"), "row_no", "cells")
    data = tables.select(*keys, headings.alias("headings"), numbered).where(F.col("row_no") > 0)

    def cell(name: str):
        return F.get("cells", F.array_position("headings", name) - 1)

    return data.select(
        *keys, clock_text(cell("local_time")).alias("local_time"),
        *[strip_unit(cell(n), letters).alias(n) for n, letters in UNIT_LETTERS.items()],
        *[cell(n).alias(n) for n in TEXT_COLUMNS])
