"""Which days are held, which are published, and what is still to fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from halfhourly.functions.dates import days_of_file, is_weekday, link_text_date, day
from halfhourly.functions.text import base_name, decode_link, spread
from halfhourly.operators.joins import missing_rows
from halfhourly.schemas import Seed


def calendar(spark: SparkSession, begin, end, weekdays: bool = False,
             col: str = "day") -> DataFrame:
    """Every day, or every weekday, of an inclusive range."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(day(begin)), F.lit(day(end)))).alias(col))
    return days.where(is_weekday(col)) if weekdays else days


def month_slice(date: Column | str, begin, end) -> tuple[Column, Column]:
    """First and last day of the month slice of a range that a date lies in."""
    d = F.col(date) if isinstance(date, str) else date
    return (F.greatest(F.trunc(d, "month"), F.lit(day(begin))),
            F.least(F.last_day(d), F.lit(day(end))))


def month_slices(spark: SparkSession, begin, end) -> DataFrame:
    """The month slices of a range; one slice when it holds no month end."""
    months = calendar(spark, begin, end, col="d").select(F.trunc("d", "month").alias("d")).distinct()
    first, last = month_slice("d", begin, end)
    return months.select(first.alias("slice_begin"), last.alias("slice_end"))


def named_days(names: DataFrame, pattern: str, ext: str, rename: str | None = None,
               date_type: str = "Daily", name_col: str = "name",
               date_col: str = "trading_date") -> DataFrame:
    """A row per day a file name or link stands for, next to the given columns."""
    numbered, filled = spread(days_of_file(name_col, pattern, ext, rename, date_type),
                              "_day_no", date_col)
    return names.select("*", numbered).where(filled).drop("_day_no")


def days_held(spark: SparkSession, folder: str, seed: Seed) -> DataFrame:
    """Distinct days of the files in a folder, read off their names only."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*" + seed.extension)
             .load(folder).select(F.col("path").alias("name")))
    return named_days(files, seed.pattern, seed.extension, seed.rename,
                      seed.date_type).select("trading_date").distinct()


def matching_links(links: DataFrame, pattern: str, match_type: str = "href") -> DataFrame:
    """Links whose file name (``href``) or text (``text``) contains a pattern."""
    if match_type == "href":
        return links.where(base_name("href").contains(pattern))
    if match_type == "text":
        return links.where(F.col("text").contains(pattern))
    raise ValueError(f"match type {match_type!r}: use href or text")


def link_days(links: DataFrame, pattern: str, ext: str, rename: str | None = None,
              date_type: str = "Daily", order: list[str] | None = None) -> DataFrame:
    """Published days and their link; for a day linked twice the later link stays.

    ``order`` names the columns that say which link is later.  Links of the demand
    pages carry their date in the text.
    """
    order = order or ["link_no"]
    if pattern == "DemandDaily":
        dated = links.withColumn("trading_date", link_text_date("text"))
        dated = dated.where(F.col("trading_date").isNotNull())
    else:
        decoded = links.withColumn("href", decode_link("href"))
        dated = named_days(decoded, pattern, ext, rename, date_type, "href")
    return dated.groupBy("trading_date").agg(
        F.max(F.struct(*order, "href")).alias("_link")).select("trading_date", "_link.href")


def seed_days(links: DataFrame, seed: Seed, order: list[str] | None = None) -> DataFrame:
    """:func:`link_days` of one published source."""
    return link_days(matching_links(links, seed.pattern, seed.match_type), seed.pattern,
                     seed.extension + seed.compression, seed.rename, seed.date_type, order)


def manifest(published: DataFrame, held: DataFrame) -> DataFrame:
    """The links of days not held yet, each link once."""
    return missing_rows(published, held, "trading_date").select("href").distinct()


def unloaded_dates(batch: DataFrame, table: DataFrame, col: str = "trading_date") -> DataFrame:
    """Distinct dates of a batch that a table lacks."""
    return missing_rows(batch.select(col).where(F.col(col).isNotNull()).distinct(), table, col)
