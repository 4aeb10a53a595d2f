"""Futures: daily summary pages as quotes, and the growing quote series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from halfhourly.functions.dates import expiry_label, is_weekday, summary_page_date
from halfhourly.functions.text import clean_number, spread
from halfhourly.operators.joins import missing_rows
from halfhourly.operators.predicates import larger_than_bytes
from halfhourly.operators.reshape import expiries_of, quotes_to_columns
from halfhourly.schemas import FUTURES_FIELDS, FUTURES_PRODUCTS
from halfhourly.session import path_exists, staged
from halfhourly.sources.markup import page_table

QUOTE_TABLE = 1          # quotes are in the second table of a page
FULL_PAGE_BYTES = 5000   # a page of this size or less is a notice without quotes
# What the first cell of a heading row and of a link row says
HEADING = "Expiry"
GRAPH_LINK = "Click here to view settlement price and volume graph"
# expiry as published -> how it is read
_EXPIRY_SHAPES = ((r"^[A-Za-z]{3} \d{4}$", "MMM yyyy"), (r"^[A-Za-z]{3} \d{2}$", "MMM yy"),
                  (r"^\d{4}$", "yyyy"))


def product_info(product: Column | str, field: int) -> Column:
    """What is fixed for a product: 0 expiry frequency, 1 series name, 2 day before its start."""
    p = F.col(product) if isinstance(product, str) else product
    pairs = [F.lit(x) for code, info in FUTURES_PRODUCTS.items() for x in (code, info[field])]
    return F.try_element_at(F.create_map(*pairs), p)


def parse_expiry(text: Column | str, frequency: Column | str) -> Column:
    """First day of the quarter, month or year an expiry text names."""
    t = F.trim(F.regexp_replace(F.col(text) if isinstance(text, str) else text, "[- ]+", " "))
    date = None
    for shape, pattern in _EXPIRY_SHAPES:
        value = F.try_to_date(t, pattern)
        date = F.when(t.rlike(shape), value) if date is None else date.when(t.rlike(shape), value)
    return expiry_label(date, frequency)


def quotes_of_pages(pages: DataFrame, min_page_bytes: int = FULL_PAGE_BYTES) -> DataFrame:
    """Quotes in daily summary pages (``name``, ``html``), one row per page, product
    and expiry, repeated rows once.

    A row with a single cell heads the rows below it; its first two letters are
    the product.  Only pages of more than ``min_page_bytes`` are read.
    """
    # each page is parsed once: its headings are taken before its rows are spread
    tables = (pages.where(larger_than_bytes("html", min_page_bytes))
              .select("name", summary_page_date("name").alias("quote_date"),
                      page_table("html", QUOTE_TABLE).alias("_table")))
    headings = F.get(F.filter("_table", lambda r: F.get(r, F.lit(0)) == HEADING), F.lit(0))
    numbered, filled = spread(F.col("_table"), "row_no", "cells")
    rows = tables.select("name", "quote_date", headings.alias("headings"), numbered).where(filled)
    rows = rows.withColumn("first", F.get("cells", F.lit(0)))
    body = rows.where(~F.col("first").isin("", HEADING, GRAPH_LINK))
    coded = body.withColumn("code", F.when(F.size("cells") < 2, F.left("first", F.lit(2))))
    # the rows of a page come out of one stored value, which bounds them
    above = Window.partitionBy("name").orderBy("row_no")
    carried = coded.withColumn("product", F.last_value(F.col("code"), True).over(above))
    data = carried.where((F.size("cells") > 1) & F.col("product").isNotNull())
    cell = {f: F.get("cells", F.array_position("headings", f) - 1) for f in FUTURES_FIELDS}
    return (data.select("quote_date", "product",
                        parse_expiry("first", product_info("product", 0)).alias("expiry"),
                        clean_number(cell["Sett"]).alias("sett"),
                        clean_number(cell["Volume"]).alias("volume"),
                        clean_number(cell["Op Int"]).alias("op_int"))
            .dropDuplicates())


def append_new_quotes(held: DataFrame, quotes: DataFrame) -> DataFrame:
    """The series with the quote days it does not have yet; held days stay as they are.

    Days up to the day before a product's start are no quotes of it.
    """
    start = product_info("product", 2)
    fresh = quotes.where(start.isNull() | (F.col("quote_date") > start))
    return held.unionByName(missing_rows(fresh, held, ["product", "quote_date"]))


def append_wide_quotes(quotes: DataFrame, path: str, fields: list[str]) -> int:
    """Adds the quote days that a stored wide table lacks; returns how many rows that were.

    Only the new days are pivoted, to columns of their own expiries, and written beside what is stored; what
    is there is neither read nor written again but for its days. A day that is held keeps its quotes, so
    an append that is run again adds nothing.
    """
    held = _stored_wide(quotes.sparkSession, path)
    if held is not None:
        quotes = missing_rows(quotes, held, ["product", "quote_date"])
    new = staged(quotes.select("product", "quote_date", "expiry", *fields), "wide-quotes")
    expiries = expiries_of(new)
    if not expiries:
        return 0
    written = Observation()
    (quotes_to_columns(new, fields, expiries).observe(written, F.count(F.lit(1)).alias("n"))
     .write.mode("append").parquet(path))
    return written.get["n"]


def read_wide_quotes(spark: SparkSession, path: str) -> DataFrame:
    """The stored wide table; its columns are those of all appends, null where an append had no such expiry."""
    held = _stored_wide(spark, path)
    if held is None:
        return spark.createDataFrame([], "product string, quote_date date")
    return held.select("product", "quote_date", *sorted(set(held.columns) - {"product", "quote_date"}))


def _stored_wide(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.option("mergeSchema", True).parquet(path) if path_exists(spark, path) else None


def refresh_quotes(held: DataFrame, pages: DataFrame, min_page_bytes: int = FULL_PAGE_BYTES) -> DataFrame:
    """The series after reading the weekday pages (``name``, ``html``) of days that some product lacks.

    Each product goes on after its own last day, so one that lags behind is caught up.
    Pages up to the earliest of the last days are told by their names and not parsed.
    """
    ends = held.groupBy("product").agg(F.max("quote_date").alias("last_day"))
    starts = held.sparkSession.createDataFrame([(p, i[2]) for p, i in FUTURES_PRODUCTS.items()],
                                               "product string, last_day date")
    # a product that is not held yet goes on after the day before its start
    known = ends.unionByName(missing_rows(starts, ends, "product"))
    earliest = known.agg(F.min("last_day")).first()[0]
    day = summary_page_date("name")
    later = pages.where(is_weekday(day) & (day > F.lit(earliest)))
    quotes = quotes_of_pages(later.select("name", "html"), min_page_bytes)
    limits = known.select("product", F.col("last_day").alias("_last"))
    fresh = quotes.join(limits, "product", "left").where(
        F.col("_last").isNull() | (F.col("quote_date") > F.col("_last"))).drop("_last")
    return append_new_quotes(held, fresh)


def last_day_held(quotes: DataFrame, products: DataFrame,
                  default: Column | dt.date | None = None) -> DataFrame:
    """Last quote day per product, the day before its start while it has none."""
    day = product_info("product", 2) if default is None else F.lit(default)
    held = quotes.groupBy("product").agg(F.max("quote_date").alias("_last"))
    return (products.select("product").distinct().join(held, "product", "left")
            .select("product", F.coalesce("_last", day).alias("last_day")))


def labelled_quotes(quotes: DataFrame, frequency: Column | str = "Q") -> DataFrame:
    """Quotes with their expiry as the first day of its quarter, month or year."""
    return quotes.withColumn("expiry", expiry_label("expiry", frequency))


def weekdays_to_fetch(last_days: DataFrame, until: Column) -> DataFrame:
    """The weekdays after each product's last day, up to a day."""
    first = F.date_add("last_day", 1)
    days = last_days.where(first <= until).select(
        "product", F.explode(F.sequence(first, until)).alias("quote_date"))
    return days.where(is_weekday("quote_date"))
