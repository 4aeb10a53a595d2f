"""Lake files: a head of five lines that names lake and measure, then daily rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from halfhourly.functions.dates import parse_date
from halfhourly.functions.text import first_word, last_word, spread
from halfhourly.schemas import LAKE_MEASURES

HEAD_LINES = 5


def read_lakes(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """All lake files below a path as rows; see :func:`lake_rows`."""
    return lake_rows(spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
                     .select("value", F.col("_metadata.file_path").alias("source_file")))


def lake_rows(files: DataFrame) -> DataFrame:
    """Lake files (``value``, ``source_file``) as daily rows.

    Columns ``trading_date, lake, measure, unit, value, source_file``; ``measure``
    is the word of the file (stored, inflow, cusum).
    """
    lines = F.split("value", r"\r?\n")
    fields = F.split(F.get(lines, F.lit(HEAD_LINES - 1)), ",")
    measure = last_word(F.trim(F.try_element_at(fields, F.lit(-2))))
    numbered, _ = spread(lines, "line_no", "line")
    rows = files.select("source_file", first_word(F.get(lines, F.lit(0))).alias("lake"),
                        measure.alias("measure"), numbered)
    cells = F.split("line", ",")
    return (rows.where((F.col("line_no") >= HEAD_LINES) & (F.trim("line") != ""))
            .select(parse_date(F.get(cells, F.lit(0))).alias("trading_date"), "lake", "measure",
                    measure_info("measure", 1).alias("unit"),
                    F.trim(F.get(cells, F.lit(2))).try_cast("double").alias("value"),
                    "source_file"))


def measure_info(measure: Column | str, field: int) -> Column:
    """What is fixed for a lake measure: 0 its name, 1 its unit."""
    m = F.col(measure) if isinstance(measure, str) else measure
    pairs = [F.lit(x) for word, info in LAKE_MEASURES.items() for x in (word, info[field])]
    return F.try_element_at(F.create_map(*pairs), m)


def lake_table(rows: DataFrame, measure: str) -> DataFrame:
    """The rows of one measure in the shape of its table."""
    _, _, _, value_col = LAKE_MEASURES[measure]
    return rows.where(F.col("measure") == measure).select(
        "trading_date", F.col("value").alias(value_col), "lake", "unit")


def series_files(rows: DataFrame) -> DataFrame:
    """First and last day of each lake and measure and the file name made from them."""
    name = measure_info("measure", 0)
    return rows.groupBy("lake", "measure").agg(
        F.min("trading_date").alias("first_day"),
        F.max("trading_date").alias("last_day")).withColumn(
        "file_name", F.concat(F.replace(F.concat_ws(
            "_", "lake", name, F.date_format("first_day", "yyyyMMdd"),
            F.date_format("last_day", "yyyyMMdd")), F.lit(" "), F.lit("_")), F.lit(".csv")))
