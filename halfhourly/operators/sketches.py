"""Quantile sketches per day and group: kept beside a table, merged for any range of days.

A sketch holds a sample of some hundred values whose ranks are known within a stated share of the rows.
Sketches of days add up to the sketch of a range, so its quantiles need no row of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from halfhourly.functions.dates import day

#: Size of a sketch, and the share of rows by which a rank may be off at that size (in 99 of 100 cases).
SIZE, RANK_ERROR = 800, 0.005


def day_sketches(df: DataFrame, keys: list[str], col: str, date_col: str = "trading_date", size: int = SIZE) -> DataFrame:
    """A sketch of ``col`` per group and day."""
    value = F.col(col).cast("double")
    return (df.where(value.isNotNull() & ~F.isnan(value)).groupBy(*keys, date_col)
            .agg(F.kll_sketch_agg_double(value, F.lit(size)).alias("sketch")))


def add_sketches(sketches: DataFrame, path: str, date_col: str = "trading_date") -> None:
    """Adds sketches of further days, or of further rows of a day, to a stored table of them."""
    year = F.year(date_col).alias("trading_year")
    (sketches.select("*", year).repartition("trading_year").sortWithinPartitions(date_col)
     .write.mode("append").partitionBy("trading_year").parquet(path))


def range_sketches(spark: SparkSession, path: str, keys: list[str], begin, end,
                   date_col: str = "trading_date") -> DataFrame:
    """One sketch per group over a range of days, from the stored ones alone."""
    first, last = day(begin), day(end)
    held = spark.read.parquet(path).where(F.col("trading_year").between(first.year, last.year)
                                          & F.col(date_col).between(F.lit(first), F.lit(last)))
    return held.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, keys: list[str], probabilities: list[float]) -> DataFrame:
    """``keys``, ``probability``, ``value`` and the number ``n`` of rows a sketch stands for."""
    pairs = F.array(*[F.struct(F.lit(float(p)).alias("probability"),
                               F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value"))
                      for p in probabilities])
    return sketches.select(*keys, F.kll_sketch_get_n_double("sketch").alias("n"), F.inline(pairs))
