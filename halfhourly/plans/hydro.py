"""Lake series: the current year's column, the day shift, lakes side by side, risk."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from halfhourly.operators.ordered import next_value, quantiles
from halfhourly.operators.reshape import lakes_to_columns

RISK_PROBABILITIES = [0.1, 0.5, 0.9]


def year_of_series(lakes: DataFrame, year: int) -> DataFrame:
    """The days of one year, asked as a date range so the scan can skip files."""
    return lakes.where(F.col("trading_date").between(
        F.make_date(F.lit(year), F.lit(1), F.lit(1)),
        F.make_date(F.lit(year), F.lit(12), F.lit(31))))


def shift_to_day_before(lakes: DataFrame, value: str = "lake_levels") -> DataFrame:
    """Values stamped one day late moved to the day before; each lake's last day drops."""
    return next_value(lakes, ["lake"], "trading_date", value)


def lake_matrix(lakes: DataFrame, names: list[str], value: str = "lake_levels") -> DataFrame:
    return lakes_to_columns(lakes, names, value)


def storage_by_day_of_year(lakes: DataFrame, value: str = "lake_levels",
                           probabilities: list[float] | None = None) -> DataFrame:
    """Storage quantiles per lake and day of the year: the hydro risk curve."""
    days = lakes.select("lake", F.dayofyear("trading_date").alias("day_of_year"), value)
    return quantiles(days, ["lake", "day_of_year"], value, probabilities or RISK_PROBABILITIES)
