"""Filters of the market queries, as column predicates and DataFrame steps.

Nulls drop out of every one of them, as in SQL.  Values are passed on with
their own type, so they reach the scan as pushed filters.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from halfhourly.functions.dates import day
from halfhourly.schemas import NODE_SETS


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_scalar(value) -> bool:
    """Text counts as one value, any other iterable as several."""
    return isinstance(value, (str, bytes)) or not isinstance(value, Iterable)


def _list(values) -> list:
    if is_scalar(values):
        raise TypeError(f"a list of values is needed, not {values!r}")
    return list(values)


# --- One column against values -------------------------------------------------

def equal_to(col, value) -> Column:
    return _c(col) == F.lit(value)


def one_of(col, values) -> Column:
    return _c(col).isin(_list(values))


def selected(col, values) -> Column:
    """``=`` for one value, ``IN`` for several."""
    return equal_to(col, values) if is_scalar(values) else one_of(col, values)


def not_equal_to(col, value) -> Column:
    return _c(col) != F.lit(value)


def none_of(col, values) -> Column:
    return ~_c(col).isin(_list(values))


def excluded(col, values) -> Column:
    """``!=`` for one value, ``NOT IN`` for several."""
    return not_equal_to(col, values) if is_scalar(values) else none_of(col, values)


def at_least(col, value) -> Column:
    return _c(col) >= F.lit(value)


def at_most(col, value) -> Column:
    return _c(col) <= F.lit(value)


def between(col, begin, end) -> Column:
    """Both ends included."""
    return _c(col).between(F.lit(begin), F.lit(end))


def larger_than_bytes(col, size: int) -> Column:
    return F.octet_length(_c(col)) > size


def named_nodes(nodes):
    """A node set by its name (Core, Major, Wind), anything else as given."""
    return NODE_SETS.get(nodes, nodes) if isinstance(nodes, str) else nodes


# --- Guards --------------------------------------------------------------------

def check_required_range(specific=None, begin=None, end=None) -> None:
    """Exactly one of "specific values" and "begin and end" must be given."""
    if not _given(specific) and begin is None and end is None:
        raise ValueError("pass dates, or both begin_date and end_date")
    check_optional_range(specific, begin, end)


def check_optional_range(specific=None, begin=None, end=None) -> None:
    """Not both specific values and a range, and no half range."""
    if (begin is None) != (end is None):
        raise ValueError("pass both ends of a range")
    if _given(specific) and begin is not None:
        raise ValueError("pass either specific values or a range, not both")


def settled(values):
    """One value as it is, several as a list, so that an iterator can be read twice."""
    return values if values is None or is_scalar(values) else list(values)


def _given(values) -> bool:
    return values is not None and (is_scalar(values) or len(list(values)) > 0)


# --- Date filter ---------------------------------------------------------------

def date_filter(df: DataFrame, dates=None, begin_date=None, end_date=None,
                date_col: str = "trading_date", year_col: str = "trading_year",
                range_break: str = "Year") -> DataFrame:
    """Rows of one date, of a list of dates, or of an inclusive date range.

    The same years are asked of ``year_col`` where the table has one: Spark only
    prunes partitions by a predicate on the partition column itself.  On a
    timestamp column the filter is written as half-open ranges of the bare
    column, because a cast would keep it from reaching the scan.

    ``range_break`` names the slicing of a range; rows are the same for both
    slicings because Spark plans the scan as one.
    """
    if range_break not in ("Year", "Month"):
        raise ValueError(f"range break {range_break!r}: use Year or Month")
    dates = settled(dates)
    check_required_range(dates, begin_date, end_date)
    if _given(dates):
        days = sorted({day(d) for d in ([dates] if is_scalar(dates) else dates)})
        wanted, years = _on_days(df, date_col, days), {d.year for d in days}
        prune = F.col(year_col).isin(sorted(years))
    else:
        begin, end = day(begin_date), day(end_date)
        if begin > end:
            raise ValueError(f"begin date {begin} lies after end date {end}")
        wanted = _in_days(df, date_col, begin, end)
        prune = F.col(year_col).between(begin.year, end.year)
    return df.where(prune & wanted if year_col in df.columns else wanted)


def on_days_of(df: DataFrame, days: DataFrame, date_col: str = "trading_date",
               year_col: str = "trading_year", days_col: str = "trading_date") -> DataFrame:
    """Rows of the dates of another DataFrame, however many.

    The dates are joined by year and date, so Spark asks them at run time which years to read of a table
    that has them as partitions; nothing is gathered and no list of thousands of dates is planned.
    """
    # the bound tells the optimizer that the dates are worth asking
    wanted = days.where(F.col(days_col) >= F.lit("0001-01-01").cast("date")).select(
        F.col(days_col).cast("date").alias("_day")).distinct()
    rows = df
    day_of = F.col(date_col).cast("date")
    if year_col in df.columns:
        wanted = wanted.select("_day", F.year("_day").alias("_year"))
        same = (rows[year_col] == F.col("_year")) & (day_of == F.col("_day"))
    else:
        same = day_of == F.col("_day")
    return rows.join(wanted, same, "left_semi")


def _is_timestamp(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, (T.TimestampNTZType, T.TimestampType))


def _in_days(df: DataFrame, col: str, begin, end) -> Column:
    if not _is_timestamp(df, col):
        return F.col(col).between(F.lit(begin), F.lit(end))
    kind = df.schema[col].dataType
    return ((F.col(col) >= F.lit(begin).cast(kind))
            & (F.col(col) < F.date_add(F.lit(end), 1).cast(kind)))


def _on_days(df: DataFrame, col: str, days: list) -> Column:
    if not _is_timestamp(df, col):
        return F.col(col) == F.lit(days[0]) if len(days) == 1 else F.col(col).isin(days)
    runs: list[list] = []
    for d in days:
        if runs and (d - runs[-1][1]).days == 1:
            runs[-1][1] = d
        else:
            runs.append([d, d])
    return functools.reduce(operator.or_, [_in_days(df, col, b, e) for b, e in runs])


def period_filter(df: DataFrame, periods=None, begin_period=None, end_period=None,
                  col: str = "trading_period") -> DataFrame:
    """Rows of given trading periods or of an inclusive range of them."""
    periods = settled(periods)
    check_optional_range(periods, begin_period, end_period)
    if _given(periods):
        return df.where(selected(col, periods))
    if begin_period is not None:
        return df.where(between(col, begin_period, end_period))
    return df


def value_filter(df: DataFrame, col: str, minimum=None, maximum=None) -> DataFrame:
    if minimum is not None:
        df = df.where(at_least(col, minimum))
    if maximum is not None:
        df = df.where(at_most(col, maximum))
    return df


def choose(df: DataFrame, **values) -> DataFrame:
    """Rows whose columns have the given value or one of the given values."""
    for col, wanted in values.items():
        wanted = settled(wanted)
        if _given(wanted):
            df = df.where(selected(col, wanted))
    return df


def leave_out(df: DataFrame, **values) -> DataFrame:
    """Rows whose columns have none of the given values."""
    for col, unwanted in values.items():
        unwanted = settled(unwanted)
        if _given(unwanted):
            df = df.where(excluded(col, unwanted))
    return df
