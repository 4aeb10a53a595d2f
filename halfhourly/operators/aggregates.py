"""Grouped aggregates over market rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from halfhourly.operators.exact import exact_sums, is_floating, present
from halfhourly.operators.inparts import InParts, aggregate_in_parts
from halfhourly.operators.ordered import quantiles
from halfhourly.session import staged

# aggregate name -> column aggregate; sums, means and "median" are worked out apart, see below
AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "min": F.min, "max": F.max,
    "count": F.count, "std": F.stddev_samp, "var": F.var_samp,
    "prod": F.product, "nunique": F.count_distinct, "size": lambda c: F.count(F.lit(1)),
}
SUMS, MEANS, ENDS, MEDIAN = ("sum",), ("mean", "avg"), ("first", "last"), "median"

# pandas, numpy and Python functions that are one of the named aggregates
KNOWN = {pd.Series.sum: "sum", np.sum: "sum", sum: "sum", pd.Series.mean: "mean", np.mean: "mean",
         pd.Series.min: "min", np.min: "min", min: "min", pd.Series.max: "max", np.max: "max", max: "max",
         pd.Series.median: "median", np.median: "median", pd.Series.count: "count", len: "size",
         pd.Series.std: "std", pd.Series.var: "var", pd.Series.nunique: "nunique", pd.Series.prod: "prod",
         np.prod: "prod"}


def group_by_meta(df: DataFrame, meta_group, meta_agg) -> DataFrame:
    """Group by any columns and aggregate the others.

    ``meta_agg`` is an aggregate name, a list of names, a mapping from column to
    name(s), a list of aggregate columns, or a function.  Names and functions apply to every
    numeric column outside the group.  One name keeps the column's name; several give
    ``column_name``.  Null group keys drop out.

    A function may take a column and return an aggregate column, or take a pandas series and
    return a number. Of the latter, those in ``KNOWN`` are aggregated in parts like their names;
    any other needs a whole group in one task, see :func:`aggregate_series`. An aggregate of one's own that is taken
    in parts, whatever the size of groups, is an object, see :mod:`halfhourly.operators.inparts`.
    ``first`` and ``last`` go by date and period, then by all other columns. NaN counts as missing, like null;
    sums and means of floating numbers are exact, see :mod:`halfhourly.operators.exact`.
    """
    keys = [meta_group] if isinstance(meta_group, str) else list(meta_group)
    absent = [k for k in keys if k not in df.columns]
    if absent:
        raise ValueError(f"no such columns to group by: {absent}")
    kept = df.where(_all_present(keys))
    if not isinstance(meta_agg, Mapping) and _is_columns(meta_agg):
        return kept.groupBy(*keys).agg(*([meta_agg] if isinstance(meta_agg, Column) else meta_agg))
    plan = _plan(df, keys, meta_agg)
    floating = {c for c, _, _ in plan if is_floating(df.schema[c].dataType)}
    kept = kept.withColumns({c: present(F.col(c)) for c in sorted(floating)})
    plain, summed, apart = [], {}, []
    for c, make, alias in plan:
        if not isinstance(make, InParts) and make in SUMS + MEANS and c in floating:
            summed.setdefault(c, []).append((make, alias))
        elif isinstance(make, InParts) or make == MEDIAN or (column := _made(df, c, make)) is None:
            apart.append((c, make, alias))
        else:
            plain.append(column.alias(alias))
    if bool(plain) + bool(summed) + len(apart) > 1:
        # the rows are worked out once, for all that is taken from them
        wide = any(isinstance(make, str) and make in ENDS for _, make, _ in plan)
        kept = staged(kept if wide else kept.select(*dict.fromkeys([*keys, *(c for c, _, _ in plan)])), "group")
    results = [kept.groupBy(*keys).agg(*plain)] if plain else []
    if summed:
        results.append(_sums(kept, keys, summed))
    results += [_apart(kept, keys, *one) for one in apart]
    if not plain and not summed:
        results.insert(0, kept.select(*keys).distinct())
    result = results[0]
    for other in results[1:]:
        result = result.join(other, keys, "left")
    return result.select(*keys, *[alias for _, _, alias in plan])


def _sums(kept: DataFrame, keys: list[str], summed: Mapping[str, list]) -> DataFrame:
    """Exact sums and means of floating columns."""
    names = {f"_sum{i}": c for i, c in enumerate(summed)}
    sums = exact_sums(kept, keys, names)
    return sums.select(*keys, *[(F.col(n) if make in SUMS else F.col(n) / F.col(f"{n}_n")).alias(alias)
                                for n, c in names.items() for make, alias in summed[c]])


def _apart(kept: DataFrame, keys: list[str], col: str, make, alias: str) -> DataFrame:
    """An aggregate with a plan of its own."""
    if isinstance(make, InParts):
        return aggregate_in_parts(kept, keys, col, make, alias)
    if make == MEDIAN:
        return quantiles(kept, keys, col, [0.5]).select(*keys, F.col("value").alias(alias))
    return aggregate_series(kept, keys, col, make, alias)


def _made(df: DataFrame, col: str, make) -> Column | None:
    """An aggregate of a column, None for a function of pandas series."""
    if isinstance(make, InParts):
        return None
    if make in SUMS or make in MEANS:
        return F.sum(col) if make in SUMS else F.sum(col).cast("double") / F.count(col)
    if make in ENDS:
        dated = [c for c in ("trading_date", "trading_period") if c in df.columns]
        place = F.struct(*dated, *[c for c in df.columns if c not in dated])
        return (F.min_by if make == "first" else F.max_by)(col, F.when(F.col(col).isNotNull(), place))
    if make in AGGREGATES:
        return AGGREGATES[make](F.col(col))
    try:
        made = make(F.col(col))
    except Exception:  # noqa: BLE001 - it is no function of a column
        return None
    return made if isinstance(made, Column) else None


def _all_present(keys: list[str]) -> Column:
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return present


def _is_columns(agg) -> bool:
    return isinstance(agg, Column) or (isinstance(agg, (list, tuple)) and len(agg) > 0
                                       and all(isinstance(a, Column) for a in agg))


def _plan(df: DataFrame, keys: list[str], agg) -> list[tuple]:
    """(column, aggregate, alias) triples."""
    if isinstance(agg, Mapping):
        return [(c, _lookup(n), c if single else f"{c}_{_label(n)}")
                for c, names in agg.items()
                for names, single in [_names(names)]
                for n in names]
    names, single = _names(agg)
    numeric = [f.name for f in df.schema.fields
               if isinstance(f.dataType, T.NumericType) and f.name not in keys]
    return [(c, _lookup(n), c if single else f"{c}_{_label(n)}") for c in numeric for n in names]


def _names(agg) -> tuple[list, bool]:
    return ([agg], True) if isinstance(agg, (str, InParts)) or callable(agg) else (list(agg), False)


def _label(name) -> str:
    if isinstance(name, InParts):
        return name.name
    return KNOWN.get(name, name) if isinstance(KNOWN.get(name, name), str) else name.__name__


def _lookup(name):
    """The aggregate's name, or the function itself where it is none of the known ones."""
    if isinstance(name, InParts):
        return name
    if callable(name):
        return KNOWN.get(name, name)
    names = sorted([*AGGREGATES, *SUMS, *MEANS, *ENDS, MEDIAN])
    if name not in names:
        raise ValueError(f"aggregate {name!r}: use one of {names} or a function")
    return name


def aggregate_series(df: DataFrame, keys: list[str], col: str, function, alias: str) -> DataFrame:
    """Any pandas function from a series to a number, per group.

    The function sees the non-null values of a whole group at once, in one task, which must
    have the memory for the largest group. Name an aggregate, or write one as columns (see
    :func:`group_by_meta`), where groups grow without bound.
    """
    kept = df.where(_all_present(keys) & F.col(col).isNotNull())

    def call(values: pd.Series) -> float:
        return float(function(values))

    call.__annotations__ = {"values": pd.Series, "return": float}
    return kept.groupBy(*keys).agg(
        F.pandas_udf(call, T.DoubleType())(F.col(col).cast("double")).alias(alias))


def demand_by_area(demand: DataFrame, group: tuple[str, ...] = (
        "trading_date", "trading_period", "island_name", "load_area")) -> DataFrame:
    """Demand per period and load area, from demand rows with metadata."""
    return group_by_meta(demand, list(group), {"demand": "sum"})


def span(df: DataFrame, keys: list[str], date_col: str = "trading_date") -> DataFrame:
    """First and last day per group."""
    return df.groupBy(*keys).agg(F.min(date_col).alias("first_day"), F.max(date_col).alias("last_day"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def days_by_year(df: DataFrame, date_col: str = "trading_date") -> DataFrame:
    """Year -> its sorted distinct days (366 at most, so the list is bounded)."""
    days = df.select(F.col(date_col).alias("day")).where(F.col("day").isNotNull()).distinct()
    return days.groupBy(F.year("day").alias("trading_year")).agg(
        F.sort_array(F.collect_list("day")).alias("days"))


def rows_per_year(df: DataFrame, date_col: str = "trading_date") -> DataFrame:
    year = F.col("trading_year") if "trading_year" in df.columns else F.year(date_col)
    return df.groupBy(year.alias("trading_year")).agg(F.count(F.lit(1)).alias("n_rows"))
