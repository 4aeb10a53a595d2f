"""Ordered operators: shifts, carried values, running sums, quantiles, newest rows.

There is one plan, whatever the sizes of the groups. Rows, reduced first where that is
possible, are cut into ranges along (group, order) and written once to the shared
folder; a group of any size spans as many ranges as it needs. A window works inside
each group and range, and one row per group and range, its first value, its last
value or its total, is carried across. Null keys are a group like any other where rows
are kept as they are. Sums are exact, so no result depends on how rows are cut.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from halfhourly.operators.exact import as_written, exact_sums, is_floating, written_sums
from halfhourly.session import staged

_PART = "_part"
#: Places, in powers of two below the largest value of a group, to which running sums are kept.
_PLACES = 80


def _cut(df: DataFrame, keys: list[str], order: list[str], label: str) -> DataFrame:
    """``df`` written in ranges of (keys, order), with the number of each row's range.

    Cutting takes a look at the rows first; what lies before the last shuffle of ``df`` is
    not worked out again for that.
    """
    ranged = df.repartitionByRange(*keys, *order).withColumn(_PART, F.spark_partition_id())
    return staged(ranged, label)


def _inside(keys: list[str], order_col: str):
    return Window.partitionBy(_PART, *keys).orderBy(order_col)


def _across(keys: list[str]):
    """Over the rows that carry something from range to range of one group."""
    return Window.partitionBy(*keys).orderBy(_PART)


def _carried(rows: DataFrame, carried: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``rows`` with the ``value`` carried to their group and range, null keys included."""
    names = [_PART, *keys]
    side = carried.select(*[F.col(c).alias(f"_to_{c}") for c in names], value)
    same = functools.reduce(operator.and_, [rows[c].eqNullSafe(side[f"_to_{c}"]) for c in names])
    return rows.join(side, same, "left").drop(*[f"_to_{c}" for c in names])


def next_value(df: DataFrame, keys: list[str], date_col: str, col: str) -> DataFrame:
    """Each row takes the value of the next row in date order; the last row of a
    group drops out, a null value inside it stays.

    One row per group and date is expected.
    """
    rows = _cut(df, keys, [date_col], "shift")
    inside = _inside(keys, date_col)
    rows = rows.withColumn("_first", F.row_number().over(inside) == 1).withColumn(
        "_next", F.lead(F.struct(col)).over(inside))
    after = (rows.where("_first").select(_PART, *keys, F.struct(col).alias("_head"))
             .withColumn("_after", F.lead("_head").over(_across(keys))))
    joined = _carried(rows, after, keys, "_after")
    taken = joined.withColumn("_next", F.coalesce("_next", "_after")).where(F.col("_next").isNotNull())
    return taken.withColumn(col, F.col(f"_next.{col}")).select(*df.columns)


def carry_down(df: DataFrame, keys: list[str], order_col: str, col: str, alias: str) -> DataFrame:
    """The last non-null ``col`` at or before each row along ``order_col``, unique within the group."""
    rows = _cut(df, keys, [order_col], "carry").withColumn(
        "_here", F.last_value(F.col(col), True).over(_inside(keys, order_col)))
    before = _across(keys).rowsBetween(Window.unboundedPreceding, -1)
    lasts = rows.groupBy(_PART, *keys).agg(
        F.max_by(F.col(col), F.when(F.col(col).isNotNull(), F.col(order_col))).alias("_last"))
    carried = lasts.withColumn("_before", F.last_value(F.col("_last"), True).over(before))
    return (_carried(rows, carried, keys, "_before")
            .withColumn(alias, F.coalesce("_here", "_before")).select(*df.columns, alias))


def _present(df: DataFrame, columns: list[str]) -> DataFrame:
    for c in columns:
        df = df.where(F.col(c).isNotNull())
    return df


def running_total(df: DataFrame, keys: list[str], order_col: str, col: str, alias: str) -> DataFrame:
    """Running sum of ``col`` along ascending ``order_col``, equal positions merged.

    Returns one row per group and position: keys, position, its own sum, the
    running sum.  Rows without a group key or position belong nowhere and drop out.
    Floating numbers are added up exactly at a position. Along the positions those that decimals hold are added
    up as decimals, others as whole multiples of 2^-80 of the group's largest of them, so results do not depend
    on how rows are cut. NaN counts as missing.
    """
    named = _present(df, [*keys, order_col])
    floating, odd = is_floating(df.schema[col].dataType), False
    if floating:
        seen, unwritten = Observation(), F.count_if(as_written(F.col("_own")).isNull()).alias("odd")
        # decimals add up in one plain aggregate; only where a value is none are all added up by digits
        steps = written_sums(named, [*keys, order_col], col, "_own").observe(
            seen, unwritten, F.sum("_own_odd").alias("unheld"))
        rows = _cut(steps.select(*keys, order_col, "_own"), keys, [order_col], "running")
        if seen.get["unheld"]:
            seen = Observation()
            steps = exact_sums(named, [*keys, order_col], {"_own": col}).drop("_own_n").observe(seen, unwritten)
            rows = _cut(steps, keys, [order_col], "running")
        odd = seen.get["odd"] > 0
    else:
        rows = _cut(named.groupBy(*keys, order_col).agg(F.sum(col).alias("_own")), keys, [order_col], "running")
    added = {"_sum": as_written(F.col("_own")) if floating else F.col("_own")}
    if odd:
        rows = rows.withColumn("_sum", as_written(F.col("_own")))
        size = F.when(F.col("_sum").isNull() & (F.abs("_own") < float("inf")), F.abs("_own"))
        tops = rows.groupBy(*keys).agg(F.max(F.floor(F.log2(size))).alias("_top"))
        rows = rows.join(tops, keys)
        added = {"_sum": F.col("_sum"),
                 "_odd": F.when(size.isNotNull(), F.col("_own") / _half_unit() / _half_unit()).cast("decimal(38,0)"),
                 "_up": ((F.col("_own") == float("inf")) | F.isnan("_own")).cast("bigint"),
                 "_down": ((F.col("_own") == float("-inf")) | F.isnan("_own")).cast("bigint")}
    so_far = _inside(keys, order_col).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns(added).withColumn("_here", F.struct(*[F.sum(c).over(so_far).alias(c) for c in added]))
    before = _across(keys).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(_PART, *keys).agg(*[F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in added])
    carried = totals.withColumn("_before", F.struct(*[F.sum(c).over(before).alias(c) for c in added]))
    joined = _carried(rows, carried.select(_PART, *keys, "_before"), keys, "_before")

    def upto(name: str) -> Column:
        here, earlier = F.col(f"_here.{name}"), F.col(f"_before.{name}")
        return F.coalesce(here + earlier, here, earlier)

    result = upto("_sum")
    if floating and not odd:
        result = result.cast("double")
    if odd:
        up, down = upto("_up") > 0, upto("_down") > 0
        result = (F.when(up & down, F.lit(float("nan"))).when(up, F.lit(float("inf"))).when(down, F.lit(float("-inf")))
                  .when(upto("_odd").isNull(), result.cast("double"))
                  .otherwise(F.coalesce(result.cast("double"), F.lit(0.0))
                             + upto("_odd").cast("double") * _half_unit() * _half_unit()))
    return joined.select(*keys, order_col, F.col("_own").alias(col), result.alias(alias))


def _half_unit() -> Column:
    """The root of a group's unit, a power of two."""
    return F.pow(F.lit(2.0), F.floor((F.coalesce("_top", F.lit(0)) - _PLACES) / 2).cast("double"))


def quantiles(df: DataFrame, keys: list[str], col: str, probabilities: list[float]) -> DataFrame:
    """Exact quantiles with linear interpolation, per group.

    Rows are counted by value before they are shuffled; the counts say which values
    hold a quantile. Returns keys, ``probability``, ``value``; rows without a group
    key or value drop out.
    """
    rows = _present(df.select(*keys, F.col(col).cast("double").alias("_value")), [*keys, "_value"])
    steps = _cut(rows.groupBy(*keys, "_value").agg(F.count(F.lit(1)).alias("_n")), keys, ["_value"], "quantiles")
    so_far = (Window.unboundedPreceding, Window.currentRow)
    before = _across(keys).rowsBetween(Window.unboundedPreceding, -1)
    counts = (steps.groupBy(_PART, *keys).agg(F.sum("_n").alias("_rows"))
              .withColumn("_place", F.struct(
                  F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("start"),
                  F.sum("_rows").over(Window.partitionBy(*keys)).alias("size"))))
    here = steps.withColumn("_here", F.sum("_n").over(_inside(keys, "_value").rowsBetween(*so_far)))
    ranked = _carried(here, counts, keys, "_place").select(
        *keys, "_value", F.col("_place.size").alias("_size"),
        (F.col("_place.start") + F.col("_here")).alias("_upto"),
        (F.col("_place.start") + F.col("_here") - F.col("_n")).alias("_below"))

    def rank(p: float) -> Column:
        return F.lit(float(p)) * (F.col("_size") - 1)

    touched = functools.reduce(operator.or_, [
        (F.ceil(rank(p)) >= F.col("_below")) & (F.floor(rank(p)) < F.col("_upto")) for p in probabilities])
    ends = ranked.where(touched).select(*keys, "_value", "_below", "_upto", F.explode(F.array(*[
        F.struct(F.lit(float(p)).alias("probability"), rank(p).alias("at")) for p in probabilities]))
        .alias("_w"))
    low, high = F.floor("_w.at"), F.ceil("_w.at")
    at_low = (low >= F.col("_below")) & (low < F.col("_upto"))
    at_high = (high >= F.col("_below")) & (high < F.col("_upto"))
    found = ends.where(at_low | at_high).groupBy(
        *keys, F.col("_w.probability").alias("probability")).agg(
        F.max(F.when(at_low, F.col("_value"))).alias("_a"),
        F.max(F.when(at_high, F.col("_value"))).alias("_b"),
        F.max(F.col("_w.at") - low).alias("_part_of"))
    return found.select(*keys, "probability",
                        (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_part_of"))
                        .alias("value"))


def newest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one that is last by ``order``, then by all other columns.

    A struct maximum instead of a row number, so a key repeated many times is
    reduced before the shuffle.  Nulls count as oldest.
    """
    others = [c for c in df.columns if c not in keys and c not in order]
    ordered = [c for c in order if c not in keys] + others
    best = df.groupBy(*keys).agg(F.max(F.struct(*ordered)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)
