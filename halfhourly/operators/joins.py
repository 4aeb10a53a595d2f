"""Joins with reference data, grids of wanted values, and differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from halfhourly.session import staged

def merge_meta(df: DataFrame, metadata: DataFrame, col: str = "demand", how: str = "left",
               node_col: str = "node", meta_node_col: str = "meta_node") -> DataFrame:
    """Node metadata joined to market rows.

    ``left`` keeps nodes the metadata lacks but no row without a value in ``col``;
    ``inner`` keeps the known nodes.  Metadata columns named like a market column
    get ``meta_`` in front, so that no name is ambiguous.

    The metadata is worked out once, into the shared folder. Its stored size tells Spark
    whether it may be broadcast; otherwise the join shuffles and skewed partitions are split.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"metadata join {how!r}: use left or inner")
    if meta_node_col not in metadata.columns:
        own = {c.lower(): c for c in metadata.columns}
        if "node" not in own:
            raise ValueError(f"the metadata has neither {meta_node_col!r} nor 'node'")
        metadata = metadata.withColumnRenamed(own["node"], meta_node_col)
    metadata = metadata.withColumnsRenamed(
        {c: f"meta_{c}" for c in metadata.columns if c in df.columns})
    side = staged(metadata, "metadata")
    kept = df.where(F.col(col).isNotNull()) if how == "left" else df
    return kept.join(side, kept[node_col] == side[meta_node_col], how)


def value_day_grid(values: DataFrame, begin: Column, end: Column,
                   day_col: str = "trading_date") -> DataFrame:
    """Each row with every day of a range: the days are exploded within the row."""
    return values.withColumn(day_col, F.explode(F.sequence(begin, end)))


def missing_days(held: DataFrame, keys: list[str], begin: Column, end: Column,
                 day_col: str = "trading_date") -> DataFrame:
    """For each held key, the days of a range that it has no row for.

    A key's days, no more than the range has, are taken from the range within one row;
    no grid of keys and days is made.
    """
    days = held.groupBy(*keys).agg(F.collect_set(day_col).alias("_days"))
    return days.select(*keys, F.explode(F.array_except(F.sequence(begin, end), "_days")).alias(day_col))


def missing_rows(wanted: DataFrame, held: DataFrame, on: list[str] | str) -> DataFrame:
    """Rows of ``wanted`` whose key is not in ``held``, each key's rows kept.

    The held keys are made distinct first, so a key held many times is shuffled
    once per task.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return wanted.join(held.select(*keys).distinct(), keys, "left_anti")


def difference(one: DataFrame, two: DataFrame) -> DataFrame:
    """Distinct rows of ``one`` that are not in ``two``."""
    return one.subtract(two)
