"""Stored tables whose rows are amended: versions are appended, merged on reading, compacted apart.

A row with a new key is appended to the table. A row that is newer than the stored one of its key is
appended to a table of amended rows beside it; nothing stored is written again. Reading (``read_table``) leaves
out the stored rows whose key was amended and takes the newest version instead, so only keys of amended
rows are compared. :func:`compact` writes the years anew in which amended rows have become many.

Newest is the row that is last by amendment date where the table has one, then by all other columns, nulls first.
One writer per table at a time. A writer that was cut off between any two steps leaves nothing lost: rows that
are appended twice are one version, and a compaction is read from its own folder from the moment that is whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from halfhourly.operators.ordered import newest
from halfhourly.schemas import Table
from halfhourly.session import delete_path, path_exists, staged
from halfhourly.sources.csvfiles import table_of
from halfhourly.sources.tables import (YEAR, Noted, amended_path, compacting_path, is_whole, read_table, rows_near,
                                       stored_schema, unamended, version, version_order, write_newest, write_rows,
                                       years_of)


@dataclass(frozen=True)
class Upsert:
    """What a batch did: rows with new keys, and newer versions of stored rows."""

    new: int
    amended: int


def upsert(rows: DataFrame, path: str, table: Table | str, noted: Noted) -> Upsert:
    """Appends the rows of a batch that are new or newer than the stored ones.

    ``rows`` have the table's columns; of rows with one key the newest counts. Only the dates of the batch are read
    from the table, and only what changes is written. The same batch once more changes nothing.
    """
    t, spark = table_of(table), rows.sparkSession
    finish_compaction(spark, path, t)
    keys, order = list(t.key), version_order(t)[0]
    rows = rows.select(*stored_schema(t).names)
    held = rows_near(read_table(spark, path, t), t, noted.spans)
    if held.isEmpty():
        return Upsert(write_newest(rows, path, t, noted, order), 0)
    single = newest(rows, keys, order)
    known = held.select(*keys, version(t).alias("_held"))
    changed = staged(single.join(known, keys, "left")
                     .where(F.col("_held").isNull() | (version(t) > F.col("_held")))
                     .select(*stored_schema(t).names, F.col("_held").isNotNull().alias("_amends")), "changed")
    counts = {r["_amends"]: r["n"] for r in changed.groupBy("_amends").agg(F.count(F.lit(1)).alias("n")).collect()}
    for amends, place in ((False, path), (True, amended_path(path))):
        if counts.get(amends):
            write_rows(changed.where(F.col("_amends") == amends).drop("_amends"), place, t, noted=noted)
    return Upsert(counts.get(False, 0), counts.get(True, 0))


def amended_shares(spark: SparkSession, path: str, table: Table | str) -> DataFrame:
    """Stored and amended rows of each year that has amended rows, and their ratio."""
    t = table_of(table)
    year = F.col(YEAR) if t.by_year else F.lit(None).cast("int")
    sizes = [unamended(spark, path, t), read_table(spark, amended_path(path), t)]
    stored, amended = (rows.groupBy(year.alias(YEAR)).agg(F.count(F.lit(1)).alias(n))
                       for rows, n in zip(sizes, ("n_stored", "n_amended")))
    joined = amended.alias("a").join(stored.alias("s"), F.col(f"a.{YEAR}").eqNullSafe(F.col(f"s.{YEAR}")), "left")
    return joined.select(f"a.{YEAR}", "n_stored", "n_amended", (F.col("n_amended") / F.col("n_stored")).alias("share"))


def compact(spark: SparkSession, path: str, table: Table | str, share: float = 0.1) -> list[int | None]:
    """Writes the years anew whose amended rows are more than a ``share`` of the stored ones; returns those years.

    The new years are written beside the table first. From then on they are what is read, so the
    steps that put them in their place can be cut off and taken up again.
    """
    t = table_of(table)
    finish_compaction(spark, path, t)
    if not path_exists(spark, amended_path(path)):
        return []
    years = sorted(r[0] or 0 for r in amended_shares(spark, path, t).where(F.col("share") > share)
                   .select(YEAR).collect())
    if not years:
        return []
    rows = read_table(spark, path, t)
    write_rows(rows.where(F.col(YEAR).isin(years)) if t.by_year else rows, compacting_path(path), t, "overwrite")
    finish_compaction(spark, path, t)
    return years if t.by_year else [None]


def finish_compaction(spark: SparkSession, path: str, table: Table | str) -> None:
    """Takes up a compaction that was cut off; does nothing where there is none."""
    t, folder = table_of(table), compacting_path(path)
    if not path_exists(spark, folder):
        return
    if is_whole(spark, folder):
        rebuilt = read_table(spark, folder, t)
        write_rows(rebuilt, path, t, "replace_years" if t.by_year else "overwrite")
        if t.by_year:
            for year in years_of(rebuilt):
                delete_path(spark, f"{amended_path(path)}/{YEAR}={year}")
        else:
            delete_path(spark, amended_path(path))
        # the mark goes first, so a folder that is half deleted is not taken for a whole one
        delete_path(spark, f"{folder}/_SUCCESS")
    delete_path(spark, folder)
