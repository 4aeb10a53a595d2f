"""Helpers that several of the text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from halfhourly.session import staged


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use in either case."""
    used = {c.lower() for c in df.columns}
    while base.lower() in used:
        base += "_"
    return base


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def texts_of(batch: pa.RecordBatch, col: int) -> list[bytes]:
    """UTF-8 of a string column, b"" for null."""
    column = batch.column(col)
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [v or b"" for v in column.cast(kind).to_pylist()]


def decoded(text: bytes) -> str:
    """A stored text as a string: bytes that are no UTF-8 become the replacement character U+FFFD.

    Parquet does not forbid such bytes in a string column; no operator fails on them.
    """
    return text.decode("utf-8", "replace")


def slices(batch: pa.RecordBatch, col: int, max_bytes: int = 2_000_000,
           max_rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows whose texts hold about ``max_bytes``; a longer text is alone."""
    sizes = np.array([len(v) for v in texts_of(batch, col)], dtype=np.int64)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and (held + size > max_bytes or i - start == max_rows):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield batch.slice(start)


def arrow_texts(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """The columns an operator reads, in fixed order and under fixed names.

    Other columns stay behind, so a name they share with a result does no harm.
    """
    return docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
                       F.col(f"`{text_col}`").cast("string").alias("text"))


def numbered(df: DataFrame, group: list[str], order: list[str], name: str, label: str) -> DataFrame:
    """``df`` with a gapless number from 0 in each group, along ``order``.

    No group is put into one task: rows are cut into ranges of (group, order) and
    written; only one count per range and group is summed up over the ranges.
    """
    part = fresh(df, "part")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *group, *order)
              .withColumn(part, F.spark_partition_id()))
    rows = staged(ranged, label)
    before, here = fresh(df, "rows_before"), fresh(df, "rows_here")
    counts = rows.groupBy(part, *group).agg(F.count(F.lit(1)).alias(here))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = staged(counts.select(part, *group, F.coalesce(F.sum(here).over(earlier), F.lit(0)).alias(before)),
                    f"{label}-counts")      # written, so that its size tells how to join
    keys = [part, *group]
    left, right = rows.alias("l"), counts.alias("r")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    within = Window.partitionBy(*[F.col(f"l.{k}") for k in keys]).orderBy(*[F.col(f"l.{c}") for c in order])
    return left.join(right, same).select(
        *[F.col(f"l.{c}") for c in df.columns],
        (F.col(before) + F.row_number().over(within) - 1).cast("long").alias(name))
