"""Incremental loads and half-hourly demand over files as they arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from halfhourly.functions.dates import trading_timestamp, utc_instant
from halfhourly.operators.exact import added, parts, totals
from halfhourly.schemas import Table
from halfhourly.session import drop_work_folders, work_folders
from halfhourly.sources.csvfiles import CSV_GLOB, REASON, csv_rows, file_lines, table_of
from halfhourly.sources.tables import set_aside, staged_batch, stored_schema
from halfhourly.sources.versions import upsert


def stream_csv(spark: SparkSession, folder: str, table: Table | str, glob: str = CSV_GLOB,
               max_files: int = 10_000) -> DataFrame:
    """New CSV files of a folder as a stream of typed rows, as ``read_csv`` reads them.

    A batch takes ``max_files`` at most, so a first load of many files goes in parts.
    """
    t = table_of(table)
    text = (spark.readStream.option("maxFilesPerTrigger", max_files)
            .option("pathGlobFilter", glob).text(folder))
    return csv_rows(file_lines(text), t, t.names)


def load_new(stream: DataFrame, store: str, table: Table | str, checkpoint: str) -> StreamingQuery:
    """Loads each file once and the newest row of each unique key into a stored table, then stops.

    Of rows with one key the newest is kept: the last by amendment date where the table
    has one, then by all other columns. Rows of a batch are compared with each other and
    with the stored row, so the table is the same however files fall into batches. New rows are appended
    to the table and newer versions beside it, nothing stored is written again; read the table by
    :func:`halfhourly.sources.versions.read_current`. No state grows with
    the stream, no row is late, and a batch run again changes nothing. Rows with a
    ``reject_reason`` or without a key go to the table of rejects beside the store.
    """
    t = table_of(table)

    def add(batch: DataFrame, batch_id: int) -> None:
        folders = work_folders()
        rows, noted = staged_batch(batch, t)
        if noted.rejected:
            set_aside(rows.where(F.col(REASON).isNotNull()), store, t)
        if noted.total > noted.rejected:
            upsert(rows.where(F.col(REASON).isNull()).select(*_present(rows, t)), store, t, noted)
        drop_work_folders(batch.sparkSession, folders)

    return (stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _present(rows: DataFrame, table: Table) -> list[Column]:
    """The stored columns of a table; those the rows lack are null."""
    return [(F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in stored_schema(table)]


def distinct_within(stream: DataFrame, keys: list[str], stamp: Column | str,
                    lateness: str) -> DataFrame:
    """Each key once, for a stream without a table behind it.

    State is dropped ``lateness`` after a key's trading time; a repeat that comes
    later than that counts as new.
    """
    at = F.col(stamp) if isinstance(stamp, str) else stamp
    return (stream.withColumn("_at", utc_instant(at)).withWatermark("_at", lateness)
            .dropDuplicatesWithinWatermark(keys).drop("_at"))


def half_hour_demand(demand: DataFrame, keys: list[str], value: str = "demand") -> DataFrame:
    """Demand per half hour and group, from demand rows, as sums that add up exactly (``exact.PARTS``)."""
    at = trading_timestamp("trading_date", "trading_period")
    return parts(demand.withColumn("half_hour", at), ["half_hour", *keys], value)


def add_half_hours(stream: DataFrame, path: str, keys: list[str], checkpoint: str,
                   value: str = "demand") -> StreamingQuery:
    """Adds up each batch's half hours and keeps the sums in a stored table, then stops.

    Every row counts, however late it comes, since a half hour is never closed; see
    :func:`half_hour_totals`, and :mod:`halfhourly.streaming.windows` for half hours that close. A batch run
    again replaces its own sums.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        half_hour_demand(batch, keys, value).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def half_hour_totals(spark: SparkSession, path: str, keys: list[str], value: str = "demand") -> DataFrame:
    """Demand per half hour and group over all batches so far."""
    groups = ["half_hour", *keys]
    return totals(added(spark.read.parquet(path), groups), groups, value)
