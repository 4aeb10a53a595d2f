"""Half-hourly sums of a stream in event time: half hours close, late rows are kept apart.

Two streaming queries run one after the other over the files as they arrive.

:func:`split_late` stores every row once. A row whose half hour ended more than ``lateness`` before the latest event
of all earlier batches is late. The latest event of each batch is noted after its rows, so a batch that is run again
comes to the same answer, and one whose rows were stored is not stored twice.

:func:`close_half_hours` adds up the rows that are not late, with a watermark and a window of half an
hour as state. As its watermark never runs ahead of what ``split_late`` saw, it drops no
row: a closed half hour is written once and holds all of its rows that were not late.
Closed half hours, late rows and half hours that are still open are together all rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from halfhourly.functions.dates import trading_timestamp, utc_instant, utc_stamp
from halfhourly.operators.exact import added, parts, totals
from halfhourly.session import path_exists

HALF_HOUR = "30 minutes"
_AT, _LATE = "event_at", "late"


def _rows(path: str) -> str:
    return f"{path}/rows"


def _mark(path: str, batch_id: int) -> str:
    return f"{path}/latest/batch_id={batch_id}"


def _latest_before(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The latest event of the earlier batches, in microseconds."""
    if not path_exists(spark, f"{path}/latest"):
        return None
    marks = spark.read.schema("latest bigint, batch_id bigint").parquet(f"{path}/latest")
    return marks.where(F.col("batch_id") < batch_id).agg(F.max("latest")).first()[0]


def ends(at: Column | str) -> Column:
    """When the half hour of an event ends."""
    return F.window(at, HALF_HOUR)["end"]


def split_late(stream: DataFrame, path: str, lateness: dt.timedelta, checkpoint: str,
               stamp: Column | None = None) -> StreamingQuery:
    """Stores the rows of a stream, late ones apart from the others, then stops.

    ``stamp``: the zone-less time of a row, by default the start of its trading period. Rows without a
    time are late, as no half hour holds them.
    """
    at = trading_timestamp("trading_date", "trading_period") if stamp is None else stamp

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder, mark = f"{_rows(path)}/batch_id={batch_id}", _mark(path, batch_id)
        if path_exists(spark, f"{mark}/_SUCCESS"):
            return
        latest, seen = _latest_before(spark, path, batch_id), Observation()
        if path_exists(spark, f"{folder}/_SUCCESS"):        # stored, but cut off before the mark
            newest = spark.read.parquet(folder).agg(F.max(F.unix_micros(_AT))).first()[0]
        else:
            late = F.lit(False) if latest is None else \
                F.unix_micros(ends(_AT)) <= latest - lateness // dt.timedelta(microseconds=1)
            rows = batch.withColumn(_AT, utc_instant(at)).withColumn(_LATE, F.coalesce(late, F.lit(True)))
            rows = rows.withColumn(_LATE, F.col(_LATE) | F.col(_AT).isNull())
            (rows.observe(seen, F.max(F.unix_micros(_AT)).alias("latest"))
             .write.mode("overwrite").partitionBy(_LATE).parquet(folder))
            newest = seen.get["latest"]
        one = spark.createDataFrame([(newest,)], "latest bigint")
        one.coalesce(1).write.mode("overwrite").parquet(mark)

    return (stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that came after their half hour had closed."""
    return spark.read.parquet(_rows(path)).where(F.col(_LATE).cast("boolean")).drop(_AT, _LATE, "batch_id")


def close_half_hours(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], value: str,
                     lateness: dt.timedelta, checkpoint: str) -> StreamingQuery:
    """Adds up the rows of closed half hours into a stored table of sums, then stops.

    ``schema``: that of the stream given to :func:`split_late`. State holds the open half hours alone: a sum
    per half hour and group.
    """
    full = T.StructType([*schema.fields, T.StructField(_AT, T.TimestampType())])
    rows = spark.readStream.schema(full).parquet(f"{_rows(path)}/batch_id=*/{_LATE}=false")
    seconds = int(lateness.total_seconds())
    windows = rows.withWatermark(_AT, f"{seconds} seconds").withColumn("window", F.window(_AT, HALF_HOUR))
    sums = parts(windows, ["window", *keys], value)
    return (sums.select(F.col("window.start").alias("half_hour"), *[c for c in sums.columns if c != "window"])
            .writeStream.outputMode("append").format("parquet").option("path", f"{path}/closed")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def closed_half_hours(spark: SparkSession, path: str, keys: list[str], value: str) -> DataFrame:
    """Sums of the closed half hours."""
    sums = _closed(spark, path, keys)
    return totals(sums, ["half_hour", *keys], value)


def _closed(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    sums = spark.read.parquet(f"{path}/closed")
    return sums.withColumn("half_hour", utc_stamp("half_hour"))


def all_half_hours(spark: SparkSession, path: str, keys: list[str], value: str) -> DataFrame:
    """Sums of the closed half hours with the late rows added."""
    groups = ["half_hour", *keys]
    at = trading_timestamp("trading_date", "trading_period")
    late = parts(late_rows(spark, path).withColumn("half_hour", at), groups, value)
    both = _closed(spark, path, keys).unionByName(late)
    return totals(added(both, groups), groups, value)


def end_marker(spark: SparkSession, path: str, schema: T.StructType, until: dt.datetime) -> None:
    """Closes all half hours that ended by ``until``: a row without values that lies beyond them is stored.

    For a stream that has ended; whatever comes later and belongs to them is late.
    """
    marker = spark.createDataFrame([(None,) * len(schema.fields)], T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in schema.fields]))
    number = 1 << 40
    folder = f"{_rows(path)}/batch_id={number}/{_LATE}=false"
    at = F.lit(until.replace(tzinfo=None)).cast("timestamp_ntz")
    marker.withColumn(_AT, utc_instant(at)).coalesce(1).write.mode("overwrite").parquet(folder)
