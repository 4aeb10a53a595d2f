"""Stored tables: creating, reading, appending new rows, sizes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from halfhourly.operators.ordered import newest
from halfhourly.schemas import TABLES, Table
from halfhourly.session import drop_work_folders, path_exists, staged, work_folders
from halfhourly.sources.csvfiles import CSV_GLOB, REASON, SOURCE, check_file_year, read_csv, table_of

YEAR = "trading_year"


def create_tables(spark: SparkSession, names: list[str] | None = None, database: str = "default",
                  location: str | None = None) -> None:
    """Parquet tables in the catalog, partitioned by year where they are split.

    Years written to a table's location show after ``MSCK REPAIR TABLE``.
    """
    for name in names or list(TABLES):
        t = table_of(name)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored_schema(t))
        split = f" PARTITIONED BY ({YEAR})" if t.by_year else ""
        place = f" LOCATION '{location}/{name}'" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) "
                  f"USING parquet{split}{place}")


def read_table(spark: SparkSession, path: str, table: Table | str) -> DataFrame:
    """A stored table, of rows that were amended the newest version; no rows while nothing has been loaded."""
    t = table_of(table)
    stored = unamended(spark, path, t)
    if not path_exists(spark, amended_path(path)):
        return stored
    return _merged(stored, _read_or_none(spark, amended_path(path), stored_schema(t)), t)


def amended_path(path: str) -> str:
    """Where newer versions of a table's rows are kept."""
    return path.rstrip("/") + "_amended"


def compacting_path(path: str) -> str:
    """Where a compaction is built, and read from until it is in its place."""
    return path.rstrip("/") + "_compacting"


def version_order(table: Table) -> tuple[list[str], list[str]]:
    """The columns that say which of two versions is newer: dates of amendment, then all others."""
    order = [c for c in ("last_amended_date", "created_date") if c in table.names]
    return order, [c for c in stored_schema(table).names if c not in table.key and c not in order]


def version(table: Table) -> Column:
    order, others = version_order(table)
    return F.struct(*order, *others)


def is_whole(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/_SUCCESS")


def unamended(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """The stored rows as they stand without amended ones."""
    stored = _read_or_none(spark, path, stored_schema(table))
    folder = compacting_path(path)
    if not is_whole(spark, folder):
        return stored
    rebuilt = _read_or_none(spark, folder, stored_schema(table))
    if not table.by_year:
        return rebuilt
    return stored.where(~F.col(YEAR).isin(years_of(rebuilt))).unionByName(rebuilt)


def years_of(rows: DataFrame) -> list[int]:
    return [r[0] for r in rows.select(YEAR).distinct().collect()]


def _merged(stored: DataFrame, amended: DataFrame, table: Table) -> DataFrame:
    keys, order = list(table.key), version_order(table)[0]
    latest = newest(amended, keys, order)
    return (stored.join(amended.select(*_matched(table)), _matched(table), "left_anti")
            .unionByName(latest).select(*stored_schema(table).names))


def _matched(table: Table) -> list[str]:
    """The columns that join versions of a row; the year among them lets Spark leave out years."""
    return [*([YEAR] if table.by_year else []), *table.key]


def _read_or_none(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def stored_schema(table: Table) -> T.StructType:
    fields = list(table.struct.fields)
    if table.by_year:
        fields.append(T.StructField(YEAR, T.IntegerType()))
    return T.StructType(fields)


def write_rows(rows: DataFrame, path: str, table: Table | str, mode: str = "append",
               noted: Noted | None = None) -> int:
    """Rows into a stored table, each file holding a stretch of dates; returns how many.

    Rows are cut into ranges of dates, and a day that holds much of the data over tasks; the order gives each
    file narrow date bounds to skip by. With what was ``noted`` of the batch the ranges are known and rows
    move once; else Spark takes a look at the rows first. ``replace_years`` as mode writes the years of the rows anew.
    """
    t = table_of(table)
    ranged = rows.repartitionByRange(*_file_order(t)[-len(t.key):]) if noted is None else noted.dealt(rows, t)
    return _write_dealt(ranged, path, t, mode)


def _file_order(table: Table) -> list[str]:
    """The order of a file's rows: by date, then key; the year in front is the order the partitioned write asks for."""
    return [*([YEAR] if table.by_year else []), table.date_col, *[k for k in table.key if k != table.date_col]]


def _write_dealt(ranged: DataFrame, path: str, t: Table, mode: str = "append") -> int:
    """Writes rows as they are dealt to tasks, those of each task in order; returns how many."""
    written = Observation()
    ranged = ranged.observe(written, F.count(F.lit(1)).alias("n"))
    writer = ranged.sortWithinPartitions(*_file_order(t)).write
    if mode == "replace_years":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    (writer.partitionBy(YEAR) if t.by_year else writer).parquet(path)
    return written.get["n"]


def write_newest(rows: DataFrame, path: str, table: Table, noted: Noted, order: list[str],
                 held: DataFrame | None = None) -> int:
    """Of each key the newest row (see ``newest``) into a stored table, unless the key is ``held``; returns how many.

    Rows are dealt by date and key to the tasks that write them, so they move and are sorted once: the newest is told
    in the order of the file. Held keys move with them, or are joined first where they are more than the
    rows. A batch with a key that repeats very often is reduced before it moves.
    """
    columns, names = [c for c in rows.columns if c in stored_schema(table).names], stored_schema(table).names
    rows, keys = rows.select(*columns), list(table.key)
    if not noted.even:
        single = newest(rows, keys, order)
        if held is not None:
            single = single.join(held, keys, "left_anti")
        return write_rows(single.select(*names), path, table, noted=noted)
    both = noted if held is None else noted.beside(rows, held, table)
    if held is None or both is None:
        rows = rows if held is None else rows.join(held, keys, "left_anti")
        dealt = noted.dealt(rows.withColumn(_HELD, F.lit(False)), table, _TASK)
    else:
        known = with_year(held, table).withColumn(_HELD, F.lit(True))
        dealt = both.dealt(rows.withColumn(_HELD, F.lit(False)).unionByName(known, allowMissingColumns=True), table, _TASK)
    first = _file_order(table)
    ordered = [c for c in order if c not in first] + [c for c in columns if c not in order and c not in first]
    # a key's rows are in one task, whose number among the keys spares a shuffle by key
    best = dealt.groupBy(*first, _TASK).agg(F.max(F.struct(*ordered)).alias("_row"), F.max(_HELD).alias(_HELD))
    return _write_dealt(best.where(~F.col(_HELD)).select(*first, "_row.*").select(*names), path, table)


_TASK, _HELD = "_task", "_held_key"

#: Rows for one task of a write, and ranges of dates that are told apart.
_TASK_ROWS, _RANGES = 250_000, 200
#: Days since 1970 that a bitmap holds; others are known by their first and last alone.
_BITMAP_DAYS = 32_768


@dataclass(frozen=True)
class Noted:
    """What was noted of a batch while it was written: numbers of rows, its days, and dates that cut it evenly.

    ``even``: no key repeats so often that it outweighs a task, and a row's year is that of its date.
    """

    total: int
    rejected: int
    spans: tuple[tuple[int, dt.date, dt.date], ...]
    cuts: tuple[int, ...]
    even: bool = False

    def beside(self, rows: DataFrame, held: DataFrame, table: Table) -> Noted | None:
        """What is noted of the rows and the held keys in one; None where the keys are more."""
        day = F.unix_date(F.col(table.date_col).cast("date")).alias("day")
        both = rows.select(day, F.lit(0).alias("held")).unionByName(held.select(day, F.lit(1).alias("held")))
        found = both.agg(F.count(F.lit(1)).alias("total"), F.sum("held").alias("held"), _evenly("day")).first()
        if 2 * found["held"] > found["total"]:
            return None
        return replace(self, total=found["total"], cuts=tuple(found["cuts"]))

    def dealt(self, rows: DataFrame, table: Table, number_as: str | None = None) -> DataFrame:
        """The rows dealt to tasks by date; a day of several ranges, and a range of several tasks, by key.

        A key's rows go to one task, whose number the rows may take along.
        """
        most = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        tasks = max(1, min(most, -(-self.total // _TASK_ROWS)))
        ranges = min(tasks, _RANGES)
        cuts = [self.cuts[k * _RANGES // ranges - 1] for k in range(1, ranges)] if self.cuts else []
        split = -(-tasks // ranges)
        number = F.unix_date(F.col(table.date_col).cast("date"))
        low, high = _leading(cuts, lambda c: c < number), _leading(cuts, lambda c: c <= number)
        share = F.hash(*table.key)
        target = (low + F.pmod(share, high - low + 1)) * split + F.pmod(F.xxhash64(*table.key), F.lit(split))
        target = target.cast("int")
        if number_as is None:
            return rows.repartitionById(ranges * split, target)
        return rows.withColumn(number_as, target).repartitionById(ranges * split, F.col(number_as))


def _leading(values: list[int], holds: Callable[[Column], Column]) -> Column:
    """For how many of ascending values something holds that holds for the first of them alone; told by halving."""
    known = F.array(*[F.lit(v) for v in values]).cast("array<int>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(values).bit_length()))]).cast("array<int>")
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(holds(F.get(known, at + step - 1)), step).otherwise(0))


def _evenly(number: Column | str) -> Column:
    """Values that cut numbers into ranges of much the same size."""
    return F.percentile_approx(number, [k / _RANGES for k in range(1, _RANGES)], 1000).alias("cuts")


def staged_batch(batch: DataFrame, table: Table) -> tuple[DataFrame, Noted]:
    """A checked batch in the shared folder; what is asked about it later is noted in the same pass."""
    rows, noted = checked_batch(batch, table), Observation()
    good = F.col(REASON).isNull()
    day = F.when(good, F.col(table.date_col).cast("date"))
    number = F.unix_date(day)
    held = number.between(0, _BITMAP_DAYS - 1)
    # the most frequent key, if any key has more than some two thousandths of the rows
    most = F.expr(f"approx_top_k(xxhash64({', '.join(table.key)}), 1, 10000)").alias("most")
    rows = staged(rows.observe(
        noted, F.count(F.lit(1)).alias("total"), F.count_if(~good).alias("rejected"),
        F.bitmap_construct_agg(F.when(held, number.cast("bigint"))).alias("days"),
        F.min(F.when(~held, day)).alias("first"), F.max(F.when(~held, day)).alias("last"),
        _evenly(number), most), "batch")
    found = noted.get
    even = (YEAR not in batch.columns) and all(r["count"] <= _TASK_ROWS for r in found["most"] or ())
    bits = bytes(found["days"] or b"")
    days = [dt.date(1970, 1, 1) + dt.timedelta(8 * i + k) for i, b in enumerate(bits) if b for k in range(8) if b >> k & 1]
    spans: dict[int, tuple[dt.date, dt.date]] = {}
    for d in days:
        spans[d.year] = (spans.get(d.year, (d, d))[0], d)
    if found["first"] is not None:      # of dates beyond the bitmap whole years are taken
        spans.update({y: (dt.date(y, 1, 1), dt.date(y, 12, 31))
                      for y in range(found["first"].year, found["last"].year + 1)})
    return rows, Noted(found["total"], found["rejected"], tuple((y, *s) for y, s in sorted(spans.items())),
                       tuple(found["cuts"] or ()), even)


@dataclass(frozen=True)
class Load:
    """What a load did: rows written, good rows that were not, and rows rejected."""

    loaded: int
    not_loaded: int
    rejected: int = 0


def rejects_path(path: str) -> str:
    """Where the rejected rows of a stored table are kept: a table beside it."""
    return path.rstrip("/") + "_rejected"


def set_aside(rows: DataFrame, path: str, table: Table) -> None:
    """Adds rejected rows, as text with their file and reason, to the table beside the store."""
    source = F.col(SOURCE) if SOURCE in rows.columns else F.lit(None)
    rows.select(*[F.col(c).cast("string") if c in rows.columns else F.lit(None).cast("string").alias(c)
                  for c in table.names], source.cast("string").alias(SOURCE), REASON) \
        .write.mode("append").parquet(rejects_path(path))


def read_rejects(spark: SparkSession, path: str, table: Table | str) -> DataFrame:
    """The rejected rows of a stored table with ``source_file`` and ``reject_reason``; none at first."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*table_of(table).names, SOURCE, REASON)])
    return _read_or_none(spark, rejects_path(path), schema)


def checked_batch(batch: DataFrame, table: Table) -> DataFrame:
    """The batch with its year and a reason where a row cannot be stored."""
    reason = F.col(REASON) if REASON in batch.columns else F.lit(None).cast("string")
    keys = [F.when(F.col(k).isNull(), F.lit(f"no {k}")) for k in table.key]
    return with_year(batch, table).withColumn(REASON, F.coalesce(reason, *keys))


def append_new_rows(spark: SparkSession, batch: DataFrame, path: str, table: Table | str,
                    mode: str = "skip_rows", order: list[str] | None = None) -> Load:
    """Appends the rows whose unique key is not stored yet.

    The batch is worked out once, into the shared folder. Rows with a
    ``reject_reason``, or without a key column, go to the table of rejects beside the store.
    ``skip_rows`` takes every new key, of repeated keys in the batch the row last
    by ``order`` (default: the amendment date where the table has one).
    ``reject_file`` takes whole files: a file is left out when one of its keys is
    stored, repeats inside it, or also stands in a file that comes first by name.
    One writer per table at a time.
    """
    t = table_of(table)
    if mode not in ("skip_rows", "reject_file"):
        raise ValueError(f"load mode {mode!r}: use skip_rows or reject_file")
    if mode == "reject_file" and SOURCE not in batch.columns:
        raise ValueError(f"to reject files the batch needs {SOURCE!r}")
    folders = work_folders()
    rows, noted = staged_batch(batch, t)
    if noted.rejected:
        set_aside(rows.where(F.col(REASON).isNotNull()), path, t)
    good, loaded = noted.total - noted.rejected, 0
    if good:
        valid = rows.where(F.col(REASON).isNull()).drop(REASON)
        if mode == "skip_rows":
            held = _held_keys(spark, path, t, noted.spans) if _holds_rows(spark, path) else None
            loaded = write_newest(valid, path, t, noted, order or amended_order(t, valid.columns), held)
        else:
            new = new_rows(spark, valid, path, t, mode, order, noted.spans)
            loaded = write_rows(new.select(*stored_schema(t).names), path, t, noted=noted)
    drop_work_folders(spark, folders)
    return Load(loaded, good - loaded, noted.rejected)


def batch_spans(batch: DataFrame, table: Table) -> list[tuple]:
    """Year, first and last day of a batch, for each of its years."""
    day = F.col(table.date_col).cast("date")
    rows = batch.where(day.isNotNull()).groupBy(F.year(day).alias("year")).agg(F.min(day), F.max(day)).collect()
    return [tuple(r) for r in rows]


def rows_near(stored: DataFrame, table: Table, spans: Iterable[tuple]) -> DataFrame:
    """Stored rows between the dates of a batch, year by year.

    Every unique key holds the date, so no other row can have a key of the batch;
    the year predicate prunes folders, the dates skip row groups of sorted files.
    """
    kind = table.struct[table.date_col].dataType
    found = F.lit(False)
    for year, first, last in spans:
        day = F.col(table.date_col)
        if isinstance(kind, T.DateType):
            between = day.between(F.lit(first), F.lit(last))
        else:
            between = (day >= F.lit(first).cast(kind)) & (day < F.lit(last + dt.timedelta(1)).cast(kind))
        found = found | ((F.col(YEAR) == year) & between if table.by_year else between)
    return stored.where(found)


def conform(df: DataFrame, table: Table | str, reasons: bool = False) -> DataFrame:
    """The columns of a table in its order and types; those missing are null.

    A cell that cannot be read in its column's type is null; with ``reasons`` its row
    has a ``reject_reason``, which every load honours.
    """
    t = table_of(table)
    have = {c.lower(): c for c in df.columns}
    cells = {f.name: F.col(have[f.name]).try_cast(f.dataType) if f.name in have
             else F.lit(None).cast(f.dataType) for f in t.struct}
    columns = [c.alias(n) for n, c in cells.items()]
    if reasons:
        old = [F.col(REASON)] if REASON in df.columns else []
        unread = [F.when(F.col(have[n]).isNotNull() & c.isNull(), F.lit(f"cannot read {n}"))
                  for n, c in cells.items() if n in have]
        columns.append(F.coalesce(*old, *unread, F.lit(None).cast("string")).alias(REASON))
    return df.select(*columns)


def with_year(batch: DataFrame, table: Table) -> DataFrame:
    if not table.by_year or YEAR in batch.columns:
        return batch
    return batch.withColumn(YEAR, F.year(table.date_col))


def amended_order(table: Table, columns: list[str]) -> list[str]:
    """The dates of amendment that a batch has, by which the newest of its rows is told."""
    return [c for c in version_order(table)[0] if c in columns]


def _holds_rows(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path) or path_exists(spark, compacting_path(path))


def _held_keys(spark: SparkSession, path: str, table: Table, spans: Iterable[tuple]) -> DataFrame:
    return rows_near(unamended(spark, path, table), table, spans).select(*table.key)


def new_rows(spark: SparkSession, batch: DataFrame, path: str, table: Table | str,
             mode: str = "skip_rows", order: list[str] | None = None,
             spans: Iterable[tuple] | None = None) -> DataFrame:
    """The rows of a batch that :func:`append_new_rows` would add.

    Only the dates of the batch are read from the stored table.
    """
    t = table_of(table)
    keys = list(t.key)
    batch = batch.dropna(subset=keys)
    held = _held_keys(spark, path, t, batch_spans(batch, t) if spans is None else spans)
    if mode == "skip_rows":
        columns = [c for c in batch.columns if c in stored_schema(t).names]
        single = newest(batch.select(*columns), keys, order or amended_order(t, columns))
        return single.join(held, keys, "left_anti")
    per_file = batch.groupBy(*keys, SOURCE).agg(F.count(F.lit(1)).alias("_n"))
    firsts = batch.groupBy(*keys).agg(F.min(SOURCE).alias("_first"))
    repeated = (per_file.join(firsts, keys)
                .where((F.col("_n") > 1) | (F.col(SOURCE) != F.col("_first"))))
    known = per_file.join(held, keys, "left_semi")
    bad = repeated.select(SOURCE).union(known.select(SOURCE)).distinct()
    return batch.join(bad, SOURCE, "left_anti")


def insert_from_csv(spark: SparkSession, path: str | list[str], store: str, table: Table | str,
                    mode: str = "skip_rows", glob: str = CSV_GLOB, by_name: bool = True,
                    check_year: bool = True) -> Load:
    """Loads one CSV file, or every CSV file of a folder, into a stored table.

    Columns go by a file's own header where it has one. Where the table is split by year
    and a file's name holds a year, rows of other years are rejected; ``check_year=False`` takes them.
    """
    rows = read_csv(spark, path, table, glob, by_name)
    if check_year and table_of(table).by_year:
        rows = check_file_year(rows)
    return append_new_rows(spark, rows, store, table, mode)


def bytes_per_year(df: DataFrame) -> DataFrame:
    """Size of each year of any rows read from files, from the sizes of the files; one row if they are not split.

    :func:`stored_bytes` tells the same of a stored table without reading a row.
    """
    keys = [YEAR] if YEAR in df.columns else []
    files = df.select(*keys, F.col("_metadata.file_path").alias("f"),
                      F.col("_metadata.file_size").alias("size")).distinct()
    return files.groupBy(*keys).agg(F.sum("size").alias("bytes"))


def stored_bytes(spark: SparkSession, path: str, table: Table | str) -> DataFrame:
    """Stored size of each year of a table, from a listing of its files; one row for a table that is not split."""
    keys = [YEAR] if table_of(table).by_year else []
    schema = T.StructType([T.StructField("bytes", T.LongType())])
    if not path_exists(spark, path):
        empty = T.StructType([*[T.StructField(k, T.IntegerType()) for k in keys], *schema])
        return spark.createDataFrame([], empty)
    # the contents are no column that is asked for, so they are not read
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", True).load(path))
    year = F.regexp_extract("path", rf"/{YEAR}=(\d+)/", 1).try_cast("int").alias(YEAR)
    return files.groupBy(*([year] if keys else [])).agg(F.sum("length").alias("bytes"))


def run_sql(spark: SparkSession, text: str, n: int | None = None) -> DataFrame:
    """A query, all rows or its first ``n``."""
    result = spark.sql(text)
    return result if n is None else result.limit(n)
