"""CSV files, with or without a header line, as typed rows of a known table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from halfhourly.functions.dates import file_year, parse_date, parse_timestamp
from halfhourly.functions.text import base_name
from halfhourly.schemas import TABLES, Table
from halfhourly.session import staged, work_folder

REASON = "reject_reason"
SOURCE = "source_file"
CORRUPT = "_corrupt"
CSV_GLOB = "*.{csv,csv.gz}"


def table_of(table: Table | str) -> Table:
    if isinstance(table, Table):
        return table
    if table not in TABLES:
        raise ValueError(f"no table {table!r}: use one of {sorted(TABLES)}")
    return TABLES[table]


def read_csv(spark: SparkSession, path: str | list[str], table: Table | str,
             glob: str = CSV_GLOB, by_name: bool = False) -> DataFrame:
    """All CSV files below a path as typed rows.

    Files may or may not have a header line; each is told by its own lines.
    Columns are taken in table order, or by the names in a file's own header with
    ``by_name``; columns the table does not have are passed over then.  The result has the
    table's columns, ``trading_year`` where the table is split by year, ``source_file`` and
    ``reject_reason`` (null for a good row); see :func:`accepted` and :func:`rejected`.
    A record may go over several lines, where a quoted cell holds line breaks. The text is read once.
    """
    t = table_of(table)
    lines = file_records(spark.read.option("pathGlobFilter", glob).text(path), t)
    return named_rows(lines, t) if by_name else csv_rows(lines, t, t.names)


def file_lines(text: DataFrame) -> DataFrame:
    """The filled lines of text files, read or streamed, with the file each is from."""
    return (text.select("value", F.col("_metadata.file_path").alias(SOURCE))
            .where(F.trim("value") != ""))


#: Lines that one record may have; more are taken for a quote that is never closed.
RECORD_LINES = 1000
_HEAD, _BLOCK, _AT, _ODD = "_head", "_block", "_at", "_odd"


def file_records(text: DataFrame, table: Table, most: int = RECORD_LINES) -> DataFrame:
    """The records of text files with the file each is from and whether it is a header.

    The lines are written to the shared folder once, headers apart, with the place of each and whether it leaves a
    quote open. Only files that have such a line are looked at further, see :func:`joined_lines`.
    """
    plain = F.regexp_replace("value", r"\\.", "")
    odd = F.when(F.contains("value", F.lit('"')), F.regexp_count(plain, F.lit('"')) % 2 == 1).otherwise(False)
    lines = text.select("value", F.col("_metadata.file_path").alias(SOURCE),
                        F.col("_metadata.file_block_start").alias(_BLOCK),
                        F.monotonically_increasing_id().alias(_AT), odd.alias(_ODD))
    filled = F.trim("value") != ""
    seen = Observation()
    place = work_folder(text.sparkSession, "lines")
    (lines.withColumn(_HEAD, filled & is_header("value", table)).observe(seen, F.count_if(_ODD).alias("odd"))
     .write.partitionBy(_HEAD).parquet(place))
    schema = "value string, {} string, {} bigint, {} bigint, {} boolean, {} boolean".format(SOURCE, _BLOCK, _AT, _ODD, _HEAD)
    lines = text.sparkSession.read.schema(schema).parquet(place)
    kept = ["value", SOURCE, _HEAD]
    if not seen.get["odd"]:
        return lines.where(filled).select(*kept)
    spread = staged(lines.where(_ODD).select(SOURCE).distinct(), "spread")
    joined = joined_lines(lines.join(spread, SOURCE, "left_semi"), most)
    joined = staged(joined.withColumn(_HEAD, is_header("value", table)).select(*kept), "records")
    return (lines.join(spread, SOURCE, "left_anti").select(*kept).unionByName(joined)).where(filled)


def joined_lines(lines: DataFrame, most: int = RECORD_LINES) -> DataFrame:
    """Lines of files put together to records: a record goes on while one of its quotes is open.

    Whether a line begins inside quotes is the parity of the lines before it that leave a quote open. It is counted
    inside each block of a file, and one row per block is carried over the blocks, so a file may be
    split: a block notes its lines as they are if it begins outside of quotes, and if it begins inside.
    A record of more than ``most`` lines has a quote that is never closed; its lines are returned one by one.
    """
    inside, block = Window.partitionBy(SOURCE, _BLOCK).orderBy(_AT), [SOURCE, _BLOCK]
    over_blocks = Window.partitionBy(SOURCE).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    odd = F.col(_ODD).cast("int")
    before = F.coalesce(F.sum(odd).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = lines.withColumn("_here", before % 2 == 0)
    starting = {"_even": F.when(F.col("_here"), F.col(_AT)), "_uneven": F.when(~F.col("_here"), F.col(_AT))}
    lines = staged(lines.withColumns({n: F.last_value(at, True).over(inside) for n, at in starting.items()}), "lines-marked")
    blocks = lines.groupBy(*block).agg(F.sum(odd).alias("n"), *[F.max(n).alias(f"{n}_last") for n in starting])
    blocks = blocks.withColumn("_outside", F.coalesce(F.sum("n").over(over_blocks), F.lit(0)) % 2 == 0)
    last = F.when(F.col("_outside"), F.col("_even_last")).otherwise(F.col("_uneven_last"))
    place = F.when(last.isNotNull(), F.struct(_BLOCK, last.alias(_AT)))
    # a row per block, whose stored size tells Spark that it may be broadcast
    blocks = staged(blocks.select(*block, "_outside", F.max(place).over(over_blocks).alias("_earlier")), "blocks")
    start = F.when(F.col("_outside"), F.col("_even")).otherwise(F.col("_uneven"))
    lines = lines.join(blocks, block).withColumn(
        "_record", F.coalesce(F.when(start.isNotNull(), F.struct(_BLOCK, start.alias(_AT))), "_earlier"))
    alone = (F.col("_here") == F.col("_outside")) & ~F.col(_ODD)
    parts, record = lines.where(~alone), [SOURCE, "_record"]
    open_ = staged(parts.groupBy(*record).agg(F.count(F.lit(1)).alias("_lines")).where(F.col("_lines") > most)
                   .select(*record), "open-records")
    ordered = F.array_sort(F.collect_list(F.struct(_BLOCK, _AT, "value")))
    records = (parts.join(open_, record, "left_anti").groupBy(*record).agg(ordered.alias("_parts"))
               .select(SOURCE, F.array_join(F.transform("_parts", lambda p: p["value"]), "\n").alias("value")))
    columns = [SOURCE, "value"]
    return (lines.where(alone).select(*columns).unionByName(records)
            .unionByName(parts.join(open_, record, "left_semi").select(*columns)))


def _heads(lines: DataFrame, table: Table) -> Column:
    return F.col(_HEAD) if _HEAD in lines.columns else is_header("value", table)


def csv_rows(lines: DataFrame, table: Table, order: list[str]) -> DataFrame:
    """Lines as typed rows, their cells in the given order of columns."""
    kinds = {n: raw_type(table.columns[n]).simpleString() for n in order}
    schema = ", ".join([f"`{n}` {kinds[n]}" for n in order] + [f"{CORRUPT} string"])
    data = lines.where(~_heads(lines, table))
    parsed = data.select(SOURCE, F.from_csv("value", schema, {
        "columnNameOfCorruptRecord": CORRUPT, "multiLine": "true", "ignoreLeadingWhiteSpace": "true",
        "ignoreTrailingWhiteSpace": "true"}).alias("_c"))
    return typed_rows(parsed.select(SOURCE, *[f"_c.{n}" for n in order], f"_c.{CORRUPT}"), table)


def named_rows(lines: DataFrame, table: Table) -> DataFrame:
    """Lines as typed rows, their cells by the header of their file, or in table order without one.

    The headers, one row per file, are joined to the lines; nothing is gathered. They are worked out once, into the
    shared folder: their stored size tells Spark to broadcast them, so that lines are not dealt by file.
    """
    names = F.transform(csv_cells("value"), header_name)
    heads = staged(lines.where(_heads(lines, table)).groupBy(SOURCE).agg(F.min(names).alias("_names")), "headers")
    in_order = F.array(*[F.lit(n) for n in table.names])
    rows = (lines.where(~_heads(lines, table)).join(heads, SOURCE, "left")
            .select(SOURCE, csv_cells("value").alias("_cells"), F.coalesce("_names", in_order).alias("_names")))
    found = {n: F.nullif(F.get("_cells", F.array_position("_names", F.lit(n)) - 1), F.lit(""))
             for n in table.names}
    typed = {n: found[n].try_cast(raw_type(table.columns[n])) for n in table.names}
    unread = F.size("_cells") != F.size("_names")
    for n in table.names:
        if not isinstance(raw_type(table.columns[n]), T.StringType):
            unread = unread | (found[n].isNotNull() & typed[n].isNull())
    return typed_rows(rows.select(SOURCE, *[c.alias(n) for n, c in typed.items()],
                                  F.when(unread, F.lit("")).alias(CORRUPT)), table)


def csv_cells(line: Column | str) -> Column:
    """The cells of a line; a quoted one may hold commas, and quotes doubled or behind a backslash."""
    text = F.col(line) if isinstance(line, str) else line
    raw = F.regexp_extract_all(F.concat(F.lit(","), text), F.lit(r',(\s*"(?:[^"\\]++|\\.|"")*+"\s*|[^,]*)'), F.lit(1))

    def plain(cell: Column) -> Column:
        bare = F.trim(cell)
        quoted = F.regexp_replace(F.substring(bare, F.lit(2), F.length(bare) - 2), r'(?:"|\\)(["\\])', "$1")
        return F.when(bare.startswith('"') & bare.endswith('"') & (F.length(bare) > 1), quoted).otherwise(bare)

    # most lines have no quote, and then a comma ends a cell
    return F.when(F.contains(text, F.lit('"')), F.transform(raw, plain)).otherwise(F.transform(F.split(text, ","), lambda cell: F.trim(cell)))


def header_name(cell: Column) -> Column:
    """A heading the way tables name it: lower case, blanks as ``_``."""
    return F.replace(F.lower(F.trim(cell)), F.lit(" "), F.lit("_"))


def is_header(line: Column | str, table: Table) -> Column:
    """Whether a line names the columns: its cells hold the names of all key columns, next to
    names that may be unknown, or are known names and nothing else.

    A name is looked for in the whole line, or its first cell, first, so data lines are told cheaply.
    """
    text = F.col(line) if isinstance(line, str) else line
    cells = F.transform(csv_cells(text), header_name)
    keyed = F.replace(F.lower(text), F.lit(" "), F.lit("_")).contains(table.key[0])
    has_keys = F.forall(F.array(*[F.lit(k) for k in table.key]), lambda k: F.array_contains(cells, k))
    known = header_name(F.translate(F.substring_index(text, ",", 1), '"', "")).isin(table.names)
    return F.when(keyed & has_keys, F.lit(True)).when(
        known, F.forall(cells, lambda c: c.isin(table.names))).otherwise(F.lit(False))


def raw_type(kind: str) -> T.DataType:
    """How a cell is read first: numbers at once, all else as text."""
    return {"int": T.IntegerType(), "double": T.DoubleType()}.get(kind, T.StringType())


def typed_rows(df: DataFrame, table: Table) -> DataFrame:
    """Rows read by :func:`raw_type` as the table's types, with the first reason to
    reject a row.

    A line that cannot be read, a text longer than its column and an empty key
    column reject the row; nothing stops the job.
    """
    dated = [n for n, kind in table.columns.items() if kind in _PARSERS]
    typed = df.withColumns({f"_{n}": _PARSERS[table.columns[n]](F.col(n)) for n in dated})
    reasons = [F.when(F.col(CORRUPT).isNotNull(), F.lit("cannot read the line"))]
    reasons += [F.when(F.col(n).isNotNull() & F.col(f"_{n}").isNull(), F.lit(f"cannot read {n}"))
                for n in dated]
    reasons += [F.when(F.length(n) > table.max_length(n), F.lit(f"{n} too long"))
                for n in table.names if table.max_length(n)]
    reasons += [F.when(F.col(n).isNull(), F.lit(f"no {n}")) for n in table.key]
    checked = typed.withColumn(REASON, F.coalesce(*reasons))
    rows = checked.select(*[F.col(f"_{n}").alias(n) if n in dated else F.col(n)
                            for n in table.names], SOURCE, REASON)
    if not table.by_year:
        return rows
    return rows.select(*table.names, F.year(table.date_col).alias("trading_year"), SOURCE, REASON)


def _clock(cell: Column) -> Column:
    return F.nullif(F.regexp_extract(cell, r"^(\d{1,2}:\d{2})(?::\d{2})?$", 1), F.lit(""))


_PARSERS = {"date": parse_date, "timestamp": parse_timestamp, "time": _clock}


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(REASON).isNull()).drop(REASON)


def rejected(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(REASON).isNotNull())


def check_file_year(rows: DataFrame) -> DataFrame:
    """Rejects rows whose year is not the year in their file's name, where it has one."""
    named = file_year(base_name(SOURCE))
    differs = named.isNotNull() & (named != F.col("trading_year").cast("string"))
    return rows.withColumn(REASON, F.coalesce(
        F.col(REASON), F.when(differs, F.lit("year differs from file name"))))


def read_metadata(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The node metadata: one row per ``Node`` and whatever other columns it has, as text.

    ``columns`` names them where the file has no header.
    """
    reader = spark.read.option("header", columns is None)
    if columns is not None:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns))
    df = reader.csv(path)
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A folder of CSV files, each with a header."""
    df.write.mode(mode).option("header", True).csv(path)
