"""XML files, pages, their links and their tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from halfhourly.functions.text import (NESTED_TABLE, TABLE, TABLE_CELL, TABLE_ROW, anchors, href_of,
                                       html_text, spread, visible_html)
from halfhourly.schemas import Table
from halfhourly.sources.nested import nested_table_rows
from halfhourly.sources.csvfiles import CORRUPT, SOURCE, raw_type, table_of, typed_rows


def read_xml(spark: SparkSession, path: str, table: Table | str,
             row_tag: str = "Row") -> DataFrame:
    """One row per ``row_tag`` element, typed and checked as CSV rows are.

    Element names are those of the table in upper case, as published.
    """
    t = table_of(table)
    schema = T.StructType([T.StructField(n.upper(), raw_type(k)) for n, k in t.columns.items()]
                          + [T.StructField(CORRUPT, T.StringType())])
    rows = (spark.read.format("xml").option("rowTag", row_tag)
            .option("columnNameOfCorruptRecord", CORRUPT).schema(schema).load(path))
    return typed_rows(rows.select(*[F.col(n.upper()).alias(n) for n in t.names], CORRUPT,
                                  F.col("_metadata.file_path").alias(SOURCE)), t)


def read_pages(spark: SparkSession, path: str, glob: str = "*.htm*") -> DataFrame:
    """Stored pages: ``name`` (path) and ``html``, one row per file."""
    return (spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("name"), F.col("value").alias("html")))


def page_links(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Every link of a page: the page's other columns, ``link_no``, ``href``, ``text``."""
    others = [c for c in pages.columns if c != html_col]
    numbered, filled = spread(anchors(html_col), "link_no", "_a")
    found = pages.select(*others, numbered).where(filled)
    return (found.select(*others, "link_no", href_of("_a").alias("href"),
                         html_text("_a").alias("text"))
            .where(F.col("href") != ""))


def page_table(html_col: str, table_no: int) -> Column:
    """The n-th table of a page (from 0) as an array of rows of cell texts."""
    table = F.get(F.regexp_extract_all(visible_html(html_col), F.lit(TABLE), F.lit(0)),
                  F.lit(table_no))
    rows = F.regexp_extract_all(table, F.lit(TABLE_ROW), F.lit(0))
    return F.transform(rows, lambda r: F.transform(
        F.regexp_extract_all(r, F.lit(TABLE_CELL), F.lit(0)), lambda c: F.trim(html_text(c))))


def page_table_rows(pages: DataFrame, table_no: int, html_col: str = "html") -> DataFrame:
    """The rows of the n-th table of a page (from 0): ``row_no`` and text ``cells``.

    Tables count in the order in which they open. Pages with a table inside another are parsed by a stack of
    open tags, all others by patterns; rows of malformed tables are left to :func:`nested_table_rows`, which names the reason.
    """
    others = [c for c in pages.columns if c != html_col]
    inside = F.coalesce(visible_html(html_col).rlike(NESTED_TABLE), F.lit(False))
    numbered, filled = spread(page_table(html_col, table_no), "row_no", "cells")
    flat = pages.where(~inside).select(*others, numbered).where(filled)
    deep = nested_table_rows(pages.where(inside), html_col).where(
        (F.col("table_no") == table_no) & F.col("reject_reason").isNull()).select(*others, "row_no", "cells")
    return flat.unionByName(deep)
