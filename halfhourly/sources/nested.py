"""Tables of pages, those inside the cells of others too, by a stack of open tags."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

_PIECE = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<(/?)(table|tr|t[dh])\b[^>]*>|<[a-z/!?][^>]*>|[^<]+|<")
UNCLOSED, UNOPENED, OUTSIDE = "table is not closed", "closing tag without a table", "text or cell outside of a row"


@dataclass
class _Table:
    number: int
    parent: int | None
    rows: list[list[str]] = field(default_factory=list)
    row: list[str] | None = None
    cell: list[str] | None = None
    reason: str | None = None

    def end_cell(self) -> None:
        if self.cell is not None:
            self.row.append(" ".join(html.unescape("".join(self.cell)).split()))
            self.cell = None

    def end_row(self) -> None:
        self.end_cell()
        if self.row is not None:
            self.rows.append(self.row)
            self.row = None


def tables_of(page: str) -> list[_Table]:
    """The tables of a page in the order in which they open; a table with a reason is malformed.

    A cell ends where the next cell or row begins and a row where the next one does, as their closing tags may be left
    out. A cell's text is without that of tables inside it.
    """
    found: list[_Table] = []
    stack: list[_Table] = []
    for m in _PIECE.finditer(page):
        name = (m.group(3) or "").lower()
        if not name:
            text = m.group()
            if not stack or text.startswith("<") and len(text) > 1:
                continue
            if stack[-1].cell is not None:
                stack[-1].cell.append(text)
            elif text.strip() and not stack[-1].rows and stack[-1].row is None:
                continue                                    # a caption
            elif text.strip():
                stack[-1].reason = stack[-1].reason or OUTSIDE
        elif name == "table" and not m.group(2):
            if stack and stack[-1].cell is not None:
                stack[-1].cell.append(" ")
            stack.append(_Table(len(found), stack[-1].number if stack else None))
            found.append(stack[-1])
        elif name == "table":
            if stack:
                stack[-1].end_row()
                stack.pop()
            else:
                found.append(_Table(len(found), None, reason=UNOPENED))
        elif stack:
            table = stack[-1]
            if name == "tr":
                table.end_row()
                table.row = None if m.group(2) else []
            else:
                table.end_cell()
                if not m.group(2) and table.row is None:
                    table.reason, table.row = table.reason or OUTSIDE, []
                table.cell = None if m.group(2) else []
    for table in stack:
        table.end_row()
        table.reason = table.reason or UNCLOSED
    return found


def nested_table_rows(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Every row of every table: the page's other columns, ``table_no`` from 0 in the order in which tables open,
    ``parent_no`` of the table whose cell it is in, ``row_no``, ``cells`` and ``reject_reason``.

    A malformed table keeps its rows, each with the reason; one without rows is a single row without ``row_no``.
    Null pages have no tables. A page is parsed in one go and held as a whole, as it is one value.
    """
    others = [c for c in pages.columns if c != html_col]
    kinds = [pages.schema[c] for c in others]
    result = T.StructType([*kinds, T.StructField("table_no", T.IntegerType()), T.StructField("parent_no", T.IntegerType()),
                           T.StructField("row_no", T.IntegerType()), T.StructField("cells", T.ArrayType(T.StringType())),
                           T.StructField("reject_reason", T.StringType())])
    names = [f.name for f in result]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for *kept, page in frame.itertuples(index=False, name=None):
                for t in tables_of(page or ""):
                    listed = list(enumerate(t.rows)) or ([(None, None)] if t.reason else [])
                    rows += [(*kept, t.number, t.parent, n, cells, t.reason) for n, cells in listed]
            out = pd.DataFrame(rows, columns=names, dtype=object)
            yield out

    return pages.select(*others, F.col(html_col).cast("string")).mapInPandas(run, result)
