"""Conversation structure repair by weighted CYK interval parsing.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``. Edits make it
so: keep a row (0), give it the role user or assistant (1), delete it (2), insert an empty
turn of user or assistant (5); a truncated row that stays costs 5 more, blank and repeated rows
cannot stay. The repair grammar is in Chomsky normal form. Its symbols ``p:q`` stand for "rows that
lead from the last role p to the last role q", with rules

    p:q -> row          one edit of one row
    p:r -> p:q q:r      two neighbouring spans
    p:q -> I p':q, p:q' I    inserted turns, closed over in every cell

A cell holds, for each symbol, the least (cost, audit) of its span, where the audit is the initials
of the edits. Charts are filled bottom-up by span length. Two audits of the same span and cost never begin one
another, so the least of a whole is made of the least of its parts.

As every symbol tells all that its span's surroundings need, spans of any length are parsed in
blocks: a chart over ``BLOCK`` rows, a chart over the cells of ``BLOCK`` blocks, and so on.
Rows are cut into ranges of (conversation, turn, ...). A conversation that lies inside a range is
repaired there in one pass. One that reaches a range's edge, or has more than ``ROWS_AT_ONCE`` rows,
takes the same way in blocks of its rows, grouped over all tasks, so no task holds a whole
conversation, however long. Only the digest of its repaired rows is sequential: those rows stream
through one task.

Faults, the first of a row counts: ``blank`` (nothing but white space), ``duplicate`` (role and text equal an
earlier row's of the conversation), ``truncated`` (the last character that is no white space is none of
``.!?``).

Defined cases: a null role or text is one space (so the text is blank and the role unknown, which only
deleting or a new role mends); an empty role is unknown too; rows without a turn come first; rows of one turn
are in the order of role and text; repeated rows are duplicates; rows without a conversation form one; no rows
give no rows; other columns stay behind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from halfhourly.llm.common import fresh
from halfhourly.llm.turns import as_strings, in_order, partitions, stream_digests
from halfhourly.session import staged

BLOCK, ROWS_AT_ONCE, BYTES_AT_ONCE = 16, 4096, 8_000_000
RELABEL, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
FINE, BLANK, DUPLICATE, CUT = range(4)
_SPACE = b" \t\n\x0b\x0c\r"

#: The last role so far: none, system, user, assistant. A conversation may end with none or assistant.
NONE, SYSTEM, USER, ASSISTANT = range(4)
_ENDS = (NONE, ASSISTANT)
_NEXT = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_KEEPS = {"s": {NONE: SYSTEM}, "u": {p: USER for p in (NONE, SYSTEM, ASSISTANT)}, "a": {USER: ASSISTANT}, "o": {}}
_LEGAL = {"su", "ua", "au"}

#: (cost, audit) by symbol; a symbol is 4 * from + to.
Cells = dict[int, tuple[int, str]]


def _better(cells: Cells, symbol: int, cost: int, audit: str) -> bool:
    old = cells.get(symbol)
    if old is None or (cost, audit) < old:
        cells[symbol] = (cost, audit)
        return True
    return False


def closed(cells: Cells) -> Cells:
    """The cells with turns inserted before and after, until none gets better."""
    waiting = list(cells)
    while waiting:
        symbol = waiting.pop()
        cost, audit = cells[symbol]
        p, q = divmod(symbol, 4)
        for before, after in _NEXT.items():
            if after == p and _better(cells, 4 * before + q, cost + INSERT, "I" + audit):
                waiting.append(4 * before + q)
        if _better(cells, 4 * p + _NEXT[q], cost + INSERT, audit + "I"):
            waiting.append(4 * p + _NEXT[q])
    return cells


def combined(spans: list[tuple[Cells, Cells]]) -> Cells:
    """The cell of a span from all its cuts into two."""
    cells: Cells = {}
    for left, right in spans:
        by_start: dict[int, list] = {}
        for symbol, cell in right.items():
            by_start.setdefault(symbol >> 2, []).append((symbol & 3, cell))
        for symbol, (cost, audit) in left.items():
            for r, (more, rest) in by_start.get(symbol & 3, ()):
                _better(cells, (symbol & ~3) | r, cost + more, audit + rest)
    return closed(cells)


def chart(leaves: list[Cells]) -> Cells:
    """CYK: the cell of the whole span, filled bottom-up by span length."""
    rows: list[list[Cells]] = [leaves]
    for length in range(2, len(leaves) + 1):
        rows.append([combined([(rows[k - 1][i], rows[length - k - 1][i + k]) for k in range(1, length)])
                     for i in range(len(leaves) - length + 1)])
    return rows[-1][0]


@lru_cache(maxsize=64)
def leaf(initial: str, fault: int) -> Cells:
    """What may become of one row."""
    cells: Cells = {}
    for p in range(4):
        _better(cells, 5 * p, DELETE, "D")
        if fault in (FINE, CUT):
            more = TRUNCATED if fault == CUT else 0
            _better(cells, 4 * p + _NEXT[p], RELABEL + more, "R")
            if p in _KEEPS[initial]:
                _better(cells, 4 * p + _KEEPS[initial][p], more, "K")
    return closed(cells)


def sign(initial: str, fault: int) -> str:
    """One letter for a row's role and fault."""
    return chr(ord("A") + 4 * "suao".index(initial) + fault)


def initial_of(role: bytes) -> str:
    first = role[:1].decode("latin-1")
    return first if first and first in "sua" else "o"


@lru_cache(maxsize=50_000)
def block_cells(signs: str) -> Cells:
    """The chart over one block of rows."""
    return chart([leaf("suao"[(ord(c) - 65) // 4], (ord(c) - 65) % 4) for c in signs])


def in_blocks(spans: list[Cells]) -> Cells:
    """Charts over blocks of neighbouring spans, level by level."""
    while len(spans) > 1:
        spans = [chart(spans[i:i + BLOCK]) for i in range(0, len(spans), BLOCK)]
    return spans[0]


def parsed(signs: str) -> Cells:
    if not signs:
        return {5 * p: (0, "") for p in range(4)}
    return in_blocks([block_cells(signs[i:i + BLOCK]) for i in range(0, len(signs), BLOCK)])


def cheapest(cells: Cells) -> tuple[int, str]:
    return min(cells[q] for q in _ENDS if q in cells)


class Editor:
    """Applies edits one after the other; knows the last role."""

    def __init__(self):
        self.last = NONE

    def role(self, edit: str, role: bytes | None) -> bytes:
        """The role of the next turn that stays."""
        if edit == "K":
            self.last = _KEEPS[initial_of(role)][self.last]
            return role
        self.last = _NEXT[self.last]
        return b"user" if self.last == USER else b"assistant"


def row_fault(text: bytes) -> int:
    """A fault that a row has by itself."""
    end = text.rstrip(_SPACE)[-1:]
    return BLANK if not end else FINE if end in b".!?" else CUT


class Repaired:
    """One conversation, given its rows (turn, role, text) in order."""

    def __init__(self, rows: list[tuple]):
        seen: set[tuple[bytes, bytes]] = set()
        faults = []
        for _, role, text in rows:
            fault = row_fault(text)
            faults.append(DUPLICATE if fault != BLANK and (role, text) in seen else fault)
            seen.add((role, text))
        initials = [initial_of(role) for _, role, _ in rows]
        self.cost, self.audit = cheapest(parsed("".join(map(sign, initials, faults))))
        turns = {turn for turn, _, _ in rows if turn is not None}
        self.gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        self.blank, self.duplicate, self.truncated = (faults.count(f) for f in (BLANK, DUPLICATE, CUT))
        self.illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
        self.turns = []                 # (edit, turn, role, text) of what stays
        editor, at = Editor(), iter(rows)
        for edit in self.audit:
            turn, role, text = (None, None, b"") if edit == "I" else next(at)
            if edit != "D":
                self.turns.append((edit, turn, editor.role(edit, role), text))

    def summary(self) -> tuple:
        text = b"\n".join(role + b":" + text for _, _, role, text in self.turns)
        return (self.gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, self.audit,
                hashlib.sha256(text).hexdigest())


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_SUMMARY = [*_COUNTS, "audit", "repaired_sha256"]
#: Rows of the pass over the ranges: a finished conversation, a turn that stays, a row left open.
_DONE, _TURN, _OPEN = range(3)


def _spaced(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def _schema(kind: str) -> str:
    return (f"conv {kind}, kind int, part int, place bigint, turn bigint, role string, text string, "
            + ", ".join(f"{c} bigint" for c in _COUNTS) + ", audit string, repaired_sha256 string")


def _ranges(turns: DataFrame, conv: str, turn: str, role: str, text: str, want_turns: bool) -> DataFrame:
    """One pass over ranges of rows: conversations inside a range finished, rows of the others left open."""
    rows = turns.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("bigint").alias("turn"),
                        _spaced(F.col(f"`{role}`")).alias("role"), _spaced(F.col(f"`{text}`")).alias("text"))
    keys = [F.col("conv").asc_nulls_first(), *in_order(F.col("turn"), F.col("role"), F.col("text"))]
    cut = rows.repartitionByRange(partitions(rows), *keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, kind, out, held = TaskContext.get().partitionId(), None, [], 0
        current, own, size, place, open_ = None, [], 0, 0, True     # the first conversation reaches the edge

        def leave_open() -> None:
            nonlocal own, size, place
            for t, r, x in own:
                out.append((current, _OPEN, part, place, t, r, x, *[None] * len(_SUMMARY)))
                place += 1
            own, size = [], 0

        def finish() -> None:
            done = Repaired(own)
            if not want_turns:
                out.append((current, _DONE, part, None, None, None, None, *done.summary()))
            for n, (edit, t, r, x) in enumerate(done.turns if want_turns else ()):
                out.append((current, _TURN, part, n, t, r, x, *[None] * len(_COUNTS), edit, None))

        def made() -> pa.RecordBatch:
            nonlocal out, held
            columns = list(zip(*out))
            out, held = [], 0
            kinds = [kind, pa.int32(), pa.int32(), pa.int64(), pa.int64(), None, None,
                     *[pa.int64()] * len(_COUNTS), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [as_strings(c) if t is None else pa.array(c, t) for c, t in zip(columns, kinds)],
                names=["conv", "kind", "part", "place", "turn", "role", "text", *_SUMMARY])

        begun = False
        for batch in batches:
            kind = batch.schema.field(0).type
            raw = [batch.column(c).cast(pa.binary()).to_pylist() for c in (2, 3)]
            for c, t, r, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), *raw):
                if not begun or c != current:
                    if begun:
                        leave_open() if open_ else finish()
                        open_ = False
                    begun, current, own, size, place = True, c, [], 0, 0
                own.append((t, r, x))
                size += len(x)
                held += len(x) + 64
                if len(own) >= ROWS_AT_ONCE or size > BYTES_AT_ONCE:
                    open_ = True
                    leave_open()
                if held > 4_000_000 and out:
                    yield made()
        if begun:
            leave_open()                # the last conversation reaches the edge
        if out:
            yield made()

    return staged(cut.mapInArrow(run, _schema(cut.schema["conv"].dataType.simpleString())), "repair-ranges")


def _same(left: str, right: str, keys: list[str]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return same


_SPAN = "cells array<struct<symbol int, cost bigint, audit string>>, first string, last string, illegal bigint"


def _span(cells: Cells, first: str, last: str, illegal: int) -> dict:
    return {"cells": [{"symbol": s, "cost": c, "audit": a} for s, (c, a) in cells.items()],
            "first": first, "last": last, "illegal": illegal}


def _charted(blocks: DataFrame, spans_of) -> DataFrame:
    """One span per block: ``blocks`` has conv, block and parts, the block's parts in order."""
    kind = blocks.schema["conv"].dataType.simpleString()
    cell = pa.struct([("symbol", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    spans = pa.schema([("cells", pa.list_(cell)), ("first", pa.string()), ("last", pa.string()),
                       ("illegal", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.RecordBatch.from_pylist([spans_of(parts) for parts in batch.column(2).to_pylist()], schema=spans)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made.columns],
                                             names=["conv", "block", *made.schema.names])

    return blocks.mapInArrow(run, f"conv {kind}, block bigint, {_SPAN}")


def _of_rows(signs: list[dict]) -> dict:
    text = "".join(p["sign"] for p in signs)
    initials = ["suao"[(ord(c) - 65) // 4] for c in text]
    return _span(block_cells(text), initials[0], initials[-1],
                 sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:])))


def _of_spans(spans: list[dict]) -> dict:
    cells = chart([{c["symbol"]: (c["cost"], c["audit"]) for c in s["cells"]} for s in spans])
    between = sum(a["last"] + b["first"] not in _LEGAL for a, b in zip(spans, spans[1:]))
    return _span(cells, spans[0]["first"], spans[-1]["last"], between + sum(s["illegal"] for s in spans))


def _parts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Neighbouring rows by ``BLOCK``, each group of them one row; ``place`` numbers a conversation's rows."""
    return (df.groupBy("conv", F.expr(f"place div {BLOCK}").alias("block"))
            .agg(F.array_sort(F.collect_list(F.struct("place", *columns))).alias("parts"))
            .select("conv", "block", "parts"))


def _numbered(rows: DataFrame) -> DataFrame:
    """``place`` counted from a conversation's beginning instead of its part's."""
    ends = rows.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = staged(ends.select("conv", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")),
                    "repair-before")
    return (rows.alias("l").join(before.alias("r"), _same("l", "r", ["conv", "part"]))
            .select("l.conv", (F.col("place") + F.col("before")).alias("place"), "turn", "role", "text"))


def _faulted(rows: DataFrame) -> DataFrame:
    """Rows with their fault and sign."""
    marked = rows.withColumn("digest", F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256))
    firsts = staged(marked.groupBy("conv", "digest").agg(F.min("place").alias("first_place")), "repair-firsts")
    space = r"\x20\x09-\x0D"
    fault = (F.when(~F.col("text").rlike(f"[^{space}]"), BLANK)
             .when(F.col("place") > F.col("first_place"), DUPLICATE)
             .when(F.col("text").rlike(rf"[.!?][{space}]*\z"), FINE).otherwise(CUT))
    initial = F.substring("role", 1, 1)
    known = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return (marked.alias("l").join(firsts.alias("r"), _same("l", "r", ["conv", "digest"]))
            .select("l.conv", "place", "turn", "role", "text", fault.alias("fault"))
            .withColumn("sign", F.char((F.lit(65) + 4 * known + F.col("fault")).cast("long"))))


def _open_summaries(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts, cost and audit of conversations left open, with their rows."""
    rows = staged(_faulted(_numbered(rows)), "repair-open")
    spans = staged(_charted(_parts(rows, ["sign"]), _of_rows), "repair-spans")
    while (spans.agg(F.max("block")).first()[0] or 0) > 0:
        spans = staged(_charted(_parts(spans.withColumnRenamed("block", "place"),
                                       ["cells", "first", "last", "illegal"]), _of_spans), "repair-spans")
    best = F.array_min(F.transform(F.filter("cells", lambda c: c["symbol"].isin(*_ENDS)),
                                   lambda c: F.struct(c["cost"], c["audit"])))
    done = spans.select("conv", "illegal", best.alias("best")).select("conv", "illegal", "best.cost", "best.audit")
    counts = rows.groupBy("conv").agg(
        *[F.count(F.when(F.col("fault") == f, 1)).alias(n) for f, n in
          ((BLANK, "blank"), (DUPLICATE, "duplicate"), (CUT, "truncated"))],
        (F.max("turn") - F.min("turn") + 1).alias("reach"))
    distinct = rows.where("turn IS NOT NULL").select("conv", "turn").distinct().groupBy("conv").agg(
        F.count(F.lit(1)).alias("n_turns"))
    joined = (counts.alias("l").join(distinct.alias("r"), _same("l", "r", ["conv"]), "left")
              .select("l.*", F.coalesce(F.col("reach") - F.col("n_turns"), F.lit(0)).alias("gaps")))
    summary = joined.alias("l").join(done.alias("r"), _same("l", "r", ["conv"])).select("l.conv", *_COUNTS, "audit")
    return staged(summary, "repair-audits"), rows


def _open_turns(summary: DataFrame, rows: DataFrame) -> DataFrame:
    """The turns that stay of conversations left open; the audit comes first, then the rows, in one stream."""
    kind = rows.schema["conv"].dataType.simpleString()
    stream = (rows.select("conv", "place", "turn", "role", "text")
              .unionByName(summary.select("conv", F.lit(-1).cast("bigint").alias("place"),
                                          F.lit(None).cast("bigint").alias("turn"),
                                          F.lit("").alias("role"), F.col("audit").alias("text")))
              .repartition(partitions(rows), "conv").sortWithinPartitions("conv", "place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, n, editor, out, size, kept = None, "", 0, 0, None, [], 0, None

        def inserted() -> Iterator[tuple]:
            nonlocal at, n
            while at < len(audit) and audit[at] == "I":
                at, n = at + 1, n + 1
                yield conv, n - 1, "I", None, editor.role("I", None), b""

        def made() -> pa.RecordBatch:
            nonlocal out, size
            c, p, e, t, r, x = zip(*out)
            out, size = [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kept), pa.array(p, pa.int64()), pa.array(e), pa.array(t, pa.int64()),
                 as_strings(r), as_strings(x)], names=["conv", "place", "edit", "turn", "role", "text"])

        for batch in batches:
            kept = batch.schema.field(0).type
            raw = [batch.column(c).cast(pa.binary()).to_pylist() for c in (3, 4)]
            for c, p, t, r, x in zip(*[batch.column(i).to_pylist() for i in range(3)], *raw):
                if p < 0:
                    conv, audit, at, n, editor = c, x.decode(), 0, 0, Editor()
                else:
                    edit, at = audit[at], at + 1
                    if edit != "D":
                        out.append((c, n, edit, t, editor.role(edit, r), x))
                        n += 1
                out.extend(inserted())
                size += len(x)
                if size > 4_000_000 and out:
                    yield made()
        if out:
            yield made()

    return stream.mapInArrow(run, f"conv {kind}, place bigint, edit string, turn bigint, role string, text string")


def repaired_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                           text: str = "text") -> DataFrame:
    """One row per conversation: ``conv``, ``gaps`` in the turns, numbers of ``blank``, ``duplicate`` and
    ``truncated`` rows and of ``illegal`` neighbours, ``cost`` and ``audit`` of the cheapest repair, and
    ``repaired_sha256`` of the lines role:text that stay."""
    ranges = _ranges(turns, conv, turn, role, text, want_turns=False)
    summary, rows = _open_summaries(ranges.where(F.col("kind") == _OPEN))
    lines = _open_turns(summary, rows).withColumn("line", F.concat_ws(":", "role", "text"))
    digests = stream_digests(lines, "conv", ["place"], "line", "\n")
    open_ = (summary.alias("l").join(digests.alias("r"), _same("l", "r", ["conv"]), "left")
             .select("l.*", F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))
    done = ranges.where(F.col("kind") == _DONE).select("conv", *_SUMMARY)
    return done.unionByName(open_.select("conv", *_SUMMARY)).withColumnRenamed("conv", conv)


def repaired_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """The turns that stay: ``conv``, ``place`` from 0, ``edit`` (K kept, R new role, I inserted), turn, role, text."""
    ranges = _ranges(turns, conv, turn, role, text, want_turns=True)
    open_ = _open_turns(*_open_summaries(ranges.where(F.col("kind") == _OPEN)))
    done = ranges.where(F.col("kind") == _TURN).select("conv", "place", F.col("audit").alias("edit"),
                                                       "turn", "role", "text")
    names = {"conv": conv, "turn": turn, "role": role, "text": text}
    return done.unionByName(open_).select(*[F.col(c).alias(names.get(c, c)) for c in done.columns])


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with the faults of the registered query: by CRC-32 of ``conv_id:turn``, of 20 rows one is
    dropped, one emptied, one loses its sentence ends, one is repeated and one is given to the user."""
    kind = fresh(turns, "kind")
    key = F.concat_ws(":", _spaced(F.col("conv_id")), _spaced(F.col("turn")))
    rows = turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"), _spaced(F.col("role")).alias("role"),
                        _spaced(F.col("text")).alias("text"), (F.crc32(key.cast("binary")) % 20).alias(kind))
    fault = F.col(kind)
    return (rows.where(fault != 0)
            .select("conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias(kind))
            .drop(kind))
