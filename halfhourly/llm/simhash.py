"""Near-duplicates by SimHash, linked through the anchors of a covering code.

A fingerprint has 64 bits. 46 of them are read as two words of the perfect
binary Golay code of length 23, whose covering radius is 3. The anchors are the
pairs of code words. Each fingerprint has one home, the anchor nearest to it, and
is copied to every anchor whose cell holds a point within ``max_bits`` flips of it,
that is within covering radius plus threshold. Two fingerprints that differ in at
most ``max_bits`` bits of 64 differ in no more of the 46, so the second one is always
copied to the home of the first: no link is lost, and each anchor compares only
its homes with its copies. Distances are then taken over all 64 bits.

Equal fingerprints are one fingerprint from the start, so a group of copies of
any size costs one row. Links join distinct fingerprints only; one has at most
``1 + 64 + 2016`` others within two bits, whatever the size of the table.

Defined cases: a null or blank text has fingerprint zero and is linked like any
other; a null id never is the smallest of a component unless all ids are null;
repeated rows are rows of their own; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from halfhourly.llm.common import arrow_texts, fresh, texts_of
from halfhourly.session import staged

SEED = 42
_SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64 majority bits of a text's shingles, as an unsigned number.

    A-Z are lower-cased, words end at blanks and the five ASCII line and tab marks.
    """
    words = text.lower().split()  # of bytes: ASCII letters, ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.cumsum(sizes + 1) - sizes - 1
    ends = (starts + sizes)[shingle - 1:].tolist()
    digest, seed = xxhash.xxh64_intdigest, SEED
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends)],
                      dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _SHINGLES_AT_ONCE):
        part = hashes[at:at + _SHINGLES_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str, keep: list[str], shingle: int = 3) -> DataFrame:
    """The ``keep`` columns of each row and its ``fingerprint`` (signed long)."""
    read = arrow_texts(docs, text_col, keep)
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t, shingle) for t in texts_of(batch, n)], dtype="<u8")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array(values.view("<i8"), pa.int64())],
                names=[*batch.schema.names[:n], "fingerprint"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in read.schema.fields[:n])
    made = read.mapInArrow(run, (kinds + ", " if kinds else "") + "fingerprint bigint")
    return made.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "fingerprint")


#: Fixed value: generator polynomial of the binary Golay code of length 23.
_GOLAY = 0b101011100011
_LENGTH, _CHECK_BITS = 23, 11


def _syndrome(word: int) -> int:
    for bit in range(_LENGTH - 1, _CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= _GOLAY << (bit - _CHECK_BITS)
    return word


def _patterns(weight: int) -> list[int]:
    if weight == 0:
        return [0]
    lower = _patterns(weight - 1)
    return [p | 1 << b for p in lower for b in range(p.bit_length(), _LENGTH)]


@lru_cache(maxsize=4)
def _reach(max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome, what takes a word to the anchors within reach, and the flips it costs.

    Padded with cost 99. The first entry costs nothing and leads to the home.
    """
    unit = [_syndrome(1 << b) for b in range(_LENGTH)]
    leader = {}
    for weight in range(4):
        for p in _patterns(weight):
            s = 0
            for b in range(_LENGTH):
                if p >> b & 1:
                    s ^= unit[b]
            leader.setdefault(s, p)
    flips = []
    for weight in range(max_bits + 1):
        for p in _patterns(weight):
            s = 0
            for b in range(_LENGTH):
                if p >> b & 1:
                    s ^= unit[b]
            flips.append((p, s, weight))
    rows = []
    for s in range(1 << _CHECK_BITS):
        masks: dict[int, int] = {}
        for p, t, weight in flips:
            masks.setdefault(p ^ leader[s ^ t], weight)
        rows.append(masks)
    width = max(map(len, rows))
    to = np.zeros((len(rows), width), dtype=np.int64)
    cost = np.full((len(rows), width), 99, dtype=np.int64)
    for s, masks in enumerate(rows):
        to[s, :len(masks)] = list(masks)
        cost[s, :len(masks)] = list(masks.values())
    return to, cost


@lru_cache(maxsize=1)
def _syndrome_parts() -> list[np.ndarray]:
    return [np.array([_syndrome(v << shift) if v << shift < 1 << _LENGTH else 0
                      for v in range(256)], dtype=np.int64) for shift in (0, 8, 16)]


def _syndromes(words: np.ndarray) -> np.ndarray:
    low, mid, high = _syndrome_parts()
    return low[words & 255] ^ mid[words >> 8 & 255] ^ high[words >> 16 & 255]


def anchors(values: np.ndarray, max_bits: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, anchor and whether it is the home, for every anchor in reach of each value."""
    to, cost = _reach(max_bits)
    bits = values.view("<u8")
    words = [(bits & np.uint64((1 << _LENGTH) - 1)).astype(np.int64),
             (bits >> np.uint64(_LENGTH) & np.uint64((1 << _LENGTH) - 1)).astype(np.int64)]
    s = [_syndromes(w) for w in words]
    total = cost[s[0]][:, :, None] + cost[s[1]][:, None, :]
    row, first, second = np.nonzero(total <= max_bits)
    low = words[0][row] ^ to[s[0][row], first]
    high = words[1][row] ^ to[s[1][row], second]
    return row, high << _LENGTH | low, (first == 0) & (second == 0)


def _replicated(prints: DataFrame, max_bits: int) -> DataFrame:
    """(anchor, home, fingerprint) for every anchor in reach of each fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(values), 1024):
                part = np.ascontiguousarray(values[at:at + 1024])
                row, anchor, home = anchors(part, max_bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(home), pa.array(part[row])],
                    names=["anchor", "home", "fingerprint"])

    return prints.select("fingerprint").mapInArrow(
        run, "anchor bigint, home boolean, fingerprint bigint")


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints that differ in at most ``max_bits`` bits, each once."""
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be from 0 to 3")
    copies = _replicated(prints, max_bits)
    homes = copies.where("home").select("anchor", F.col("fingerprint").alias("a"))
    others = copies.select("anchor", F.col("fingerprint").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return (homes.join(others, "anchor").where((F.col("a") < F.col("b")) & near)
            .select("a", "b"))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root): the smallest node that each linked node reaches.

    Large-star and small-star steps in turn, until no edge changes; each round is
    written to the shared folder. A hub meets its edges through a minimum, which is
    taken before the shuffle, and a join that may be split, never as a list.
    """

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large \
            else pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        # written first: its size tells Spark how to join, and the edges of a hub need not come to one task
        low = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), f"{label}-low")
        joined = both.join(low, "a")
        if large:
            moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            moved = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).union(
                low.select("a", F.col("low").alias("b")))
        return moved.where("a <> b").distinct()

    def mark(pairs: DataFrame):
        return pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    pairs = edges.select("a", "b")
    seen = None
    while True:
        pairs = staged(star(star(pairs, large=True), large=False), label)
        now = mark(pairs)
        if now == seen:
            break
        seen = now
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))


def fingerprint_components(prints: DataFrame, id_col: str, max_bits: int = 2) -> DataFrame:
    """(fingerprint, component_id, n_links) for each distinct fingerprint of ``prints``.

    ``component_id`` is the smallest id that is reached through links.
    """
    distinct = staged(prints.groupBy("fingerprint").agg(F.min(f"`{id_col}`").alias("low_id")), "prints")
    pairs = staged(links(distinct, max_bits), "links")
    roots = components(pairs)
    named = (distinct.join(roots, distinct["fingerprint"] == roots["node"], "left")
             .select("fingerprint", "low_id", F.coalesce("root", "fingerprint").alias("root")))
    lowest = named.groupBy("root").agg(F.min("low_id").alias("component_id"))
    degree = (pairs.select(F.explode(F.array("a", "b")).alias("node"))
              .groupBy("node").agg(F.count(F.lit(1)).alias("n_links")))
    return (named.join(lowest, "root").join(degree, F.col("fingerprint") == F.col("node"), "left")
            .select("fingerprint", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links")))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per document: id, ``fingerprint``, ``component_id`` and ``n_links`` of its fingerprint."""
    prints = staged(fingerprints(docs, text_col, [id_col], shingle), "fingerprints")
    known = fingerprint_components(prints, id_col, max_bits)
    return prints.join(known, "fingerprint").select(
        F.col(f"`{id_col}`"), "fingerprint", "component_id", "n_links")


def simhash_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each component: the smallest id, then the first row as read.

    Null ids come last.
    """
    row = fresh(docs, "row_")
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    prints = staged(fingerprints(rows, text_col, [id_col, row], shingle), "fingerprints")
    known = fingerprint_components(prints, row, max_bits)
    first = F.min(F.struct(F.col(f"`{id_col}`").isNull(), F.col(f"`{id_col}`"), F.col(row)))
    chosen = (prints.join(known, "fingerprint").groupBy("component_id")
              .agg(first[row].alias("chosen_row")))
    return rows.join(chosen, rows[row] == chosen["chosen_row"], "left_semi").drop(row)
