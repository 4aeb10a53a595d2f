"""Benchmark decontamination by greedy string tiling.

Words are lower-cased runs of letters, digits and underscores. A document is joined
with the benchmark items that share a window of ``min_match`` words with it (seeds).
For each candidate the longest common run of unmarked words is found by running
Karp-Rabin hashes, all its non-overlapping occurrences are marked on both sides, and
so on with shorter runs down to ``min_match`` words. Tiles may lie in any order,
so a passage whose parts were moved is found. An item is contained in a document when
its tiles cover at least ``min_coverage`` of its words.

The items come to the executors in blocks of at most ``block_bytes`` of text, one
pass over the documents for each block, so nothing that is broadcast grows with the
benchmark; a candidate is dropped early only if even all its seeds together cover too little.

Defined cases: null texts have no words; an item of fewer than ``min_match`` words has
no seed and is contained in no document; each repeated document or item is a
row of its own; no documents or no items give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from halfhourly.llm.common import arrow_texts, decoded, slices, texts_of
from halfhourly.session import staged
from halfhourly.llm.words import rolled, rolling, window_hashes, word_hashes

MIN_MATCH, MIN_COVERAGE, BLOCK_BYTES = 5, 0.8, 8_000_000
_FILTER_BITS = 22


class Tile(NamedTuple):
    item_at: int
    doc_at: int
    words: int


def tiles(item: np.ndarray, doc: np.ndarray, free: np.ndarray, min_match: int) -> list[Tile]:
    """Greedy string tiling of two rows of word hashes; only ``free`` words of ``doc`` are used."""
    sides = [(rolling(item), np.ones(len(item), dtype=bool)), (rolling(doc), free.copy())]

    def windows(side: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        state, unmarked = sides[side]
        sums = np.concatenate([[0], np.cumsum(unmarked)])
        at = np.flatnonzero(sums[size:] - sums[:len(sums) - size] == size)
        return at, rolled(state, size)[at]

    def shared(size: int) -> bool:
        return bool(np.isin(windows(0, size)[1], windows(1, size)[1]).any())

    found, most = [], min(len(item), len(doc))
    while most >= min_match and shared(min_match):
        low, high = min_match, most  # a shared run holds shared runs of every smaller size
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if shared(middle) else (low, middle - 1)
        item_at, item_hash = windows(0, low)
        doc_at, doc_hash = windows(1, low)
        order = np.argsort(doc_hash, kind="stable")
        doc_at, doc_hash = doc_at[order], doc_hash[order]
        begin = np.searchsorted(doc_hash, item_hash, "left")
        end = np.searchsorted(doc_hash, item_hash, "right")
        used: dict[int, int] = {}
        for i in np.flatnonzero(end > begin).tolist():
            p = int(item_at[i])
            if not sides[0][1][p:p + low].all():
                continue
            k = used.get(int(begin[i]), int(begin[i]))
            while k < end[i] and not sides[1][1][doc_at[k]:doc_at[k] + low].all():
                k += 1
            used[int(begin[i])] = k
            if k < end[i]:
                d = int(doc_at[k])
                sides[0][1][p:p + low] = sides[1][1][d:d + low] = False
                found.append(Tile(p, d, low))
        most = low - 1
    return found


class Block:
    """A block of benchmark items with its sorted seeds."""

    def __init__(self, items: list[tuple], min_match: int):
        self.min_match = min_match
        self.ids = [i for i, _ in items]
        self.words, bounds = word_hashes([t or "" for _, t in items])
        self.bounds = bounds
        hashes = window_hashes(self.words, min_match)
        item = np.searchsorted(bounds, np.arange(len(hashes)), "right") - 1
        inside = np.arange(len(hashes)) + min_match <= bounds[item + 1]
        at = np.flatnonzero(inside)
        order = np.argsort(hashes[at], kind="stable")
        self.at, self.item = at[order], item[at][order]
        self.seeds, self.first = np.unique(hashes[at][order], return_index=True)
        self.first = np.append(self.first, len(at))
        self.maybe = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.maybe[self.seeds & np.uint64((1 << _FILTER_BITS) - 1)] = True

    def hits(self, words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where windows of the texts are seeds: place, seed, and number of the text."""
        hashes = window_hashes(words, self.min_match)
        at = np.flatnonzero(self.maybe[hashes & np.uint64((1 << _FILTER_BITS) - 1)])
        seed = np.searchsorted(self.seeds, hashes[at])
        text = np.searchsorted(bounds, at, "right") - 1
        real = (np.append(self.seeds, np.uint64(0))[seed] == hashes[at]) & (seed < len(self.seeds)) \
            & (at + self.min_match <= bounds[text + 1])
        return at[real], seed[real], text[real]

    def places(self, seeds: np.ndarray) -> np.ndarray:
        """Numbers of all places of the given seeds in the items."""
        sizes = self.first[seeds + 1] - self.first[seeds]
        return np.repeat(self.first[seeds] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def _matches(block: Block, words: np.ndarray, hit_at: np.ndarray, hit_seed: np.ndarray,
             min_match: int, min_coverage: float) -> Iterator[tuple[int, list[Tile]]]:
    """Items contained in one document, given where its windows are seeds."""
    place = block.places(np.unique(hit_seed))
    item, at = block.item[place], block.at[place]
    order = np.lexsort((at, item))
    item, at = item[order], at[order]
    gap = np.full(len(at), min_match)
    same = item[1:] == item[:-1]
    gap[:-1][same] = np.minimum(min_match, (at[1:] - at[:-1])[same])
    starts = np.flatnonzero(np.append(True, ~same))
    covered = np.add.reduceat(gap, starts)
    sizes = block.bounds[item[starts] + 1] - block.bounds[item[starts]]
    ends = np.append(starts[1:], len(item))
    for k in np.flatnonzero(covered >= min_coverage * sizes).tolist():
        own = np.isin(hit_seed, np.searchsorted(block.first, place[order][starts[k]:ends[k]], "right") - 1)
        near = (hit_at[own][:, None] + np.arange(min_match)).ravel()
        near = np.unique(np.concatenate([near, near + 1]))
        near = near[near < len(words)]  # the words of seeds, with one more where a run of them ends
        free = np.zeros(len(words), dtype=bool)
        free[(hit_at[own][:, None] + np.arange(min_match)).ravel()] = True
        i = int(item[starts[k]])
        found = tiles(block.words[block.bounds[i]:block.bounds[i + 1]], words[near], free[near], min_match)
        if sum(t.words for t in found) >= min_coverage * int(sizes[k]):
            yield i, [t._replace(doc_at=int(near[t.doc_at])) for t in found]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple]]:
    held, size = [], 0
    for item, text in benchmark.select(f"`{id_col}`", F.col(f"`{text_col}`").cast("string")).toLocalIterator():
        more = len((text or "").encode())
        if held and size + more > block_bytes:
            yield held
            held, size = [], 0
        held.append((item, text))
        size += more
    yield held


def _found(block: Block, texts: list[str], min_coverage: float) -> Iterator[tuple[int, int, list[Tile]]]:
    """(number of the text, number of the item, its tiles) for each item contained in a text."""
    words, bounds = word_hashes(texts)
    at, seed, text = block.hits(words, bounds)
    firsts = np.flatnonzero(np.diff(text, prepend=-1))
    for a, b in zip(firsts.tolist(), [*firsts[1:].tolist(), len(text)]):
        d = int(text[a])
        for item, found in _matches(block, words[bounds[d]:bounds[d + 1]], at[a:b] - bounds[d], seed[a:b],
                                    block.min_match, min_coverage):
            yield d, item, found


def _each_block(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int,
                over) -> Iterator[DataFrame]:
    """What ``over`` makes of each broadcast block of items.

    One block is left to the caller's own job. Of several each is worked out and written before the next is
    read, and then let go, so the driver and the executors hold one block, however long the benchmark.
    """
    blocks = _blocks(benchmark, id_col, text_col, block_bytes)
    items, following = next(blocks), next(blocks, None)
    context = docs.sparkSession.sparkContext
    if following is None:
        yield over(context.broadcast(items))
        return
    while items is not None:
        shared = context.broadcast(items)
        made = staged(over(shared), "benchmark-block")
        shared.destroy()
        yield made
        items, following = following, next(blocks, None)


_RESULT = ["item", "item_words", "covered_words", "n_tiles", "longest_tile", "coverage"]


def contained_items(docs: DataFrame, benchmark: DataFrame, keep: list[str], text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text",
                    min_match: int = MIN_MATCH, min_coverage: float = MIN_COVERAGE,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each document and item contained in it: the ``keep`` columns, the item, its
    ``item_words``, ``covered_words``, ``n_tiles``, ``longest_tile`` and ``coverage``."""
    read, n = arrow_texts(docs, text_col, keep), len(keep)
    item_type = benchmark.schema[item_col].dataType
    item_kind = to_arrow_type(item_type)

    def over(shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = Block(shared.value, min_match)
            for batch in (part for whole in batches for part in slices(whole, n)):
                rows, out = [], []
                for row, i, found in _found(block, [decoded(t) for t in texts_of(batch, n)], min_coverage):
                    size = int(block.bounds[i + 1] - block.bounds[i])
                    covered = sum(t.words for t in found)
                    rows.append(row)
                    out.append((block.ids[i], size, covered, len(found), max(t.words for t in found),
                                covered / size))
                kept = [c.take(pa.array(rows, pa.int64())) for c in batch.columns[:n]]
                made = [pa.array([r[c] for r in out], kind) for c, kind in enumerate(
                    (item_kind, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=[*batch.schema.names[:n], *_RESULT])

        kinds = [f"{f.name} {f.dataType.simpleString()}" for f in read.schema.fields[:n]]
        return read.mapInArrow(run, ", ".join([
            *kinds, f"item {item_type.simpleString()}", "item_words bigint", "covered_words bigint",
            "n_tiles bigint", "longest_tile bigint", "coverage double"]))

    found = reduce(DataFrame.unionAll, _each_block(docs, benchmark, item_col, item_text_col, block_bytes, over))
    return found.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
                        F.col("item").alias(item_col), *_RESULT[1:])


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text",
                   min_match: int = MIN_MATCH, min_coverage: float = MIN_COVERAGE,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that contain no item, same columns; the blocks of items filter one after another."""
    left = [docs]

    def over(shared) -> DataFrame:
        clean = _free_of(shared, min_match, min_coverage)
        return left[0].where(clean(F.make_valid_utf8(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))))

    for left[0] in _each_block(docs, benchmark, item_col, item_text_col, block_bytes, over):
        pass
    return left[0]


def _free_of(shared, min_match: int, min_coverage: float):
    """A filter function: whether a text contains none of the shared items."""

    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        block = Block(shared.value, min_match)
        for texts in batches:
            values = texts.tolist()
            kept = np.ones(len(values), dtype=bool)
            sizes, start = np.cumsum([0] + [len(v) for v in values]), 0
            while start < len(values):  # about as many characters at once as slices() takes
                end = max(start + 1, int(np.searchsorted(sizes, sizes[start] + 2_000_000, "right")) - 1)
                for row, _, _ in _found(block, values[start:end], min_coverage):
                    kept[start + row] = False
                start = end
            yield pd.Series(kept)

    return F.pandas_udf(clean, "boolean")
