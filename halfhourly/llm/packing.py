"""Sum-of-squares online packing of tokenized documents into sequences.

Every task packs the documents of its own partition as they come, so no row is
shuffled and a lost task is simply run again: a sequence's number starts with the
number of the partition. Whole windows of a long document are sequences of their own.
Its rest goes where the sum over all fill levels of (number of open windows at that
level) squared becomes smallest; only the array of those numbers is looked at. Among
equal choices the fullest window is taken, a new window last.

Open windows keep their tokens until they are full or the partition ends. At the end,
or when more than ``max_open`` windows are open, the emptiest are cut up to fill the
fullest. What is left then is one window at most, cut at powers of two, which need no
padding.

Defined cases: a null or empty text is the end token alone; repeated rows are packed
each; null ids are passed on; no rows give no sequences.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from halfhourly.llm.common import arrow_texts, decoded, texts_of

WINDOW, END_ID, MAX_OPEN, CACHED_WORDS = 2048, 1, 4096, 800_000
_ID_BYTES, _CHARS_AT_ONCE = 4, 500_000

_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Texts of these characters alone are split by ``_PIECES``, which agrees there with the
#: tokenizer's own pattern; others are left to the tokenizer as a whole.
_OTHER = re.compile(r"[^\t\n\r -~¡§«°»¿À-ÖØ-öø-ɏ–—‘-„…€]")
_PIECES = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+")


class _Table(dict):
    """How a byte-level vocabulary writes each character."""

    def __missing__(self, code: int) -> str:
        from tokenizers.pre_tokenizers import ByteLevel
        written = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(code))
        self[code] = "".join(part for part, _ in written)
        return self[code]


class Encoder:
    """Ids of texts as little-endian 32-bit numbers, by a byte-level BPE of ``tokenizers``.

    Merges never cross the pieces that the tokenizer first splits a text into, so the
    ids of a piece are worked out once and kept, for at most ``CACHED_WORDS`` pieces.
    A text that holds an added token is left to the tokenizer as a whole. With ``special``
    a special token in a text is its own id, as the tokenizer's file has it, else plain letters.
    """

    def __init__(self, path: str, special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.table = _Table()

    def _bytes(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _whole(self, text: str) -> bool:
        return _OTHER.search(text) is not None or any(t in text for t in self.added)

    def _learn(self, pieces: list[str]) -> None:
        """Runs the merges over single pieces, which need no further splitting."""
        tokenize, table, known = self.tokenizer.model.tokenize, self.table, self.known
        for piece in pieces:
            ids = [token.id for token in tokenize(piece.translate(table))]
            known[piece] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text; new pieces of texts of about ``_CHARS_AT_ONCE`` are learnt together."""
        at = 0
        while at < len(texts):
            split, size = [], 0
            while at < len(texts) and size < _CHARS_AT_ONCE:
                text = texts[at]
                split.append(text if self._whole(text) else _PIECES.findall(text))
                size += len(text)
                at += 1
            if len(self.known) > CACHED_WORDS:
                self.known.clear()
            new = set().union(*(s for s in split if isinstance(s, list))).difference(self.known)
            if new:
                self._learn(list(new))
            for s in split:
                yield b"".join(map(self.known.__getitem__, s)) if isinstance(s, list) else self._bytes([s])[0]


@lru_cache(maxsize=2)
def encoder(path: str, special: bool = False) -> Encoder:
    return Encoder(path, special)


class Packer:
    """Places pieces (document, start, ids, document's length) into windows; collects finished ones."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.levels = np.zeros(window + 1, dtype=np.int64)
        self.open: list[list[list[tuple]]] = [[] for _ in range(window)]
        self.n_open = 0
        self.finished: list[list[tuple]] = []

    def level_for(self, size: int) -> int:
        """The fill level to place a piece at; 0 opens a window. Changes of the sum, halved, are compared."""
        after, before = self.levels[size:], self.levels[:self.window - size + 1]
        # 2 after + 1 (none if full) - 2 before + 1; a new window has only the first part
        change = 2 * (after - before) + 2
        change[-1] -= 1
        change[before == 0] = np.iinfo(np.int64).max
        change[0] = 2 * after[0] + (size < self.window)
        best = len(change) - 1 - int(np.argmin(change[::-1]))
        return best

    def add(self, doc, ids: bytes) -> None:
        total, step = len(ids) // _ID_BYTES, self.window * _ID_BYTES
        whole = total // self.window
        for k in range(whole):
            self.finished.append([(doc, k * self.window, ids[k * step:(k + 1) * step], total)])
        rest = total - whole * self.window
        if rest:
            self._place((doc, whole * self.window, ids[whole * step:], total), rest)
        if self.n_open > self.max_open:
            self._merge(self.max_open // 2)

    def _place(self, piece: tuple, size: int) -> None:
        level = self.level_for(size)
        if level:
            pieces = self.open[level].pop()
            self.levels[level] -= 1
            self.n_open -= 1
        else:
            pieces = []
        pieces.append(piece)
        self._put(pieces, level + size)

    def _put(self, pieces: list[tuple], fill: int) -> None:
        if fill == self.window:
            self.finished.append(pieces)
        elif fill:
            self.open[fill].append(pieces)
            self.levels[fill] += 1
            self.n_open += 1

    def _merge(self, most: int) -> None:
        """Cuts the emptiest windows up to fill the fullest, until at most ``most`` are open."""
        windows = [(fill, pieces) for fill in range(self.window - 1, 0, -1) for pieces in self.open[fill]]
        self.open = [[] for _ in range(self.window)]
        self.levels[:] = 0
        self.n_open = 0
        first = 0
        while len(windows) - first > most:
            fill, pieces = windows[first]
            low, parts = windows.pop()
            taken, parts = _cut(parts, min(self.window - fill, low))
            pieces.extend(taken)
            moved = min(self.window - fill, low)
            windows[first] = (fill + moved, pieces)
            if fill + moved == self.window:
                self.finished.append(pieces)
                first += 1
            if low > moved:
                windows.append((low - moved, parts))
        for fill, pieces in windows[first:]:
            self._put(pieces, fill)

    def finish(self) -> None:
        self._merge(1)
        for fill in range(1, self.window):
            for pieces in self.open[fill]:
                for bit in reversed(range(fill.bit_length())):
                    if fill >> bit & 1:
                        taken, pieces = _cut(pieces, 1 << bit)
                        self.finished.append(taken)
        self.levels[:] = 0
        self.open = [[] for _ in range(self.window)]
        self.n_open = 0

    def take(self) -> list[list[tuple]]:
        out, self.finished = self.finished, []
        return out


def _cut(pieces: list[tuple], size: int) -> tuple[list[tuple], list[tuple]]:
    """The first ``size`` ids of a window's pieces, and the rest."""
    taken = []
    for k, (doc, start, ids, total) in enumerate(pieces):
        own = len(ids) // _ID_BYTES
        if size < own:
            if size:
                taken.append((doc, start, ids[:size * _ID_BYTES], total))
            return taken, [(doc, start + size, ids[size * _ID_BYTES:], total), *pieces[k + 1:]]
        taken.append((doc, start, ids, total))
        size -= own
    return taken, []


_RESULT = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def packed(docs: DataFrame, tokenizer_path: str, keep: list[str], text_col: str = "text",
           window: int = WINDOW, end_id: int = END_ID, max_open: int = MAX_OPEN) -> DataFrame:
    """One row per piece: the ``keep`` columns of its document, ``start`` and ``length`` in the
    document's ids (with ``end_id`` last), ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``."""
    read, n = arrow_texts(docs, text_col, keep), len(keep)
    end = np.array([end_id], dtype="<u4").tobytes()

    def rows(sequences: list[list[tuple]], first: int, kept_type) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(n + len(_RESULT))]
        for k, pieces in enumerate(sequences):
            offset = 0
            for doc, start, ids, total in pieces:
                size = len(ids) // _ID_BYTES
                for c, v in enumerate((*doc, start, size, zlib.crc32(ids), total, first + k, offset)):
                    columns[c].append(v)
                offset += size
        kinds = [*kept_type, *[pa.int64()] * len(_RESULT)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                          names=[*[f"k{i}" for i in range(n)], *_RESULT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(tokenizer_path, special=True).encode, Packer(window, max_open)
        number, kinds = TaskContext.get().partitionId() << 33, None
        for batch in batches:
            kinds = [c.type for c in batch.columns[:n]]
            kept = list(zip(*[c.to_pylist() for c in batch.columns[:n]])) if n else [()] * batch.num_rows
            for doc, ids in zip(kept, encode([decoded(t) for t in texts_of(batch, n)])):
                packer.add(doc, ids + end)
            if done := packer.take():
                yield rows(done, number, kinds)
                number += len(done)
        if kinds is not None:
            packer.finish()
            if done := packer.take():
                yield rows(done, number, kinds)

    schema = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in read.schema.fields[:n]],
                        *[f"`{c}` bigint" for c in _RESULT]])
    made = read.mapInArrow(run, schema)
    return made.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *_RESULT)
