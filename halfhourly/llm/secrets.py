"""Secret scan: fixed patterns, and a randomness test battery with length-aware false-discovery control.

Fixed patterns give the base spans: assignments of passwords and tokens, access keys,
long runs of hex. They always stay.

The battery looks at every run of at least ``MIN_LENGTH`` characters of ``[A-Za-z0-9+/_=-]``.
The encoding of a run is the smallest of hex, base32, base36, base62 and base64 (both
alphabets) that holds its characters. A run with separators (``= / _ -``) may hold a secret glued
to its name or path, so its longest stretches of either base64 alphabet, padding last, and the
stretches between separators are tested too, and all of them count in the total of the
false-discovery control. Of findings that overlap the longest is reported, but without names
and path parts of plain words around a finding. Under "drawn at random from that alphabet" three tests
are made: chi-squared over classes of the alphabet and over eight equal ranges of its symbols,
a runs test about the alphabet's middle, and lag-one serial correlation. Fisher's method
combines them to a score that is small for random runs. A readability test stands beside them: the
mean logarithm of how much more frequent the run's pairs of neighbouring letters are in the corpus than by chance,
held against what letters drawn at random give. A name or a path of words fails it by far.

What would ordinary text score? Windows of the corpus's own letters and digits, of the
lengths of the strata, go through the same tests: each stratum has windows side by side over
all letters and digits of every text that reaches its length, the last one at the text's end. In each stratum of
length and encoding the share of such windows that look as random is the p-value of a run. Such
windows hold no separators, so for the alphabets with separators the runs that read as words, the corpus's own names and
paths, are ordinary windows, too. By these p-values
Benjamini-Hochberg over all other runs of the corpus, ``FALSE_SHARE`` at most, says which
are findings. A short run is thus held against short windows, which often pass the
tests by chance, and a long one against long windows, which never do. A finding must
also pass every test itself at ``REJECT``, which a repeated or counted-up pattern does not.

Only counts per stratum and score (some thousands of rows) and of pairs of letters (676) are gathered; they are
small whatever the size of the corpus.

Defined cases: a null text is empty; bytes that are no UTF-8 count as the replacement character; repeated rows are scanned each; null ids are
passed on; no rows give no rows. Offsets are code points, ends are exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from math import erfc
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from halfhourly.llm.common import arrow_texts, decoded, texts_of

#: Kinds of spans; the order settles ties of their starts.
KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")

MIN_LENGTH, FALSE_SHARE, REJECT = 20, 0.01, 1e-3
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_LENGTH)

#: Lengths of the windows of ordinary text; a run belongs to the longest that it reaches.
STRATA = (20, 24, 32, 40, 64)
_STRIDE = sum(STRATA)
#: Scores are counted in steps of half a unit, 0 to 100.
_SCORE_STEP, _SCORES = 0.5, 200
_WINDOWS_AT_ONCE = 4096

_DIGIT, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Alphabets with their classes, smallest first.
ENCODINGS = {"hex": (_DIGIT, "abcdef"), "HEX": (_DIGIT, "ABCDEF"), "base32": (_UPPER, "234567"),
             "base36": (_DIGIT, _LOWER), "BASE36": (_DIGIT, _UPPER), "base62": (_DIGIT, _UPPER, _LOWER),
             "base64": (_UPPER, _LOWER, _DIGIT, "+/"), "base64url": (_UPPER, _LOWER, _DIGIT, "-_")}
_NAMES = list(ENCODINGS)


def _tables() -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """Per encoding: place of each byte in the alphabet, its class, shares of classes; and the bits
    of the encodings that hold a byte."""
    place = np.zeros((len(_NAMES), 256))
    kind = np.zeros((len(_NAMES), 256), dtype=np.int64)
    shares, holds = [], np.zeros(256, dtype=np.int64)
    for e, classes in enumerate(ENCODINGS.values()):
        size = sum(map(len, classes))
        at = 0
        for k, symbols in enumerate(classes):
            for s in symbols:
                place[e, ord(s)] = (at + 0.5) / size
                kind[e, ord(s)] = k
                holds[ord(s)] |= 1 << e
                at += 1
        shares.append(np.array([len(c) / size for c in classes]))
    holds[ord("=")] = 0b11000000  # padding of the two forms of base64
    return place, kind, shares, holds


_PLACE, _KIND, _SHARES, _HOLDS = _tables()


def _tail_of_chi2(x: np.ndarray, free: int) -> np.ndarray:
    """Upper tail of chi-squared by the cube-root approximation."""
    z = (np.cbrt(x / free) - (1 - 2 / (9 * free))) / np.sqrt(2 / (9 * free))
    return _tail(z)


_erfc = np.vectorize(erfc, otypes=[float])


def _tail(z: np.ndarray) -> np.ndarray:
    return np.maximum(0.5 * _erfc(z / np.sqrt(2)), 1e-30)


def encodings(codes: np.ndarray) -> np.ndarray:
    """The smallest encoding of each row of equally long byte strings; -1 for none."""
    common = np.bitwise_and.reduce(_HOLDS[codes], axis=1)
    lowest = np.where(common > 0, np.log2(np.maximum(common & -common, 1)), -1)
    return lowest.astype(np.int64)


def battery(codes: np.ndarray, encoding: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Score (small: random) and smallest p-value of equally long byte strings of known encodings."""
    m, n = codes.shape
    place = _PLACE[encoding[:, None], codes]
    log_p, least = np.zeros(m), np.ones(m)

    def note(p: np.ndarray) -> None:
        nonlocal log_p, least
        log_p += np.log(p)
        least = np.minimum(least, p)

    chi = np.zeros(m)
    for e in np.unique(encoding).tolist():
        own = encoding == e
        kinds = _KIND[e][codes[own]]
        x = sum(((kinds == k).sum(axis=1) - n * s) ** 2 / (n * s) for k, s in enumerate(_SHARES[e]))
        chi[own] = _tail_of_chi2(x, len(_SHARES[e]) - 1)
    note(chi)
    eighths = np.minimum((place * 8).astype(np.int64), 7)
    counts = np.stack([(eighths == k).sum(axis=1) for k in range(8)], axis=1)
    note(_tail_of_chi2(((counts - n / 8) ** 2).sum(axis=1) / (n / 8), 7))
    high = place >= 0.5
    ups = high.sum(axis=1)
    both = 2.0 * ups * (n - ups)
    mean, runs = both / n + 1, 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
    spread = np.sqrt(np.maximum(both * (both - n), 1e-9) / (n * n * (n - 1)))
    z = np.where(both > 0, np.abs(runs - mean) / spread, 9.0)
    note(np.minimum(2 * _tail(z), 1.0))
    centred = place - place.mean(axis=1, keepdims=True)
    power = (centred ** 2).sum(axis=1)
    r = np.where(power > 0, (centred[:, 1:] * centred[:, :-1]).sum(axis=1) / np.maximum(power, 1e-12), 1.0)
    note(np.minimum(2 * _tail(np.abs(r + 1 / n) * np.sqrt(n)), 1.0))
    return -2 * log_p / 4, least


class Pairs(NamedTuple):
    """How much more frequent than by chance pairs of neighbouring letters are in a corpus, as logarithms, with the mean
    and variance of that over letters drawn at random and the covariance of two pairs that share a letter."""

    logs: np.ndarray
    mean: float
    variance: float
    covariance: float


def pairs_of(counts: np.ndarray) -> Pairs | None:
    """The table of 26 x 26 counts; none for a corpus without pairs."""
    if not counts.sum():
        return None
    smooth = counts + counts.sum() / 26 ** 2 * 0.05 + 0.5
    logs = np.log(smooth / smooth.sum() * 26 ** 2)
    mean = logs.mean()
    shared = float(((logs.mean(axis=0) - mean) * (logs.mean(axis=1) - mean)).mean())
    return Pairs(logs, float(mean), float(logs.var()), shared)


_LETTER_NO = np.full(256, -1, dtype=np.int64)
for _i, _c in enumerate(_LOWER):
    _LETTER_NO[ord(_c)] = _LETTER_NO[ord(_c.upper())] = _i
#: Encodings whose letters are the whole alphabet.
_FULL = frozenset(_NAMES) - {"hex", "HEX"}


def readable(codes: np.ndarray, pairs: Pairs | None) -> float:
    """How likely letters drawn at random read as well as these; 1 without pairs of letters."""
    numbers = _LETTER_NO[codes]
    both = (numbers[1:] >= 0) & (numbers[:-1] >= 0)
    n = int(both.sum())
    if pairs is None or not n:
        return 1.0
    got = float(pairs.logs[numbers[:-1][both], numbers[1:][both]].sum())
    next_to = int((both[1:] & both[:-1]).sum())
    spread = max(n * pairs.variance + 2 * next_to * pairs.covariance, 1e-9)
    return float(_tail(np.array([(got - n * pairs.mean) / np.sqrt(spread)]))[0])


def letter_pairs(docs: DataFrame, text_col: str = "text") -> Pairs | None:
    """The pairs of neighbouring letters of all texts, without regard to case."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(27 * 27, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                codes = np.frombuffer(b"\n".join(texts_of(batch.slice(at, 256), 0)), dtype=np.uint8)
                numbers = _LETTER_NO[codes]
                counts += np.bincount(numbers[:-1] * 27 + numbers[1:] + 28, minlength=27 * 27)[:27 * 27]
        kept = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int32()), pa.array(counts[kept], pa.int64())], names=["pair", "n"])

    made = arrow_texts(docs, text_col, []).mapInArrow(run, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    table = np.zeros(27 * 27)
    for r in made.collect():
        table[r.pair] = r.n
    return pairs_of(table.reshape(27, 27)[1:, 1:])


class Cells(frozenset):
    """Accepted (stratum, encoding, score step), with the pairs of letters that the readability test goes by."""

    pairs: Pairs | None = None


def _stratum(length: int) -> int:
    return max(k for k, size in enumerate(STRATA) if size <= length)


_SEPARATOR = re.compile(r"[=/_-]")
#: Stretches of a run with separators, by alphabet; the last has what stands between separators.
_STRETCHES = tuple(re.compile(r"[A-Za-z0-9%s]{%d,}={0,2}" % (more, MIN_LENGTH - 2)) for more in ("+/", "_-", "+"))


def _parts(text: str) -> Iterator[tuple[int, int]]:
    """Each run, followed by those of its stretches that differ from it."""
    for m in _RUN.finditer(text):
        yield m.span()
        if _SEPARATOR.search(text, *m.span()):
            stretches = {s.span() for form in _STRETCHES for s in form.finditer(text, *m.span())
                         if s.end() - s.start() >= MIN_LENGTH}
            yield from sorted(stretches - {m.span()})


def _runs(text: str, pairs: Pairs | None = None) -> list[tuple[int, int, int, int, int, float, bool]]:
    """(start, end, stratum, encoding, ...) of each run and stretch, with its score step, smallest p-value of the battery
    and whether it passes as unreadable.

    A run that is longer than its stratum's window is tested whole.
    """
    out = []
    for start, end in _parts(text):
        codes = np.frombuffer(text[start:end].encode(), dtype=np.uint8)[None, :]
        e = encodings(codes)
        if e[0] >= 0:
            score, least = battery(codes, e)
            step = int(min(score[0] / _SCORE_STEP, _SCORES))
            unread = _NAMES[int(e[0])] not in _FULL or readable(codes[0], pairs) >= REJECT
            out.append((start, end, _stratum(end - start), int(e[0]), step, float(least[0]), unread))
    return out


#: Plain words with separators, as names and paths have them, before a finding and, backwards, after it.
_NAME = re.compile(r"(?:(?:[A-Z]?[a-z]+|[A-Z]+)?[=/_-])+")
_NAME_BACK = re.compile(r"(?:(?:[a-z]+[A-Z]?|[A-Z]+)?[=/_-])+")
_NAME_LETTERS = 6


def _chosen(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest of overlapping spans, without those that only add plain words to another.

    Few letters are no name, unless the padding sign ``=`` stands among them.
    """
    spans = sorted(spans)
    left = []
    for start, end in spans:
        inner = text[start:end]
        before = start + (m.end() if (m := _NAME.match(inner)) else 0)
        after = end - (m.end() if (m := _NAME_BACK.match(inner[::-1])) else 0)
        named = False
        for c, d in spans[bisect_left(spans, (start, 0)):bisect_left(spans, (before + 1, 0))]:
            if (c, d) != (start, end) and after <= d <= end:
                name = text[start:c] + text[d:end]
                named |= sum(map(str.isalpha, name)) >= _NAME_LETTERS or "=" in text[start:c]
        if not named:
            left.append((start, end))
    kept: list[tuple[int, int]] = []
    for span in sorted(left, key=lambda s: (s[0] - s[1], s)):
        at = bisect_left(kept, span)
        if (at == 0 or kept[at - 1][1] <= span[0]) and (at == len(kept) or span[1] <= kept[at][0]):
            kept.insert(at, span)
    return kept


_LETTER = np.zeros(256, dtype=bool)
_LETTER[[ord(c) for c in _DIGIT + _UPPER + _LOWER]] = True


def _letters(text: str) -> np.ndarray:
    """The letters and digits of a text without its runs."""
    codes = np.frombuffer(_RUN.sub("", text).encode(), dtype=np.uint8)
    return codes[_LETTER[codes]]


def _ordinary(texts: list[str]) -> np.ndarray:
    """Blocks of ``_STRIDE`` letters and digits of the texts without their runs, one block per row.

    Each text is cut by itself, so the blocks do not depend on how texts are batched.
    """
    parts = [codes[:len(codes) // _STRIDE * _STRIDE] for codes in map(_letters, texts)]
    return np.concatenate(parts).reshape(-1, _STRIDE) if parts else np.zeros((0, _STRIDE), dtype=np.uint8)


def _windows(letters: list[np.ndarray], size: int) -> np.ndarray:
    """Windows of ``size`` side by side over the letters of each text, the last one at its end."""
    parts = [np.zeros(0, dtype=np.uint8)]
    for codes in letters:
        if len(codes) >= size:
            parts.append(codes[:len(codes) // size * size])
            if len(codes) % size:
                parts.append(codes[-size:])
    return np.concatenate(parts).reshape(-1, size)


def _sampled(texts: list[str]) -> list[np.ndarray]:
    """The windows of each stratum that are its own part of every block."""
    blocks, ends = _ordinary(texts), np.cumsum(STRATA)
    return [blocks[:, end - size:end] for size, end in zip(STRATA, ends.tolist())]


def _all_windows(texts: list[str]) -> Iterator[np.ndarray]:
    letters = [_letters(t) for t in texts]
    return (_windows(letters, size) for size in STRATA)


_COUNTS = "ordinary boolean, stratum int, encoding int, step int, passes boolean, n bigint"


def score_counts(docs: DataFrame, text_col: str = "text", whole: bool = False, pairs: Pairs | None = None) -> DataFrame:
    """How many runs, and how many windows of ordinary text, have each stratum, encoding and score.

    With ``whole``, windows cover all letters in every stratum; else each stratum has its part of every block. Runs that
    read as words by ``pairs`` count among the ordinary windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, int] = {}
        for batch in batches:
            texts = [decoded(t) for t in texts_of(batch, 0)]
            for text in texts:
                for _, _, k, e, step, least, unread in _runs(text, pairs):
                    key = (not unread, k, e, step, least >= REJECT or not unread)
                    counts[key] = counts.get(key, 0) + 1
            for a in range(0, len(texts), 256):
                for k, windows in enumerate((_all_windows if whole else _sampled)(texts[a:a + 256])):
                    for at in range(0, len(windows), _WINDOWS_AT_ONCE):
                        codes = windows[at:at + _WINDOWS_AT_ONCE]
                        e = encodings(codes)
                        steps = np.minimum(battery(codes, e)[0] / _SCORE_STEP, _SCORES).astype(np.int64)
                        cells, n = np.unique(e * (_SCORES + 1) + steps, return_counts=True)
                        for cell, c in zip(cells.tolist(), n.tolist()):
                            key = (True, k, *divmod(cell, _SCORES + 1), True)
                            counts[key] = counts.get(key, 0) + c
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("ordinary", "stratum", "encoding", "step", "passes", "n"), (*key, n)))
             for key, n in counts.items()],
            schema=pa.schema([("ordinary", pa.bool_()), ("stratum", pa.int32()), ("encoding", pa.int32()),
                              ("step", pa.int32()), ("passes", pa.bool_()), ("n", pa.int64())]))

    made = arrow_texts(docs, text_col, []).mapInArrow(run, _COUNTS)
    return made.groupBy("ordinary", "stratum", "encoding", "step", "passes").agg(F.sum("n").alias("n"))


def accepted_cells(counts: pd.DataFrame, false_share: float = FALSE_SHARE) -> frozenset[tuple[int, int, int]]:
    """(stratum, encoding, score step) of the findings, by Benjamini-Hochberg over all runs."""
    ordinary, runs = counts[counts.ordinary], counts[~counts.ordinary]
    windows = ordinary.groupby("stratum").n.sum().to_dict()
    cells = []
    for (k, e, step), n in runs.groupby(["stratum", "encoding", "step"]).n.sum().items():
        as_random = ordinary[(ordinary.stratum == k) & (ordinary.encoding == e) & (ordinary.step <= step)].n.sum()
        cells.append(((1 + as_random) / (1 + windows.get(k, 0)), (int(k), int(e), int(step)), n))
    cells.sort()
    total, upto, limit = sum(n for *_, n in cells), 0, -1.0
    for p, _, n in cells:
        upto += n
        if p <= false_share * upto / total:
            limit = p
    return frozenset(cell for p, cell, _ in cells if p <= limit)


def fit(docs: DataFrame, text_col: str = "text", false_share: float = FALSE_SHARE) -> frozenset:
    """The accepted cells of a corpus. What is collected has at most strata x encodings x scores x 4 rows."""
    pairs = letter_pairs(docs, text_col)
    cells = Cells(accepted_cells(score_counts(docs, text_col, whole=True, pairs=pairs).toPandas(), false_share))
    cells.pairs = pairs
    return cells


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    spans += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m.group()) >= 16]
    return spans + [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]


def _in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def all_spans(text: str, cells: frozenset) -> list[tuple[str, int, int]]:
    """Base spans and findings of the battery, in order."""
    found = [(a, b) for a, b, k, e, step, least, unread in _runs(text, getattr(cells, "pairs", None))
             if unread and least >= REJECT and (k, e, step) in cells]
    return _in_order(base_spans(text) + [("random", a, b) for a, b in _chosen(text, found)])


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def found_secrets(docs: DataFrame, keep: list[str], cells: frozenset, text_col: str = "text") -> DataFrame:
    """One row per document: the ``keep`` columns, numbers of base spans by kind, ``n_random``,
    ``base_spans`` and ``spans`` as kind:start:end, comma-joined."""
    read, n = arrow_texts(docs, text_col, keep), len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in KINDS]
            base, every = [], []
            for text in texts_of(batch, n):
                spans = all_spans(decoded(text), cells)
                for c, kind in zip(counts, KINDS):
                    c.append(sum(s[0] == kind for s in spans))
                base.append(_joined([s for s in spans if s[0] != "random"]))
                every.append(_joined(spans))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], *[pa.array(c, pa.int64()) for c in counts],
                 pa.array(base, pa.string()), pa.array(every, pa.string())],
                names=[*batch.schema.names[:n], *_RESULT])

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in read.schema.fields[:n]]
    schema = ", ".join([*kinds, *[f"n_{k} bigint" for k in KINDS], "base_spans string", "spans string"])
    made = read.mapInArrow(run, schema)
    return made.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *_RESULT)


_RESULT = [*[f"n_{k}" for k in KINDS], "base_spans", "spans"]


def masked(text: str, cells: frozenset, mark: str) -> str:
    """The text with every stretch that spans cover replaced by ``mark``."""
    out, done = [], 0
    merged: list[list[int]] = []
    for _, a, b in all_spans(text, cells):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    for a, b in merged:
        out += [text[done:a], mark]
        done = b
    return "".join(out) + text[done:]


def without_secrets(docs: DataFrame, cells: frozenset, text_col: str = "text",
                    length_col: str | None = "n_chars", mark: str = "[secret]") -> DataFrame:
    """The documents with their secrets masked, same columns; null texts stay null.

    ``length_col``, if ``docs`` has it, follows the new text where that changed.
    """

    def hide(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: t if t is None else masked(t, cells, mark))

    new = F.pandas_udf(hide, "string")(F.make_valid_utf8(F.col(f"`{text_col}`").cast("string")))
    if length_col not in docs.columns:
        return docs.withColumn(text_col, new)
    hidden = docs.withColumn(text_col, new)
    changed = F.length(F.col(f"`{text_col}`")).cast(docs.schema[length_col].dataType)
    return hidden.withColumn(length_col, F.when(F.col(f"`{text_col}`").isNull(), F.col(f"`{length_col}`")).otherwise(changed))
