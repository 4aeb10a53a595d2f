"""Toxicity by a lexicon trie that Levenshtein automata run through, with context windows.

Fitting takes at most ``max_rows`` labelled rows, those with the smallest hashes of their
ids. Copies and near copies among them count once: texts that share their smallest five-word shingle and
have a similarity of 0.8 or more. A word joins the lexicon when its log-odds between toxic and other texts
stand ``min_z`` standard errors above zero, are at least ``MIN_ODDS``, and ``MIN_TEXTS`` toxic texts have
it, or of many toxic texts a share of ``MIN_SHARE``, but no more than ``ROOT_TEXTS`` times the root of their number; at
most ``max_terms`` do. So the share that a term needs falls as labels grow.

A word of a text is run as a Levenshtein automaton, a set of states for each number of
edits held as bits, along the branches of the lexicon's trie; branches where no state
is left are cut. Words of 5 letters and more may miss a term by one edit, of 8 and more by
two, as far as the term itself is that long. A word that the other labelled texts use is no misspelling.

Each hit weighs what its term weighs, less for edits, and is shared between abuse and
quotation by its context: quote marks around it on its line and reporting words in the
window speak for quotation, words that address someone for abuse. A logistic curve over the
three sums (exact, misspelled, quoted) gives the score; its coefficients start from prior
values, so that misspellings count even where the labelled rows have none.

All texts are scored whole; nothing but the model, bounded by ``max_terms`` and ``max_rows``, is sent out.

Defined cases: a null or empty text has no hits and gets the score of a text without
hits; labels without id or value are left out, of repeated labels the largest counts;
without labels of both kinds the score is the share of toxic ones, half a row added to each;
a null id is not held out; repeated rows are scored each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import exp, log1p
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from halfhourly.llm.common import arrow_texts, decoded, texts_of
from halfhourly.session import staged

MAX_ROWS, MAX_TERMS, MIN_Z, MIN_ODDS, MIN_TEXTS, MIN_SHARE, ROOT_TEXTS = 20_000, 2_000, 3.3, 3.0, 4, 0.01, 0.4
SIMILAR, SKETCH = 0.8, 128
FOLDS, HELD_OUT = 5, 0
SPAN = 8
_CACHED = 800_000

_WORD = re.compile(r"\w+(?:[*@$!'’-]+\w+)*")
_QUOTES = re.compile(r"[\"“”„«»]")
#: Fixed word lists in the languages of the corpus.
REPORTING = frozenset("said says called calls wrote writes quoted quote word term slur sagte nannte schrieb wort "
                      "begriff dit appelé mot terme écrit dijo llamó palabra término escribió".split())
ADDRESSING = frozenset("you your you're yourself u du dich dir dein ihr euch tu toi te ton vous votre tú usted "
                       "eres ustedes vosotros".split())


class Trie:
    """Terms by their letters: each node has its branches and the term that ends there."""

    def __init__(self, terms):
        self.branches: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        for term in terms:
            node = 0
            for c in term:
                if c not in self.branches[node]:
                    self.branches[node][c] = len(self.ends)
                    self.branches.append({})
                    self.ends.append(None)
                node = self.branches[node][c]
            self.ends[node] = term

    def nearest(self, word: str, edits: int, allowed=None) -> tuple[int, str] | None:
        """(edits, term) of the closest term within ``edits`` and, with ``allowed``, those that the length of the term
        itself allows; of equally close ones the first in order."""
        after = {}
        for i, c in enumerate(word):
            after[c] = after.get(c, 0) | 1 << i
        every, last = (1 << len(word) + 1) - 1, 1 << len(word)
        best: tuple[int, str] | None = None
        # bit i of states[d]: i letters of the word are matched with d edits
        stack = [(0, tuple((1 << d + 1) - 1 & every for d in range(edits + 1)))]
        while stack:
            node, states = stack.pop()
            if self.ends[node] is not None:
                for d, held in enumerate(states[:allowed(len(self.ends[node])) + 1] if allowed else states):
                    if held & last:
                        best = min(best, (d, self.ends[node])) if best else (d, self.ends[node])
                        break
            for c, child in self.branches[node].items():
                match, new, below = after.get(c, 0), [], 0
                for d, held in enumerate(states):
                    moved = (held & match) << 1
                    if d:
                        moved |= states[d - 1] | states[d - 1] << 1 | below << 1
                    below = moved & every
                    new.append(below)
                if below:  # what few edits reach, more do
                    stack.append((child, tuple(new)))
        return best


def allowed_edits(letters: int) -> int:
    return 0 if letters < 5 else 1 if letters < 8 else 2


class Model(NamedTuple):
    weights: dict[str, float]
    ordinary: frozenset[str]
    coefficients: tuple[float, ...]


class Scorer:
    """Finds and weighs hits; remembers which words are near which terms."""

    def __init__(self, weights: dict[str, float], ordinary: frozenset[str] = frozenset()):
        self.weights, self.ordinary = weights, ordinary
        self.trie = Trie(sorted(weights))
        self.shortest = min(map(len, weights), default=0)
        self.clean: set[str] = set()
        self.hits: dict[str, tuple[int, str]] = {}

    def near(self, word: str) -> tuple[int, str] | None:
        edits = allowed_edits(len(word))
        if not self.weights or len(word) < self.shortest - edits:
            return None
        if word in self.weights:
            return 0, word
        return self.trie.nearest(word, edits, allowed_edits) if edits else None

    def sums(self, text: str) -> tuple[float, float, float]:
        """Weights of exact, misspelled and quoted hits, each as the logarithm of one and the sum."""
        lowered = text.lower()
        words = set(_WORD.findall(lowered))
        for word in words - self.clean:
            if word in self.hits:
                continue
            found = self.near(word)
            if found and (found[0] == 0 or word not in self.ordinary):
                self.hits[word] = found
            else:
                self.clean.add(word)
        if len(self.clean) > _CACHED:
            self.clean.clear()
        if words.isdisjoint(self.hits):
            return 0.0, 0.0, 0.0
        exact = fuzzy = quoted = 0.0
        for line in lowered.split("\n"):
            spots = list(_WORD.finditer(line))
            tokens = [m.group() for m in spots]
            marks = None
            for i, word in enumerate(tokens):
                if word not in self.hits:
                    continue
                if marks is None:
                    marks = np.array([m.start() for m in _QUOTES.finditer(line)])
                before = int(np.searchsorted(marks, spots[i].start()))
                around = tokens[max(0, i - SPAN):i] + tokens[i + 1:i + 1 + SPAN]
                context = (4.0 + sum(w in ADDRESSING for w in around) - 2.0 * sum(w in REPORTING for w in around)
                           - 4.0 * (before % 2 == 1 and before < len(marks)))
                abuse = 1 / (1 + exp(-context))
                edits, term = self.hits[word]
                weight = self.weights[term]
                if edits:
                    fuzzy += weight * abuse * 0.8 ** edits
                else:
                    exact += weight * abuse
                quoted += weight * (1 - abuse) * 0.8 ** edits
        return log1p(exact), log1p(fuzzy), log1p(quoted)


_SCORERS: dict[int, Scorer] = {}


def _scorer(model: Model) -> Scorer:
    """One scorer for a model in each Python worker, so that what it knows of words is kept between tasks."""
    key = hash((tuple(sorted(model.weights.items())), model.ordinary))
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(model.weights, model.ordinary)
    return _SCORERS[key]


def held_out(id_col: str, folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % folds == fold, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
             max_rows: int = MAX_ROWS) -> DataFrame:
    """(label, text) of at most ``max_rows`` labelled ids that are not held out."""
    known = (labels.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull())
             .where(~held_out(id_col))
             .groupBy(F.col(f"`{id_col}`").alias("id")).agg(F.max(f"`{label_col}`").cast("int").alias("label")))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(max_rows)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "id").select("label", F.coalesce("text", F.lit("")).alias("text"))


def _sketch(words: list[str]) -> list[int]:
    """The ``SKETCH`` smallest hashes of the different runs of five words; of a shorter text that of the whole."""
    return sorted({xxhash.xxh64_intdigest(" ".join(words[i:i + 5])) >> 1 for i in range(max(1, len(words) - 4))})[:SKETCH]


def _near_copies(rows: DataFrame) -> DataFrame:
    """The rows that are near copies of an earlier one of their label with the same smallest shingle.

    Similarity is told by the smallest shingles of both: exactly where they have no more than ``SKETCH``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = [_sketch(_WORD.findall(decoded(t).lower())) for t in texts_of(batch, 2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([s[0] for s in sketches], pa.int64()),
                 pa.array(sketches, pa.list_(pa.int64()))], names=["row", "label", "key", "sketch"])

    made = staged(rows.select("row", "label", "text").mapInArrow(
        run, "row bigint, label int, key bigint, sketch array<bigint>"), "sketches")
    firsts = (made.groupBy("label", "key").agg(F.min(F.struct("row", "sketch")).alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1"))
    both = made.join(firsts, ["label", "key"]).where("row <> first.row")
    union = F.slice(F.array_sort(F.array_union("sketch", "first.sketch")), 1, SKETCH)
    shared = F.size(F.array_intersect(union, F.array_intersect("sketch", "first.sketch")))
    return both.where(shared >= SIMILAR * F.size(union)).select("row")


def _different_words(rows: DataFrame) -> DataFrame:
    """(label, words) of each text, its different words; copies and near copies count once."""
    if "row" not in rows.columns:
        rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [sorted(set(_WORD.findall(decoded(t).lower()))) for t in texts_of(batch, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(split, pa.list_(pa.string()))],
                                             names=["label", "words"])

    kept = rows.join(_near_copies(rows), "row", "left_anti")
    return kept.select("label", "text").mapInArrow(run, "label int, words array<string>")


def _terms(words: DataFrame, max_terms: int, min_z: float) -> tuple[dict[str, float], DataFrame]:
    """Weights of the lexicon's terms, and the words that texts of label 0 use."""
    totals = {r.label: r.n for r in words.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    counts = (words.select("label", F.explode("words").alias("word")).groupBy("word")
              .agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (bad - F.col("a") + 0.5)) - F.log(b / (good - F.col("b") + 0.5))
    scored = counts.where(F.col("a") >= max(MIN_TEXTS, min(MIN_SHARE * bad, ROOT_TEXTS * bad ** 0.5))).select("word", odds.alias("odds"), (odds / F.sqrt(1 / a + 1 / b)).alias("z"))
    top = scored.where((F.col("z") >= min_z) & (F.col("odds") >= MIN_ODDS) & (F.length("word") > 2)).orderBy(F.desc("z"), "word").limit(max_terms)
    return {r.word: r.odds for r in top.collect()}, counts.where("b > 0").select("word")


def _near_terms(words: DataFrame, weights: dict[str, float]) -> frozenset[str]:
    """Those of the ordinary words that would pass for misspelled terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(weights)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(
                [w for w in batch.column(0).to_pylist() if (scorer.near(w) or (0,))[0]], pa.string())], names=["word"])

    return frozenset(r.word for r in words.mapInArrow(run, "word string").collect())


#: Prior means of the coefficients: none, exact, misspelled, quoted; and how firmly they are held.
_PRIOR, _HOLD = np.array([-4.0, 2.5, 2.0, 0.3]), np.array([0.01, 0.1, 1.0, 10.0])


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Coefficients by Newton steps, drawn towards the prior."""
    x = np.column_stack([np.ones(len(x)), x])

    def loss(w: np.ndarray) -> float:
        return float(np.logaddexp(0, x @ w).sum() - y @ (x @ w) + (_HOLD * (w - _PRIOR) ** 2).sum() / 2)

    w = _PRIOR.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - _HOLD * (w - _PRIOR)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(_HOLD), slope)
        size = 1.0
        while loss(w + size * step) > loss(w) and size > 1e-6:
            size /= 2
        w = w + size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_rows: int = MAX_ROWS, max_terms: int = MAX_TERMS, min_z: float = MIN_Z) -> Model:
    rows = staged(labelled(docs, labels, id_col, text_col, label_col, max_rows)
                  .withColumn("row", F.monotonically_increasing_id()), "labelled")
    weights, ordinary = _terms(staged(_different_words(rows), "words"), max_terms, min_z)
    model = Model(weights, _near_terms(ordinary, weights) if weights else frozenset(), ())
    found = _sums(rows, model, ["label"]).collect()
    y = np.array([r.label for r in found], dtype=float)
    if not 0 < y.sum() < len(y):
        share = (y.sum() + 0.5) / (len(y) + 1)
        return model._replace(weights={}, coefficients=(float(np.log(share / (1 - share))), 0.0, 0.0, 0.0))
    return model._replace(coefficients=_logistic(np.array([r.sums for r in found]), y))


def _sums(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    read, n = arrow_texts(docs, text_col, keep), len(keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared.value)
        for batch in batches:
            sums = [list(scorer.sums(decoded(t))) for t in texts_of(batch, n)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(sums, pa.list_(pa.float64()))],
                                             names=[*batch.schema.names[:n], "sums"])

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in read.schema.fields[:n]]
    made = read.mapInArrow(run, ", ".join([*kinds, "sums array<double>"]))
    return made.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "sums")


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``held_out``, ``score`` from 0 to 1 and ``predicted``."""
    c = model.coefficients
    total = F.lit(c[0]) + sum((F.col("sums")[i] * c[i + 1] for i in range(3)), F.lit(0.0))
    rows = _sums(docs, model, [id_col], text_col).withColumn("score", 1 / (1 + F.exp(-total)))
    return rows.select(F.col(f"`{id_col}`"), held_out(id_col).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))
