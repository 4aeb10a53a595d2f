"""Language of words in mixed texts by a linear-chain conditional random field.

Each word has features: its first and last one to three letters, its letter pairs and
triples (hashed to slots), and how the lexicon sees it, the learnt counts of texts of each language
that use the word. The field's labels are the languages; transitions between neighbouring words are
learnt with the rest. Forward-backward gives every word its distribution, whatever the
length of the text; the text's language is the one with the largest sum over words, its
score that language's share.

The lexicon counts every training text. The weights are fitted on at most ``max_texts`` texts,
those with the smallest hashes of text and id, ``PIECE`` words of each from its middle on; pieces are strung
together to mixed sequences, so that switches are seen. What a worker knows of a word is kept,
so features are worked out once a word.

Words are runs of letters. Sequences are cut into blocks of ``BLOCK`` words that are run side by side:
each block's transfer matrix, then the messages from block to block, then the words in them.
This is exact, and a text of any length needs memory for its own words and blocks only.

Defined cases: a null text, or one without a letter, gets ``und`` and score 0; rows without
lang teach nothing; without any training row every text is ``und``; a null id is not held out;
repeated rows are predicted each.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from halfhourly.llm.common import arrow_texts, decoded, slices, texts_of
from halfhourly.session import staged

FOLDS, HELD_OUT = 4, 2
MAX_TEXTS, PIECE, STRUNG = 4_000, 24, 8
#: Characters of a piece of a text to fit on.
_STRETCH = 160
MAX_WORDS = 50_000
BLOCK, _BLOCKS_AT_ONCE, _BITS, _CACHED = 32, 4096, 16, 600_000
_WORD = re.compile(r"[^\W\d_]+")


def letters(text: str) -> list[str]:
    """The words of a text, runs of letters alone.

    The pattern takes fractions, circled numbers and the like for letters; few words hold one, and those are cut there.
    """
    words = _WORD.findall(text)
    if words and not "".join(words).isalpha():
        spaced = ("".join(c if c.isalpha() else " " for c in w) for w in words)
        words = [part for w in spaced for part in w.split()]
    return words


def held_out(id_col: str, folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % folds == fold, F.lit(False))


def features(words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashed slots of the words' letter pairs, triples, and first and last four, and how many each word has.

    Words are framed, so the pairs, triples and fours at their ends are affixes of one to three letters.
    """
    codes = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    codes = np.concatenate([codes, np.zeros(2, dtype=np.uint64)])
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    ends = np.cumsum(sizes)
    starts = ends - sizes

    def slots(at: np.ndarray, width: int) -> np.ndarray:
        h = np.full(len(at), width, dtype=np.uint64)
        for k in range(width):
            h = (h ^ codes[at + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return (h >> np.uint64(64 - _BITS)).astype(np.int64)

    def inside(width: int) -> tuple[np.ndarray, np.ndarray]:
        held = sizes - width + 1
        at = np.arange(held.sum()) + np.repeat(starts - np.cumsum(held) + held, held)
        return slots(at, width), held

    fours = np.stack([starts, np.maximum(ends - 4, starts)], axis=1).ravel()
    return [inside(2), inside(3), (slots(fours, 4), np.full(len(words), 2))]


class Model(NamedTuple):
    languages: tuple[str, ...]
    lexicon: dict[str, tuple[float, ...]]
    weights: np.ndarray        # slots x languages
    lexical: float
    transitions: np.ndarray    # languages x languages
    start: np.ndarray


class Tagger:
    """Scores of words for each language, remembered, and forward-backward over many texts."""

    def __init__(self, model: Model):
        self.model = model
        self.place: dict[str, int] = {}
        self.scores = np.zeros((1024, len(model.languages)))

    def _learn(self, words: set[str]) -> None:
        if len(self.place) > _CACHED:
            self.place.clear()
        new = list(words.difference(self.place))
        if not new:
            return
        at = len(self.place)
        if at + len(new) > len(self.scores):
            grown = np.zeros((2 * (at + len(new)), self.scores.shape[1]))
            grown[:at] = self.scores[:at]
            self.scores = grown
        self.scores[at:at + len(new)] = self.word_scores(new)
        self.place.update(zip(new, range(at, at + len(new))))

    def word_scores(self, words: list[str]) -> np.ndarray:
        found = sum(np.add.reduceat(self.model.weights[slots], np.cumsum(sizes) - sizes, axis=0)
                    for slots, sizes in features(words))
        for k, word in enumerate(words):
            if word in self.model.lexicon:
                found[k] += self.model.lexical * np.array(self.model.lexicon[word])
        return found

    def emissions(self, texts: list[list[str]]) -> np.ndarray:
        """Scores of all words of the texts, one after another."""
        self._learn(set().union(*texts))
        return self.scores[np.fromiter(map(self.place.__getitem__, chain.from_iterable(texts)), dtype=np.int64,
                                       count=sum(map(len, texts)))]

    def marginals(self, texts: list[list[str]]) -> np.ndarray:
        sizes = np.array([len(t) for t in texts])
        return forward_backward(self.emissions(texts), sizes, self.model.transitions, self.model.start)


def forward_backward(scores: np.ndarray, sizes: np.ndarray, transitions: np.ndarray, start: np.ndarray,
                     pairs: bool = False) -> np.ndarray | tuple[np.ndarray, np.ndarray]:
    """Each word's distribution over labels; ``scores`` holds the words of all texts, ``sizes`` their numbers.

    With ``pairs`` also the expected number of each transition.
    """
    n, k = scores.shape
    sizes = sizes[sizes > 0]
    if not n:
        return (np.zeros((0, k)), np.zeros((k, k))) if pairs else np.zeros((0, k))
    local = np.exp(scores - scores.max(axis=1, keepdims=True))
    step = np.exp(transitions - transitions.max())
    blocks = -(-sizes // BLOCK)
    first_block = np.cumsum(blocks) - blocks
    last_block = first_block + blocks - 1
    text = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    row, col = first_block[text] + place // BLOCK, place % BLOCK
    total = int(blocks.sum())
    bounds = np.searchsorted(row, np.arange(0, total + _BLOCKS_AT_ONCE, _BLOCKS_AT_ONCE))

    def parts() -> Iterator[tuple[int, int, slice, np.ndarray]]:
        """Runs of blocks, their words, and the matrix of each word; past a text's end the identity."""
        for j, low in enumerate(range(0, total, _BLOCKS_AT_ONCE)):
            high, own = min(low + _BLOCKS_AT_ONCE, total), slice(bounds[j], bounds[j + 1])
            matrices = np.broadcast_to(np.eye(k), (high - low, BLOCK, k, k)).copy()
            matrices[row[own] - low, col[own]] = step[None] * local[own][:, None, :]
            heads = first_block[(first_block >= low) & (first_block < high)] - low
            matrices[heads, 0] = np.eye(k)[None] * matrices[heads, 0][:, :1, :] / step[:1]  # no step into a text
            yield low, high, own, matrices

    whole = np.empty((total, k, k))
    for low, high, _, matrices in parts():
        product = matrices[:, 0]
        for c in range(1, BLOCK):
            product = product @ matrices[:, c]
            product /= product.sum(axis=(1, 2), keepdims=True)
        whole[low:high] = product
    # messages from block to block; texts of many blocks go on while others have ended
    into, back = np.zeros((total, k)), np.zeros((total, k))
    into[first_block] = np.exp(start - start.max())
    back[last_block] = 1.0
    order = np.argsort(-blocks, kind="stable")
    for b in range(1, int(blocks.max())):
        going = order[:np.searchsorted(-blocks[order], -b, "left")]
        at = first_block[going] + b
        message = np.einsum("bi,bij->bj", into[at - 1], whole[at - 1])
        into[at] = message / message.sum(axis=1, keepdims=True)
        at = last_block[going] - b
        message = np.einsum("bij,bj->bi", whole[at + 1], back[at + 1])
        back[at] = message / message.sum(axis=1, keepdims=True)
    ahead, behind = np.empty((n, k)), np.empty((n, k))
    for low, high, own, matrices in parts():
        grid = np.empty((2, high - low, BLOCK, k))
        message = into[low:high]
        for c in range(BLOCK):
            message = np.einsum("bi,bij->bj", message, matrices[:, c])
            message = message / message.sum(axis=1, keepdims=True)
            grid[0, :, c] = message
        message = back[low:high]
        for c in range(BLOCK - 1, -1, -1):
            grid[1, :, c] = message
            message = np.einsum("bij,bj->bi", matrices[:, c], message)
            message = message / message.sum(axis=1, keepdims=True)
        ahead[own], behind[own] = grid[0][row[own] - low, col[own]], grid[1][row[own] - low, col[own]]
    found = ahead * behind
    found /= found.sum(axis=1, keepdims=True)
    if not pairs:
        return found
    later = np.flatnonzero(place)
    both = ahead[later - 1][:, :, None] * step[None] * (local[later] * behind[later])[:, None, :]
    return found, (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)


def _words(text: bytes) -> list[str]:
    return letters(decoded(text).lower())


def _lexicon(train: DataFrame, totals: dict[str, int], max_words: int) -> dict[str, tuple[float, ...]]:
    """Log shares of texts by language of the words that most texts use; every training text is counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # words are summed up in a task before they are dealt out
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch, 1)):
                counts.setdefault(lang, Counter()).update(set(_words(text)))
            if sum(map(len, counts.values())) > _CACHED:
                yield _counted(counts)
                counts = {}
        yield _counted(counts)

    counts = train.select("lang", "text").mapInArrow(run, "lang string, word string, n bigint")
    languages = sorted(totals)
    by_word = counts.groupBy("word").agg(*[F.sum(F.when(F.col("lang") == c, F.col("n")).otherwise(0)).alias(f"n{i}")
                                           for i, c in enumerate(languages)], F.sum("n").alias("n"))
    # the least count that at most max_words words reach, by steps of an eighth of a doubling
    by_word = staged(by_word.where("n > 1"), "words")
    step = F.floor(F.log2("n") * 8)
    steps = by_word.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("step")).collect()
    least, held = 1 << 30, 0
    for r in steps:
        held += r.words
        if held > max_words:
            break
        least = r.step
    top = by_word.where(step >= least).orderBy("word").collect()
    out = {}
    for r in top:
        share = np.array([(r[f"n{i}"] + 0.5) / (totals[c] + 1) for i, c in enumerate(languages)])
        logs = np.log(share)
        out[r.word] = tuple((logs - logs.mean()).tolist())
    return out


def _counted(counts: dict[str, Counter]) -> pa.RecordBatch:
    langs = [lang for lang, words in counts.items() for _ in range(len(words))]
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array(list(chain.from_iterable(counts.values())), pa.string()),
         pa.array([n for words in counts.values() for n in words.values()], pa.int64())], names=["lang", "word", "n"])


def _sequences(pieces: list[tuple[int, list[str]]], seed: int = 1) -> list[tuple[list[str], np.ndarray]]:
    """Pieces strung together in random order: words with their labels."""
    order = np.random.default_rng(seed).permutation(len(pieces)).tolist()
    out = []
    for at in range(0, len(order), STRUNG):
        chosen = [pieces[i] for i in order[at:at + STRUNG]]
        out.append(([w for _, ws in chosen for w in ws], np.concatenate([np.full(len(ws), k) for k, ws in chosen])))
    return out


def _fitted(model: Model, sequences: list[tuple[list[str], np.ndarray]], rounds: int = 60,
            hold: float = 1e-4) -> Model:
    """Weights by gradient steps on the log-likelihood (Adam), all sequences in every step."""
    texts, k = [s for s, _ in sequences], len(model.languages)
    sizes = np.array([len(t) for t in texts])
    labels = np.concatenate([y for _, y in sequences])
    n = len(labels)
    known = {w: i for i, w in enumerate(sorted(set().union(*texts)))}
    words = list(known)
    word = np.fromiter((known[w] for t in texts for w in t), dtype=np.int64, count=n)
    groups = features(words)
    lexical = np.array([model.lexicon.get(w, (0.0,) * k) for w in words])
    starts = np.cumsum(sizes) - sizes
    follows = np.ones(n, dtype=bool)
    follows[starts] = False
    at = np.flatnonzero(follows)
    target = np.eye(k)[labels]
    seen = np.zeros((k, k))
    np.add.at(seen, (labels[at - 1], labels[at]), 1)
    w, lex, t, s = model.weights.copy(), model.lexical, model.transitions.copy(), model.start.copy()
    flow = [(np.zeros_like(v), np.zeros_like(v)) for v in (w, np.zeros(1), t, s)]
    for step in range(1, rounds + 1):
        own = sum(np.add.reduceat(w[slots], np.cumsum(sized) - sized, axis=0) for slots, sized in groups)
        own = own + lex * lexical
        p, steps = forward_backward(own[word], sizes, t, s, pairs=True)
        by_word = np.zeros((len(words), k))
        np.add.at(by_word, word, target - p)
        grad_w = np.zeros_like(w)
        for slots, sized in groups:
            np.add.at(grad_w, slots, np.repeat(by_word, sized, axis=0))
        grads = [grad_w, np.array([(by_word * lexical).sum()]), seen - steps,
                 (target - p)[starts].sum(axis=0)]
        values = [w, np.array([lex]), t, s]
        for v, g, (m1, m2) in zip(values, grads, flow):
            g = g / n - hold * v
            m1 *= 0.9
            m1 += 0.1 * g
            m2 *= 0.99
            m2 += 0.01 * g * g
            v += 0.1 * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-10)
        w, lex, t, s = values[0], float(values[1][0]), values[2], values[3]
    return model._replace(weights=w, lexical=lex, transitions=t, start=s)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_texts: int = MAX_TEXTS, max_words: int = MAX_WORDS) -> Model:
    """The model of the rows that are not held out."""
    train = docs.where(~held_out(id_col) & F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull()) \
        .select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"),
                F.xxhash64(f"`{text_col}`", f"`{id_col}`").alias("h"))
    totals = {r.lang: r.n for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(totals)
    k = len(languages)
    empty = Model(tuple(languages), {}, np.zeros((1 << _BITS, k)), 1.0, np.zeros((k, k)), np.zeros(k))
    if k < 2:
        return empty
    size = F.length("text")
    # a short text whole, of a longer one its beginning, middle and end
    places = F.when(size <= 3 * _STRETCH, F.array(F.lit(1))).otherwise(
        F.array(F.lit(1), F.floor((size - _STRETCH) / 2).cast("int") + 1, (size - _STRETCH + 1).cast("int")))
    pieces = F.transform(places, lambda p: F.substring(F.col("text"), p, F.when(size <= 3 * _STRETCH, size)
                                                       .otherwise(_STRETCH).cast("int")))
    limit = max(1, max_texts // k)
    # of a language's texts about twice the limit by their hashes, of these the smallest
    share = F.create_map(*[F.lit(x) for c, n in totals.items() for x in (c, min(1.0, 2 * limit / n))])
    drawn = F.pmod("h", F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * F.lit(1 << 30)
    order = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 30)), "h", "pieces")
    rows = (train.select("lang", pieces.alias("pieces"), "h").where(drawn)
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)
            .orderBy("lang", "rank").collect())
    pieces = [(languages.index(r.lang), words) for r in rows for words in _taught(r.pieces)]
    model = empty._replace(lexicon=_lexicon(train, totals, max_words))
    return _fitted(model, _sequences(pieces)) if pieces else model


def _taught(pieces: list[str]) -> list[list[str]]:
    """The words of a sampled text that weights are fitted on: all of a short text; else, of each piece, those that the
    cuts left whole."""
    found = [letters(p.lower()) for p in pieces]
    if len(found) == 3:
        found = [found[0][:-1], found[1][1:-1], found[2][1:]]
    return [words[i:i + PIECE] for words in found for i in range(0, len(words), PIECE)]


_TAGGERS: dict[int, Tagger] = {}


def _tagger(key: int, model: Model) -> Tagger:
    """One tagger for a model in each Python worker, so that what it knows of words is kept between tasks."""
    if key not in _TAGGERS:
        _TAGGERS.clear()
        _TAGGERS[key] = Tagger(model)
    return _TAGGERS[key]


def predicted(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``held_out``, ``lang_pred`` and ``score``."""
    read = arrow_texts(docs, text_col, [id_col])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = zlib.crc32(model.weights.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        tagger = _tagger(key, model)
        max_bytes = max(50_000, 16_000_000 // max(1, len(model.languages)) ** 2)
        for batch in (part for whole in batches for part in slices(whole, 1, max_bytes, 4000)):
            texts = [_words(t) for t in texts_of(batch, 1)]
            names, scores = ["und"] * len(texts), np.zeros(len(texts))
            sizes = np.array([len(t) for t in texts])
            full = np.flatnonzero(sizes)
            if len(full) and model.languages:
                p = tagger.marginals(texts)
                sums = np.add.reduceat(p, (np.cumsum(sizes) - sizes)[full], axis=0)
                best = sums.argmax(axis=1)
                scores[full] = np.clip(sums.max(axis=1) / sizes[full], 0, 1)
                for i, b in zip(full.tolist(), best.tolist()):
                    names[i] = model.languages[b]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores)],
                                             names=["k0", "lang_pred", "score"])

    made = read.mapInArrow(run, f"k0 {read.schema['k0'].dataType.simpleString()}, lang_pred string, score double")
    return made.withColumnRenamed("k0", id_col).select(
        F.col(f"`{id_col}`"), held_out(id_col).alias("held_out"), "lang_pred", "score")
