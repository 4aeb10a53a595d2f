"""Token counts by rank-synchronous merging of ragged arrays, for a BPE vocabulary of sentencepiece.

A text is cut where no piece of the vocabulary can reach across: before a word mark that
follows another character, and around characters that stand in no longer piece. What lies
between two cuts is a pre-token. The new pre-tokens of a batch are held side by side in one
ragged numpy array of symbols. In every round each pre-token's lowest-ranked pair is found
and applied at all its places at once, all pre-tokens together; those without a pair drop
out. A text's count is the sum over its pre-tokens of the symbols that survive, where a
character that the vocabulary lacks counts one token for each of its bytes.

Two kinds of rank are applied at their leftmost place only, one place a round: ranks that
several pieces share, and pieces that can form a pair of a lower rank. Everything else
leaves the lowest pairs of a round independent, so rounds give what merging one pair after
the other gives. A pre-token of more than ``LONG`` symbols is merged with an index from
ranks to places instead of being looked through again in every round; it takes the same
merges in the same order.

Every task counts its own rows; nothing is shuffled, collected or broadcast but the path of
the vocabulary, which each worker loads once. Counts of up to ``KNOWN`` short pre-tokens are
kept by a worker; that only saves time.

Defined cases: a null or empty text has no bytes and no tokens; special strings in a text
are plain letters, as the library takes them by default; bytes that are no UTF-8 count as
the replacement character; a very long text is cut up piece by piece; repeated rows are
counted each, null ids are passed on, no rows give no rows; other columns stay behind.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from halfhourly.llm.common import arrow_texts, decoded, texts_of

LIMIT, LONG, KNOWN, KNOWN_CHARS = 4096, 256, 800_000, 64
_CHARS_AT_ONCE = 1_000_000
MARK = "▁"
_NEVER = np.iinfo(np.int32).max


def _class(characters: set[str]) -> str:
    """The inside of a pattern's character class, as ranges."""
    codes, out = sorted(map(ord, characters)), []
    for c in codes:
        if out and c == out[-1][1] + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


class Vocabulary:
    """Symbols, ranks of their pairs and the pattern of pre-tokens, read from a model file."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        scores = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size())
                  if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}
        longer = {p: s for p, s in scores.items() if len(p) > 1}
        symbols = sorted(set(scores).union(*longer))
        ids = {s: k for k, s in enumerate(symbols)}
        self.size = len(symbols) + 4
        # a character outside of the symbols is one of the last four, by its bytes
        self.weights = np.array([1 if s in scores else len(s.encode()) for s in symbols] + [1, 2, 3, 4])
        codes = np.arange(0x110000)
        self.of_code = (len(symbols) + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)).astype(np.int32)
        for s in symbols:
            if len(s) == 1:
                self.of_code[ord(s)] = ids[s]
        levels = sorted(set(longer.values()), reverse=True)
        rank_of = {score: k for k, score in enumerate(levels)}
        shared = np.zeros(len(levels), dtype=np.int64)
        pairs = []
        for piece, score in longer.items():
            shared[rank_of[score]] += 1
            pairs += [(ids[piece[:i]] * self.size + ids[piece[i:]], rank_of[score], ids[piece])
                      for i in range(1, len(piece)) if piece[:i] in ids and piece[i:] in ids]
        pairs.sort()
        self.keys, self.ranks, self.made = (np.array(c, dtype=t) for c, t in
                                            zip(zip(*pairs), (np.int64, np.int32, np.int32)))
        self._pairs: dict[int, tuple[int, int]] = {}
        #: Ranks to be applied at one place a round.
        self.alone = shared > 1
        rank_of_symbol = np.full(self.size, -1)
        for piece, score in longer.items():
            rank_of_symbol[ids[piece]] = rank_of[score]
        for part in (self.keys // self.size, self.keys % self.size):
            before = rank_of_symbol[part]
            self.alone[before[before > self.ranks]] = True
        joining = set("".join(longer)) - {MARK}
        both = _class(joining)
        self.pieces = re.compile(f"{MARK}+[{both}]*|[{both}]+|[^{MARK}{both}]+")
        self.cut = re.compile(f"(?<!{MARK}){MARK}")

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and made symbol of pairs; ``_NEVER`` where there is no such piece."""
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = self.keys[at] == keys
        return np.where(found, self.ranks[at], _NEVER), self.made[at]

    def pair(self, left: int, right: int) -> tuple[int, int] | None:
        """Rank and made symbol of one pair."""
        if not self._pairs:
            self._pairs = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.made.tolist())))
        return self._pairs.get(left * self.size + right)

    def symbols(self, text: str) -> np.ndarray:
        return self.of_code[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]


def _first_of(groups: np.ndarray) -> np.ndarray:
    """Marks the first of each run of equal numbers."""
    first = np.ones(len(groups), dtype=bool)
    first[1:] = groups[1:] != groups[:-1]
    return first


def _apart(places: np.ndarray, touches: np.ndarray) -> np.ndarray:
    """Every second place of each run of overlapping ones; ``touches``: overlaps the place before."""
    index = np.arange(len(places))
    start = np.maximum.accumulate(np.where(touches, 0, index))
    return (index - start) % 2 == 0


def merged_counts(vocabulary: Vocabulary, words: list[str]) -> np.ndarray:
    """Tokens of each pre-token, all merged side by side."""
    lengths = np.array([len(w) for w in words])
    totals = np.zeros(len(words), dtype=np.int64)
    symbol = vocabulary.symbols("".join(words))
    owner = np.repeat(np.arange(len(words)), lengths)

    def ranked(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        inside = (places >= 0) & (places + 1 < len(symbol))
        places = places[inside]
        places = places[owner[places] == owner[places + 1]]
        rank, made = vocabulary.pair_ranks(symbol[places], symbol[places + 1])
        return places, np.stack([rank, made])

    pair = np.full((2, len(symbol)), _NEVER, dtype=np.int32)
    places, found = ranked(np.arange(len(symbol)))
    pair[:, places] = found
    while len(symbol):
        starts = np.flatnonzero(_first_of(owner))
        sizes = np.diff(np.append(starts, len(symbol)))
        lowest = np.repeat(np.minimum.reduceat(pair[0], starts), sizes)
        open_ = lowest != _NEVER
        if not open_.all():             # finished pre-tokens are counted and leave the array
            done = ~open_
            totals += np.bincount(owner[done], vocabulary.weights[symbol[done]], len(words)).astype(np.int64)
            symbol, owner, pair, lowest = symbol[open_], owner[open_], pair[:, open_], lowest[open_]
            if not len(symbol):
                break
        places = np.flatnonzero(pair[0] == lowest)
        touches = np.zeros(len(places), dtype=bool)
        touches[1:] = (np.diff(places) == 1) & (owner[places[1:]] == owner[places[:-1]])
        chosen = _apart(places, touches) & (~vocabulary.alone[lowest[places]] | _first_of(owner[places]))
        places = places[chosen]
        symbol[places] = pair[1, places]
        left = np.ones(len(symbol), dtype=bool)
        left[places + 1] = False
        at = np.cumsum(left)[places] - 1
        symbol, owner, pair = symbol[left], owner[left], pair[:, left]
        changed = np.unique(np.concatenate([at, at - 1]))
        changed = changed[changed >= 0]
        pair[:, changed] = _NEVER
        places, found = ranked(changed)
        pair[:, places] = found
    return totals


class _Indexed:
    """One long pre-token as a linked list, with the places of each rank kept in an index.

    Ranks that are applied at one place a time wait in the queue with their place, the
    others once for all their places.
    """

    def __init__(self, vocabulary: Vocabulary, word: str):
        self.vocabulary, self.symbol = vocabulary, vocabulary.symbols(word).copy()
        self.n = n = len(self.symbol)
        self.following, self.before = np.arange(1, n + 1), np.arange(-1, n - 1)
        self.alive = np.ones(n, dtype=bool)
        self.queue: list[tuple[int, int]] = []
        self.waiting: dict[int, list[np.ndarray]] = {}
        self._look(np.arange(n))

    def _wait(self, rank: int, places: np.ndarray) -> None:
        if rank not in self.waiting:
            self.waiting[rank] = []
            heapq.heappush(self.queue, (rank, -1))
        self.waiting[rank].append(places)

    def _look(self, places: np.ndarray) -> None:
        """Notes the pairs that begin at places."""
        places = places[self.following[places] < self.n]
        rank, _ = self.vocabulary.pair_ranks(self.symbol[places], self.symbol[self.following[places]])
        hit = rank != _NEVER
        places, rank = places[hit], rank[hit]
        single = self.vocabulary.alone[rank]
        for entry in zip(rank[single].tolist(), places[single].tolist()):
            heapq.heappush(self.queue, entry)
        places, rank = places[~single], rank[~single]
        order = np.argsort(rank, kind="stable")
        places, rank = places[order], rank[order]
        bounds = np.flatnonzero(_first_of(rank)).tolist() if len(rank) else []
        for a, b in zip(bounds, [*bounds[1:], len(rank)]):
            self._wait(int(rank[a]), places[a:b])

    def _pair(self, place: int) -> tuple[int, int] | None:
        after = self.following[place]
        if not self.alive[place] or after >= self.n:
            return None
        return self.vocabulary.pair(int(self.symbol[place]), int(self.symbol[after]))

    def _merge_one(self, rank: int, place: int) -> None:
        found = self._pair(place)
        if found is None or found[0] != rank:
            return
        gone = int(self.following[place])
        self.symbol[place], self.alive[gone] = found[1], False
        after = self.following[place] = self.following[gone]
        if after < self.n:
            self.before[after] = place
        for p in (place, int(self.before[place])):
            new = self._pair(p) if p >= 0 else None
            if new and self.vocabulary.alone[new[0]]:
                heapq.heappush(self.queue, (new[0], p))
            elif new:
                self._wait(new[0], np.array([p]))

    def _merge_all(self, rank: int, places: np.ndarray) -> None:
        places = places[self.alive[places] & (self.following[places] < self.n)]
        found, made = self.vocabulary.pair_ranks(self.symbol[places], self.symbol[self.following[places]])
        places, made = places[found == rank], made[found == rank]
        touches = np.zeros(len(places), dtype=bool)
        touches[1:] = self.following[places[:-1]] == places[1:]
        chosen = _apart(places, touches)
        places, made = places[chosen], made[chosen]
        gone = self.following[places]
        self.symbol[places], self.alive[gone] = made, False
        after = self.following[gone]
        self.following[places] = after
        inner = after < self.n
        self.before[after[inner]] = places[inner]
        previous = self.before[places]
        self._look(np.unique(np.concatenate([places, previous[previous >= 0]])))

    def count(self) -> int:
        while self.queue:
            rank, place = heapq.heappop(self.queue)
            if place < 0:
                self._merge_all(rank, np.unique(np.concatenate(self.waiting.pop(rank))))
            else:
                self._merge_one(rank, place)
        return int(self.vocabulary.weights[self.symbol[self.alive]].sum())


def merged_count(vocabulary: Vocabulary, word: str) -> int:
    """Tokens of one long pre-token."""
    return _Indexed(vocabulary, word).count()


class Counter:
    """Counts tokens of texts; keeps the counts of short pre-tokens."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.known: dict[str, int] = {}

    def _parts(self, text: str) -> Iterator[tuple[list[str], int]]:
        """Pre-tokens of a text with their size, those of about ``_CHARS_AT_ONCE`` characters at a time."""
        text, at = MARK + text.replace(" ", MARK), 0
        while at < len(text):
            end = self.vocabulary.cut.search(text, at + _CHARS_AT_ONCE)
            end = end.start() if end else len(text)
            yield self.vocabulary.pieces.findall(text, at, end), end - at
            at = end

    def _settle(self, held: list[tuple[int, list[str]]], out: list[int]) -> None:
        """Adds the tokens of lists of pre-tokens to the counts of their texts; new ones are merged together."""
        words = set().union(*(parts for _, parts in held))
        if len(self.known) + len(words) > KNOWN:
            self.known.clear()
        new = words.difference(self.known)
        short = [w for w in new if len(w) <= LONG]
        if short:
            self.known.update(zip(short, merged_counts(self.vocabulary, short).tolist()))
        self.known.update((w, merged_count(self.vocabulary, w)) for w in new if len(w) > LONG)
        for k, parts in held:
            out[k] += sum(map(self.known.__getitem__, parts))
        for w in new:
            if len(w) > KNOWN_CHARS:
                del self.known[w]

    def counts(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        held: list[tuple[int, list[str]]] = []
        waiting = 0
        for k, text in enumerate(texts):
            for parts, size in self._parts(text) if text else ():
                held.append((k, parts))
                waiting += size
                if waiting >= _CHARS_AT_ONCE:
                    self._settle(held, out)
                    held, waiting = [], 0
        if held:
            self._settle(held, out)
        return out


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


_RESULT = "n_bytes bigint, n_tokens bigint, over_limit boolean"


def token_counts(docs: DataFrame, model_path: str, keep: list[str], text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """One row per document: the ``keep`` columns, ``n_bytes``, ``n_tokens`` and whether those exceed ``limit``."""
    read, n = arrow_texts(docs, text_col, keep), len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(model_path).counts
        for batch in batches:
            texts = texts_of(batch, n)
            tokens = count([decoded(t) for t in texts])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array([len(t) for t in texts], pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([t > limit for t in tokens], pa.bool_())],
                names=[*batch.schema.names[:n], "n_bytes", "n_tokens", "over_limit"])

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in read.schema.fields[:n]]
    made = read.mapInArrow(run, ", ".join([*kinds, _RESULT]))
    return made.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "n_bytes", "n_tokens", "over_limit")
