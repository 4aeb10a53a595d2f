"""Conversation prefix trie: double-array tries per prefix shard, shared upper nodes merged globally.

A node is a distinct sequence of first turns. Every conversation is the sequence of its turns'
fingerprints (128 bits of SHA-256 of role and text). Sequences are cut into ranges in their own order, so a
shard holds neighbouring prefixes and a crowded first turn, or many copies of one conversation, spread
over shards. A shard numbers its turns densely, packs one double array (BASE, CHECK) over those
numbers, walks each distinct sequence through it to count members, and adds up subtrees from the bottom.

Only the paths of a shard's first and last sequence can be shared with a neighbour. All other
nodes are finished in the shard. Nodes of the two paths go out with what their finished children
amount to; one grouping by node merges them over all shards, and their subtree sums are added
along their paths, which are at most ``SEGMENT`` long. Ids of conversations that end at such a node are joined to
long strings in the shards before they are hashed in order.

Conversations longer than ``SEGMENT`` turns are cut into segments. The nodes below a segment's end form tries of their
own, built first; their sums enter the trie above as if they stood below that end. Neither a row nor a
bound of a range ever holds more than one segment, and no task a whole conversation.

Defined cases: a null role or text is empty; rows without a turn come first; turns of one number are in the order
of role and text; repeated rows are turns of their own; rows without a conversation belong to none and take no part;
a conversation without turns is a member of the root; no conversations give no nodes; other columns
stay behind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from halfhourly.llm.common import numbered
from halfhourly.llm.turns import in_order, partitions, stream_digests
from halfhourly.session import staged

SEGMENT, IDS_AT_ONCE, _DIGEST, _TRIES = 128, 100_000, 16, 64
_NO_IDS = hashlib.sha256(b"").hexdigest()


class DoubleArray:
    """A trie of sorted, distinct sequences of small numbers in two arrays.

    Slot 0 is the root. The child of slot s by number c is slot t = base[s] + c, if check[t] is s.
    A slot's children go to the first place where all of them are free; after some
    failures they go behind everything placed so far.
    """

    def __init__(self, sequences: list[list[int]]):
        self.base, self.check, self.depth, self.slots = [0], [0], [0], [0]
        self._free = 1
        ranges = [(0, 0, len(sequences))]
        while ranges:
            slot, first, end = ranges.pop()
            d = self.depth[slot]
            while first < end and len(sequences[first]) == d:
                first += 1
            groups = []
            for i in range(first, end):
                c = sequences[i][d]
                if not groups or groups[-1][0] != c:
                    groups.append([c, i, i])
                groups[-1][2] = i + 1
            if groups:
                base = self._place([g[0] for g in groups])
                self.base[slot] = base
                for c, a, b in groups:
                    self._take(base + c, slot, d + 1)
                    ranges.append((base + c, a, b))

    def _is_free(self, slot: int) -> bool:
        return slot > 0 and (slot >= len(self.check) or self.check[slot] < 0)

    def _place(self, numbers: list[int]) -> int:
        while not self._is_free(self._free):
            self._free += 1
        slot, failed = self._free, 0
        while True:
            base = slot - numbers[0]
            if all(self._is_free(base + c) for c in numbers):
                return base
            failed += 1
            slot = slot + 1 if failed < _TRIES else len(self.check)
            while not self._is_free(slot):
                slot += 1

    def _take(self, slot: int, parent: int, depth: int) -> None:
        missing = slot + 1 - len(self.check)
        if missing > 0:
            self.base.extend([0] * missing)
            self.check.extend([-1] * missing)
            self.depth.extend([0] * missing)
        self.check[slot], self.depth[slot] = parent, depth
        self.slots.append(slot)

    def walk(self, sequence: list[int]) -> list[int]:
        """The slots on a sequence's way, the root first; stops where the trie ends."""
        slot, way = 0, [0]
        for c in sequence:
            following = self.base[slot] + c
            if not (0 < following < len(self.check)) or self.check[following] != slot:
                break
            slot = following
            way.append(slot)
        return way


class Run:
    """Equal sequences of a shard: members, the ids of those that end here, what stands below their end."""

    def __init__(self, top: bytes, top_conv: int | None, sequence: bytes, words: list[int], below: tuple):
        self.top, self.top_conv, self.sequence, self.words, self.below = top, top_conv, sequence, words, below
        self.n, self.first = 0, None
        self.ids: list[int] = []
        self.chunks: list[str] = []

    def add(self, conv: int, ends: bool) -> None:
        if self.n == 0:
            self.first = conv
        self.n += 1
        if ends:
            self.ids.append(conv)
            if len(self.ids) == IDS_AT_ONCE:
                self.settle()

    def settle(self) -> None:
        if self.ids:
            self.chunks.append(",".join(map(str, self.ids)))
            self.ids = []

    def digest(self) -> str:
        self.settle()
        found = hashlib.sha256()
        for k, chunk in enumerate(self.chunks):
            found.update(("," if k else "").encode() + chunk.encode())
        return found.hexdigest()


#: Rows that a shard sends out: finished nodes, those whose parent is shared, shared nodes, ids that end at
#: shared nodes, finished tops of segments.
_NODE, _BORDER, _SHARED, _IDS, _TOP = range(5)
_FIELDS = [("kind", "int"), ("part", "int"), ("place", "int"), ("key", "binary"), ("parent", "binary"),
           ("path", "array<binary>"), ("turn", "binary"), ("conv", "bigint"), ("depth", "bigint"),
           ("parent_conv", "bigint"), ("n_convs", "bigint"), ("n_children", "bigint"), ("n_leaves", "bigint"),
           ("saved", "bigint"), ("words", "bigint"), ("below_children", "bigint"), ("below_leaves", "bigint"),
           ("below_saved", "bigint"), ("ends", "string")]
_ARROW = pa.schema([(n, {"int": pa.int32(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary()),
                         "bigint": pa.int64(), "string": pa.string()}[t]) for n, t in _FIELDS])


class Shard:
    """The trie below one top: double array, members and subtree sums."""

    def __init__(self, runs: list[Run], depth: int, part: int, opens: list[Run]):
        self.runs, self.depth, self.part = runs, depth, part
        turns = np.frombuffer(b"".join(r.sequence for r in runs), dtype=f"V{_DIGEST}")
        distinct, codes = np.unique(turns, return_inverse=True)
        self.turns = [d.tobytes() for d in distinct]
        sequences, at, codes = [], 0, codes.tolist()
        for r in runs:
            n = len(r.sequence) // _DIGEST
            sequences.append(codes[at:at + n])
            at += n
        trie = self.trie = DoubleArray(sequences)
        size = len(trie.check)
        self.n, self.words, self.ends = [0] * size, [0] * size, {}
        self.first: list[int | None] = [None] * size
        self.code = [0] * size
        for r, sequence in zip(runs, sequences):
            way = trie.walk(sequence)
            for slot in way:
                self.n[slot] += r.n
                if self.first[slot] is None or r.first < self.first[slot]:
                    self.first[slot] = r.first
            for slot, c, w in zip(way[1:], sequence, r.words):
                self.code[slot], self.words[slot] = c, w
            self.ends[way[-1]] = r
        if runs[0].top_conv is not None:
            self.first[0] = runs[0].top_conv
        self.keys: dict[int, list[bytes]] = {}      # of shared slots: their path's keys, their own last
        for r, sequence in zip(runs, sequences):
            if any(r is o for o in opens):
                digest, path = hashlib.sha256(r.top), [r.top]
                self.keys[0] = [r.top]
                for slot, c in zip(trie.walk(sequence)[1:], sequence):
                    digest.update(self.turns[c])
                    path = [*path, digest.copy().digest()[:_DIGEST]]
                    self.keys[slot] = path
        self._add_up()

    def _add_up(self) -> None:
        """Children, leaves and savings of each subtree, without those of shared children."""
        size = len(self.n)
        self.children, self.leaves, self.saved = [0] * size, [0] * size, [0] * size
        for slot in reversed(self.trie.slots):
            if slot in self.keys:
                continue
            below = self.ends[slot].below if slot in self.ends else (0, 0, 0)
            self.children[slot] += below[0]
            self.leaves[slot] += below[1] + (self.children[slot] == 0)
            self.saved[slot] += below[2] + (self.n[slot] - 1) * self.words[slot]
            if slot:
                parent = self.trie.check[slot]
                self.children[parent] += 1
                self.leaves[parent] += self.leaves[slot]
                self.saved[parent] += self.saved[slot]

    def rows(self) -> Iterator[dict]:
        for slot in self.trie.slots:
            depth = self.trie.depth[slot]
            parent = self.trie.check[slot] if slot else None
            row = {"part": self.part, "conv": self.first[slot], "depth": self.depth + depth, "n_convs": self.n[slot],
                   "n_children": self.children[slot], "n_leaves": self.leaves[slot], "saved": self.saved[slot],
                   "turn": self.turns[self.code[slot]] if slot else None}
            run = self.ends.get(slot)
            if slot in self.keys:
                path = self.keys[slot]
                below = run.below if run else (0, 0, 0)
                yield {**row, "kind": _SHARED, "key": path[-1], "parent": path[-2] if slot else None, "path": path,
                       "words": self.words[slot], "below_children": below[0], "below_leaves": below[1],
                       "below_saved": below[2]}
                if run:
                    run.settle()
                    for k, text in enumerate(run.chunks):
                        yield {"kind": _IDS, "part": self.part, "place": k, "key": path[-1], "ends": text}
            elif slot == 0 and self.depth:
                yield {**row, "kind": _TOP, "key": self.runs[0].top}
            else:
                row["ends"] = run.digest() if run else _NO_IDS
                if parent in self.keys:
                    yield {**row, "kind": _BORDER, "parent": self.keys[parent][-1]}
                else:
                    yield {**row, "kind": _NODE, "parent_conv": None if parent is None else self.first[parent]}


def _built(rows: DataFrame, depth: int) -> DataFrame:
    """What the shards of one segment send out. ``rows``: top, seq, conv, words, more, top_conv, below_*."""
    keys = ["top", "seq", "conv"]
    cut = (rows.select(*keys, "words", "more", "top_conv", "below_children", "below_leaves", "below_saved")
           .repartitionByRange(partitions(rows), *keys).sortWithinPartitions(*keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, runs = TaskContext.get().partitionId(), []
        edge, begun = None, False                      # the shard's first run, until its trie is made

        def sent(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal runs, edge
            opens = [r for r in (edge, runs[-1] if last else None) if r is not None]
            edge, out = None, []
            for row in Shard(runs, depth, part, opens).rows():
                out.append(row)
                if len(out) == 5_000:
                    yield pa.RecordBatch.from_pylist(out, schema=_ARROW)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_ARROW)
            runs = []

        for batch in batches:
            for top, seq, conv, words, more, top_conv, *below in zip(*[c.to_pylist() for c in batch.columns]):
                if not runs or runs[-1].top != top or runs[-1].sequence != seq:
                    if runs and runs[-1].top != top:
                        yield from sent(last=False)
                    runs.append(Run(top, top_conv, seq, words, (0, 0, 0)))
                    if not begun:
                        edge, begun = runs[0], True
                runs[-1].add(conv, not more)
                if more:
                    runs[-1].below = tuple(below)
        if runs:
            yield from sent(last=True)

    return staged(cut.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in _FIELDS)), "trie-shards")


def _merged(sent: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """Nodes of all shards, and the tops of a lower segment with what stands below them."""
    shared = staged(sent.where(F.col("kind") == _SHARED).groupBy("key").agg(
        F.first("parent").alias("parent"), F.first("path").alias("path"), F.first("turn").alias("turn"),
        F.min("conv").alias("conv"), F.first("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        *[F.max(c).alias(c) for c in ("words", "below_children", "below_leaves", "below_saved")]), "trie-shared")
    children = shared.where("parent IS NOT NULL").groupBy("parent").agg(F.count(F.lit(1)).alias("shared_children"))
    whole = (shared.join(children.withColumnRenamed("parent", "key"), "key", "left")
             .withColumn("n_children", F.col("n_children") + F.col("below_children")
                         + F.coalesce("shared_children", F.lit(0))))
    own = whole.select(
        F.explode("path").alias("key"),
        (F.col("n_leaves") + F.col("below_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("n_leaves"),
        (F.col("saved") + F.col("below_saved") + (F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    sums = own.groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    whole = staged(whole.drop("n_leaves", "saved").join(sums, "key"), "trie-sums")
    parents = whole.select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv"))
    ends = stream_digests(sent.where(F.col("kind") == _IDS), "key", ["part", "place"], "ends", ",")
    columns = ["conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved", "turn", "ends"]
    above = (whole.where((F.col("depth") > depth) | F.lit(depth == 0))
             .join(parents, "parent", "left").join(ends, "key", "left")
             .withColumn("ends", F.coalesce("sha256", F.lit(_NO_IDS))))
    border = sent.where(F.col("kind") == _BORDER).drop("parent_conv").join(parents, "parent")
    nodes = (sent.where(F.col("kind") == _NODE).select(*columns)
             .unionByName(border.select(*columns)).unionByName(above.select(*columns)))
    below = ["key", "n_children", "n_leaves", "saved"]
    tops = (whole.where(F.col("depth") == depth).select(*below)
            .unionByName(sent.where(F.col("kind") == _TOP).select(*below)))
    return nodes, tops


def placed_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """``conv``, ``place`` of the turn in its conversation from 0, ``digest`` of role and text, ``words`` of the text."""
    read = turns.select(F.col(f"`{conv}`").cast("bigint").alias("conv"), F.col(f"`{turn}`").alias("turn"),
                        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")).where("conv IS NOT NULL")
    order = [f"o{i}" for i in range(4)]
    rows = read.select(
        "conv", F.col("turn").alias("o0"), F.substring("role", 1, 32).alias("o1"), F.substring("text", 1, 64).alias("o2"),
        F.xxhash64("role", "text").alias("o3"),
        F.substring(F.unhex(F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)), 1, _DIGEST).alias("digest"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).alias("words"))
    return numbered(rows, ["conv"], order, "place", "trie-turns").select("conv", "place", "digest", "words")


def prefix_nodes(placed: DataFrame, members: DataFrame) -> DataFrame:
    """One row per node of the trie over conversations.

    ``placed``: conv, place (from 0, without gaps), digest, words. ``members``: every conv once, with its ``n_turns``.
    Result: ``conv`` (smallest member), ``depth``, ``parent_conv``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved`` (words that members after the first need not be read again, over the subtree), ``turn`` (digest of the
    last turn) and ``ends`` (SHA-256 of the ids of members that end here, ascending, comma-joined).
    """
    spark = placed.sparkSession
    grouped = (placed.groupBy("conv", F.expr(f"place div {SEGMENT}").alias("segment"))
               .agg(F.array_sort(F.collect_list(F.struct("place", "digest", "words"))).alias("turns"))
               .select("conv", "segment",
                       F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")).alias("seq"),
                       F.transform("turns", lambda t: t["words"]).alias("words")))
    no_turns = (members.where(F.col("n_turns") == 0)
                .select("conv", F.lit(0).cast("bigint").alias("segment"), F.lit(b"").alias("seq"),
                        F.array().cast("array<int>").alias("words")))
    every = (grouped.unionByName(no_turns).join(members, "conv")
             .select("conv", "segment", "seq", "words",
                     (F.col("n_turns") > (F.col("segment") + 1) * SEGMENT).alias("more")))
    every = staged(every, "trie-segments")
    last = every.agg(F.max("segment")).first()[0]
    if last is None:
        return spark.createDataFrame([], "conv bigint, depth bigint, parent_conv bigint, n_convs bigint, "
                                         "n_children bigint, n_leaves bigint, saved bigint, turn binary, ends string")
    own = F.substring(F.unhex(F.sha2(F.concat("top", "seq"), 256)), 1, _DIGEST)
    rounds = [every.where("segment = 0").withColumn("top", F.lit(bytes(_DIGEST)))
              .withColumn("top_conv", F.lit(None).cast("bigint")).withColumn("own", own)]
    for segment in range(1, last + 1):
        above = rounds[-1].where("more")
        # conversations that end at the top are members of it, too
        firsts = (rounds[-1].join(above.select("own").distinct(), "own").groupBy("own")
                  .agg(F.min("conv").alias("top_conv")))
        rows = (every.where(F.col("segment") == segment).join(above.select("conv", F.col("own").alias("top")), "conv")
                .join(firsts.withColumnRenamed("own", "top"), "top").withColumn("own", own))
        rounds.append(staged(rows, "trie-segment"))
    nodes, tops = None, None
    for segment in reversed(range(last + 1)):
        rows = rounds[segment]
        names = ["below_children", "below_leaves", "below_saved"]
        if tops is None:
            rows = rows.withColumns({c: F.lit(0).cast("bigint") for c in names})
        else:
            below = tops.select(F.col("key").alias("own"), *[F.col(c).alias(n) for c, n in
                                                             zip(("n_children", "n_leaves", "saved"), names)])
            rows = rows.join(below, "own", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in names})
        made, tops = _merged(_built(rows, segment * SEGMENT), segment * SEGMENT)
        nodes = made if nodes is None else nodes.unionByName(made)
    return nodes


def shared_starts(placed: DataFrame, every: int = 20, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like another: the first h turns are those of conversation c - c % ``every`` (all if
    fewer, none if absent) instead of c's own first h, with h = crc32(c) % (``most`` + 1). Returns placed turns and members."""
    own = placed.groupBy("conv").agg(F.count(F.lit(1)).alias("n_own"))
    base = F.col("conv") - F.col("conv") % every
    plan = own.select("conv", "n_own", base.alias("base"), F.when(base == F.col("conv"), 0).otherwise(
        F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)).alias("h"))
    sizes = own.select(F.col("conv").alias("base"), F.col("n_own").alias("n_base"))
    plan = plan.join(sizes, "base", "left").select(
        "conv", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken"), "n_own")
    plan = staged(plan.withColumn("n_turns", F.col("taken") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))),
                  "trie-plan")
    rest = (placed.join(plan.select("conv", "h", "taken"), "conv").where(F.col("place") >= F.col("h"))
            .select("conv", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "digest", "words"))
    starts = (placed.where(F.col("place") < most).where(F.col("conv") % every == 0).withColumnRenamed("conv", "base")
              .join(plan.where(F.col("taken") > 0).select("conv", "base", "taken"), "base")
              .where(F.col("place") < F.col("taken")).select("conv", "place", "digest", "words"))
    return rest.unionByName(starts), plan.select("conv", "n_turns")


def texts_of_nodes(nodes: DataFrame, turns: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """Nodes with ``role`` and ``text`` of their last turn."""
    sides = turns.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n)
                           for c, n in ((role, "role"), (text, "text"))])
    key = F.substring(F.unhex(F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)), 1, _DIGEST)
    sides = sides.withColumn("turn", key).groupBy("turn").agg(F.first(F.struct("role", "text")).alias("said"))
    return nodes.join(sides, "turn", "left").select(*nodes.columns, "said.role", "said.text")
