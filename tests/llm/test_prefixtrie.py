"""The prefix trie next to a dictionary of prefixes; double arrays next to sets of sequences."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from halfhourly.llm import prefixtrie
from halfhourly.llm.prefixtrie import DoubleArray
from halfhourly.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


@settings(max_examples=200, deadline=None)
@given(st.sets(st.lists(st.integers(0, 12), max_size=7).map(tuple), min_size=1, max_size=60))
def test_a_double_array_holds_its_sequences(sequences):
    trie = DoubleArray([list(s) for s in sorted(sequences)])
    prefixes = {s[:d] for s in sequences for d in range(len(s) + 1)}
    assert len(trie.slots) == len(set(trie.slots)) == len(prefixes)
    slots = {}
    for p in prefixes:
        way = trie.walk(list(p))
        assert len(way) == len(p) + 1
        slots[way[-1]] = p
        for c in range(13):
            assert len(trie.walk([*p, c])) == len(p) + 1 + ((*p, c) in prefixes)
    assert set(slots) == set(trie.slots)


def test_a_packed_array_stays_small():
    draw = random.Random(1)
    sequences = sorted({tuple(draw.randrange(3000) for _ in range(5)) for _ in range(3000)})
    trie = DoubleArray([list(s) for s in sequences])
    assert len(trie.check) < 1.6 * len(trie.slots) + 3000


def rebuilt(rows):
    turns = {}
    for c, t, r, x in rows:
        if c is not None:
            turns.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [v[2:] for v in sorted(own)] for c, own in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = turns.get(c - c % 20, [])[:h] + own[h:]
    return out


def plain_nodes(conversations):
    """Rows of the contract, by a dictionary of prefixes."""
    members, ends = {}, {}
    for c, seq in sorted(conversations.items()):
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
        ends.setdefault(tuple(seq), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len([w for w in p[-1][1].replace("\x85", "x").replace("\xa0", "x").split()]) if p else 0
        leaves[p] = sum(leaves[k] for k in kids.get(p, [])) or 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in kids.get(p, []))
    return sorted((members[p][0], len(p), members[p[:-1]][0] if p else -1, len(members[p]), len(kids.get(p, [])),
                   leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, ends.get(p, []))).encode()).hexdigest()) for p in members)


def found_nodes(spark, rows, extra=()):
    placed = prefixtrie.placed_turns(spark.createDataFrame(rows, SCHEMA).selectExpr("*", *extra))
    nodes = prefixtrie.prefix_nodes(*prefixtrie.shared_starts(placed)).collect()
    return sorted((n.conv, n.depth, -1 if n.parent_conv is None else n.parent_conv, n.n_convs, n.n_children,
                   n.n_leaves, n.saved, n.ends) for n in nodes)


def some(draw, conv, n, kinds):
    return [(conv, t, draw.choice(["user", "assistant"]), " ".join(["word"] * draw.randrange(kinds))) for t in range(n)]


@pytest.mark.parametrize("segment", [128, 3])
def test_against_a_dictionary(spark, monkeypatch, segment):
    monkeypatch.setattr(prefixtrie, "SEGMENT", segment)
    draw = random.Random(segment)
    rows = [r for c in range(150) for r in some(draw, c, draw.randrange(1, 9), 2)]
    rows += [(c, t, "user", f"same {t}") for c in range(200, 260) for t in range(5)]      # copies
    draw.shuffle(rows)
    assert found_nodes(spark, rows) == plain_nodes(rebuilt(rows))


def test_nulls_ties_repeats_and_clashing_names(spark):
    draw = random.Random(4)
    rows = [(draw.choice([None, 0, 1, 2, 20, 21, 25, -3]), draw.choice([None, 0, 1, 1]), draw.choice(["u", None, ""]),
             draw.choice(["a b", "a b", None, "", "c\td\n"])) for _ in range(60)]
    rows = [r for r in rows if r[0] is None or r[0] >= 0]
    assert found_nodes(spark, rows, ["1 AS depth", "'x' AS words", "turn AS place"]) == plain_nodes(rebuilt(rows))
    empty = prefixtrie.placed_turns(spark.createDataFrame([], SCHEMA))
    assert prefixtrie.prefix_nodes(*prefixtrie.shared_starts(empty)).count() == 0


def test_long_conversations_in_segments(spark):
    """Conversations of hundreds of turns that part late, and one beginning that most of them share."""
    draw = random.Random(5)
    long = [(t, "user", f"turn {t} of many") for t in range(300)]
    rows = [(20, *turn) for turn in long] + [(40, *turn) for turn in long[:256]] + [(60, *turn) for turn in long]
    rows += [(80, *turn) for turn in long[:280]] + [(80, t, "user", "aside") for t in range(280, 290)]
    rows += [(100 + c, t, "user", "hello" if t == 0 else f"{draw.randrange(2)}") for c in range(0, 200, 20)
             for t in range(4)]
    assert found_nodes(spark, rows) == plain_nodes(rebuilt(rows))


def test_texts_of_nodes(spark):
    rows = [(0, 0, "user", "one two"), (20, 0, "user", "one two"), (20, 1, "assistant", None)]
    turns = spark.createDataFrame(rows, SCHEMA)
    nodes = prefixtrie.prefix_nodes(*prefixtrie.shared_starts(prefixtrie.placed_turns(turns)))
    said = {r.depth: (r.role, r.text) for r in prefixtrie.texts_of_nodes(nodes, turns).collect()}
    assert said == {0: (None, None), 1: ("user", "one two"), 2: ("assistant", "")}


def test_the_query_next_to_a_dictionary(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    found = sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children,
                    r.n_leaves, r.saved_tokens, r.ends_sha256) for r in QUERIES["op13_prefix_trie"](spark, sf).collect())
    assert found == plain_nodes(rebuilt(rows))
