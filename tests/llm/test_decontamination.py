"""Greedy string tiling and decontamination against plain versions."""
import random
import re

import numpy as np
import pytest

from halfhourly.llm import decontamination as dc
from halfhourly.llm.words import word_hashes


def tiles_by_hand(item: list, doc: list, m: int) -> list[int]:
    """Lengths of the tiles, longest first."""
    used_i, used_d, out = set(), set(), []
    while True:
        best = 0
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k] \
                        and i + k not in used_i and j + k not in used_d:
                    k += 1
                if k > best:
                    best, at = k, (i, j)
        if best < m:
            return out
        used_i |= set(range(at[0], at[0] + best))
        used_d |= set(range(at[1], at[1] + best))
        out.append(best)


def hashes(words: list[str]) -> np.ndarray:
    return word_hashes([" ".join(words)])[0]


def test_tiles_against_brute_force():
    rng = random.Random(4)
    for _ in range(150):
        kinds = rng.choice([2, 3, 8])
        item = [str(rng.randrange(kinds)) for _ in range(rng.randrange(0, 25))]
        doc = [str(rng.randrange(kinds)) for _ in range(rng.randrange(0, 40))]
        found = dc.tiles(hashes(item), hashes(doc), np.ones(len(doc), dtype=bool), 3)
        # equal lengths may be dealt out in another order, which can change later tiles
        lengths = [t.words for t in found]
        assert lengths == sorted(lengths, reverse=True)
        want = tiles_by_hand(item, doc, 3)
        assert (lengths[:1] or [0]) == (want[:1] or [0])
        for t in found:
            assert item[t.item_at:t.item_at + t.words] == doc[t.doc_at:t.doc_at + t.words]
        for side in ("item_at", "doc_at"):
            spots = [p for t in found for p in range(getattr(t, side), getattr(t, side) + t.words)]
            assert len(spots) == len(set(spots))
    many = ["a"] * 30_000
    assert [t.words for t in dc.tiles(hashes(many), hashes(many[:20_000]), np.ones(20_000, dtype=bool), 5)] == [20_000]


def words_of(text):
    return re.findall(r"\w+", (text or "").lower())


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(8)
    word = [f"w{i}" for i in range(400)]
    prose = lambda n: " ".join(rng.choice(word) for _ in range(n))
    items = [(i, prose(rng.randrange(12, 50))) for i in range(12)]
    items += [(12, "too short"), (13, None), (14, ""), (None, prose(20)), (15, "the same words again here " * 30)]
    items.append(items[3])
    rows = [(0, None), (1, ""), (2, prose(300)), (None, items[0][1]), (3, prose(50) + " " + items[1][1] + "\n" + prose(9))]
    parts = words_of(items[2][1])
    half = len(parts) // 2
    rows.append((4, prose(20) + " " + " ".join(parts[half:]) + " " + prose(30) + " " + " ".join(parts[:half])))
    rows.append((5, prose(20) + " " + " ".join(parts[: len(parts) // 2]) + " " + prose(20)))       # half of it
    rows.append((6, items[3][1].upper().replace(" ", ", ") + "!"))
    rows.append((7, prose(60_000) + " " + items[4][1] + " " + prose(60_000)))                        # long
    rows.append((8, " ".join(w if i != 6 else "xx" for i, w in enumerate(words_of(items[5][1])))))
    rows.append((9, "the same words again here " * 3000))
    rows.append((3, rows[4][1]))
    docs = spark.createDataFrame([(a, t, "x", 1) for a, t in rows],
                                 "doc_id long, text string, item_id string, coverage int")
    return rows, items, docs, spark.createDataFrame(items, "item_id long, text string")


def by_hand(rows, items) -> list:
    out = []
    for d, text in rows:
        doc = words_of(text)
        for i, item in items:
            item = words_of(item)
            if len(item) < 5:
                continue
            grams = {tuple(item[k:k + 5]) for k in range(len(item) - 4)}
            near = sorted({p for k in range(len(doc) - 4) if tuple(doc[k:k + 5]) in grams for p in range(k, k + 5)})
            if not near:
                continue
            if d == 9 or len(near) > 500:      # every word repeats: one tile covers the item
                covered = len(item)
            else:
                covered = sum(tiles_by_hand(item, [doc[p] if p in near else None for p in range(near[0], near[-1] + 1)], 5))
            if covered >= 0.8 * len(item):
                out.append((d, i, len(item), covered))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [8_000_000, 300])
def test_contained_items_against_brute_force(tables, block_bytes):
    rows, items, docs, benchmark = tables
    got = dc.contained_items(docs, benchmark, ["doc_id"], block_bytes=block_bytes).collect()
    want = by_hand(rows, items)
    assert sorted([(r.doc_id, r.item_id, r.item_words, r.covered_words) for r in got], key=repr) == want
    assert {(r.doc_id, r.item_id) for r in got} >= {(3, 1), (4, 2), (6, 3), (7, 4), (9, 15), (None, 0)}
    assert 5 not in {r.doc_id for r in got} and 2 not in {r.doc_id for r in got}


def test_decontaminated_keeps_the_rest(tables):
    rows, items, docs, benchmark = tables
    out = dc.decontaminated(docs, benchmark, block_bytes=300)
    assert out.columns == docs.columns
    bad = {d for d, *_ in by_hand(rows, items)}
    assert sorted(repr(r.doc_id) for r in out.collect()) == sorted(repr(d) for d, _ in rows if d not in bad)


def test_empty_tables(spark, tables):
    _, _, docs, benchmark = tables
    none, no_item = docs.limit(0), benchmark.limit(0)
    assert dc.contained_items(none, benchmark, ["doc_id"]).count() == 0
    assert dc.contained_items(docs, no_item, ["doc_id"]).count() == 0
    assert dc.decontaminated(docs, no_item).count() == docs.count()
