"""SimHash near-duplicates against brute force."""
import random

import numpy as np
import pytest
import xxhash

from halfhourly.llm import simhash


def by_hand(text: str | None, k: int = 3) -> int:
    words = [w for w in (text or "").translate(
        {c: chr(c + 32) for c in range(65, 91)}).replace("\t", " ").replace("\n", " ")
        .replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_by_hand(prints: dict) -> dict:
    parent = {p: p for p in prints}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    order = sorted(prints)
    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    lows: dict = {}
    for p, ids in prints.items():
        lows.setdefault(find(p), []).extend(ids)
    return {p: min(lows[find(p)]) for p in prints}


def test_anchor_of_a_near_value_is_always_in_reach():
    rng = random.Random(3)
    values = [rng.getrandbits(64) for _ in range(300)]
    for flips in (0, 1, 2):
        moved = []
        for v in values:
            for b in rng.sample(range(64), flips):
                v ^= 1 << b
            moved.append(v)
        row, anchor, home = simhash.anchors(np.array(values, dtype="<u8").view("<i8"))
        homes = dict(zip(row[home].tolist(), anchor[home].tolist()))
        assert len(homes) == len(values)
        row, anchor, _ = simhash.anchors(np.array(moved, dtype="<u8").view("<i8"))
        reached = set(zip(row.tolist(), anchor.tolist()))
        assert len(reached) == len(row)
        assert all((i, homes[i]) in reached for i in homes)


def test_golay_code_is_perfect():
    to, cost = simhash._reach(0)
    assert to.shape == (2048, 1) and len(set(to[:, 0].tolist())) == 2048
    assert max(int(m).bit_count() for m in to[:, 0]) == 3 and (cost == 0).all()


def test_links_of_a_dense_group(spark):
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    values = {centre}
    while len(values) < 300:
        v = centre
        for b in rng.sample(range(64), rng.randrange(1, 4)):
            v ^= 1 << b
        values.add(v)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame(signed, "fingerprint long")).collect()}
    plain = [s[0] for s in signed]
    want = {(min(a, b), max(a, b)) for i, a in enumerate(plain) for b in plain[i + 1:]
            if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2}
    assert got == want


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 2000)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert all(got.get(i, 0) == 0 for i in range(201)) and got[2000] == 1000


@pytest.fixture
def docs(spark):
    rng = random.Random(1)
    word = ["alpha", "Beta", "gamma", "delta", "İx", "été"]
    rows = [(0, None, 1), (1, "", 1), (2, " \n\t", 1), (3, "One", 1), (4, "one  ", 1), (5, "one two", 1),
            (6, "ONE\ttwo three", 1), (None, "null id here now", 1), (None, None, 1), (6, "one two three", 1)]
    for i in range(20, 50):
        rows.append((i, " ".join(rng.choice(word) for _ in range(60)), 2))
    long = " ".join(rng.choice(word) + str(rng.randrange(9999)) for _ in range(200_000))
    rows += [(60, long, 3), (61, long + " end", 3), (62, long, 3), (62, long, 3)]
    # columns that share names with the results
    return spark.createDataFrame(rows, "doc_id long, text string, component_id int")


def test_components_against_brute_force(spark, docs):
    got = simhash.simhash_components(docs).collect()
    rows = docs.collect()
    prints = [by_hand(r.text) for r in rows]
    ids: dict = {}
    for r, p in zip(rows, prints):
        ids.setdefault(p, []).append(r.doc_id if r.doc_id is not None else 10**9)
    lows = roots_by_hand(ids)
    low = {p: None if v == 10**9 else v for p, v in lows.items()}
    want = sorted((repr(r.doc_id), p, low[p]) for r, p in zip(rows, prints))
    assert sorted((repr(g.doc_id), g.fingerprint & (1 << 64) - 1, g.component_id) for g in got) == want


def test_one_row_of_each_component_stays(spark, docs):
    kept = simhash.simhash_distinct(docs)
    assert kept.columns == docs.columns
    rows = docs.collect()
    ids: dict = {}
    for i, r in enumerate(rows):
        ids.setdefault(by_hand(r.text), []).append((r.doc_id is None, r.doc_id or 0, i))
    lows = roots_by_hand(ids)
    want = sorted(repr(rows[i].doc_id) for _, _, i in set(lows.values()))
    assert sorted(repr(r.doc_id) for r in kept.collect()) == want


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_components(empty).count() == 0
    assert simhash.simhash_distinct(empty).count() == 0
