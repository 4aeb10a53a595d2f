"""Sharding: even sizes, gapless slots, groups kept together."""
import random
import zlib
from collections import Counter, defaultdict

import pytest

from halfhourly.llm import sharding


def documents(spark, rows):
    return spark.createDataFrame([(a, t, 5, "x") for a, t in rows], "doc_id long, text string, shard int, slot string")


def check(got, rows, n_shards):
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id is not None) == sorted(
        (a, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for a, t in rows if a is not None)
    counts = Counter(r.shard for r in got)
    assert set(counts) <= set(range(n_shards))
    sizes = [counts[s] for s in range(n_shards)]
    assert max(sizes) - min(sizes) <= 1 and len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert {r.law for r in got} <= {"rows"}


def test_groups_stay_together(spark):
    rng = random.Random(2)
    rows = [(i, f"text {i}") for i in range(800)]
    for g in range(120):
        rows += [(1000 + 10 * g + k, f"group {g} é") for k in range(rng.randrange(2, 9))]
    rows += [(None, None), (5000, ""), (5000, ""), (None, "no id")]
    rng.shuffle(rows)
    got = sharding.sharded_by_text(documents(spark, rows), ["doc_id"], n_shards=8).collect()
    check(got, rows, 8)
    spread = defaultdict(set)
    for r in got:
        spread[r.text_crc32].add(r.shard)
    assert sum(len(v) - 1 for v in spread.values()) <= 6


def test_a_group_larger_than_a_shard_is_dealt_out(spark):
    rows = [(i, "the same") for i in range(500)] + [(1000 + i, f"t{i // 2}") for i in range(900)]
    got = sharding.sharded_by_text(documents(spark, rows), ["doc_id"], n_shards=16, rounds=10).collect()
    check(got, rows, 16)
    spread = defaultdict(set)
    for r in got:
        spread[r.text_crc32].add(r.shard)
    pairs = [v for c, v in spread.items() if c != zlib.crc32(b"the same")]
    assert len(pairs) == 450 and sum(len(v) == 2 for v in pairs) <= 67


def test_links_of_a_graph(spark):
    """Rows with several links: rings of ten rows, each edge a link of two."""
    rows = spark.range(600).select(sharding.F.col("id").alias("row"))
    edges = [(g * 10 + k, f"{g}-{k}") for g in range(60) for k in range(10)]
    edges += [(g * 10 + (k + 1) % 10, f"{g}-{k}") for g in range(60) for k in range(10)]
    links = spark.createDataFrame(edges, "row long, link string")
    got = {r.row: r.shard for r in sharding.propagated(rows, links, 4, rounds=10).collect()}
    assert len(got) == 600
    start = {r.row: r.s for r in rows.select("row", sharding.F.pmod(sharding.F.xxhash64("row"), sharding.F.lit(4))
                                             .alias("s")).collect()}
    ends = defaultdict(list)
    for row, link in edges:
        ends[link].append(row)
    cut = lambda shard: sum(shard[a] != shard[b] for a, b in ends.values())
    assert cut(got) < 0.7 * cut(start)
    assert max(Counter(got.values()).values()) <= 1.15 * 150


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_rows(spark, n):
    rows = [(i, "x") for i in range(n)]
    got = sharding.sharded_by_text(documents(spark, rows), ["doc_id"], n_shards=16).collect()
    check(got, rows, 16)


def test_quotas_hold_the_capacity():
    shares = sharding._quotas({(0, 1): 100, (1, 0): 40, (2, 1): 60}, {0: 100, 1: 90, 2: 100}, 110)
    arriving = 100 * shares[0, 1] + 60 * shares[2, 1]
    assert shares[1, 0] == 1 and abs(arriving - 40 - 20) < 1e-9
