"""Packing: exact round trips, the rule of the sum of squares, and little padding."""
import random
import zlib

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from halfhourly.llm import packing
from halfhourly.llm.packing import Packer

FILE = path("byte_bpe_50k.json")


def ids_of(text: str) -> np.ndarray:
    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return np.array(t.encode(text, add_special_tokens=False).ids + [1], dtype="<u4")


def test_encoder_equals_the_tokenizer():
    rng = random.Random(1)
    parts = ["the", "don't", " we'LL", "\n\n", "  x", "\t", "été", "123", "١٢", "²", "a\x1cb", " ", "—", "…!",
             "<|endoftext|>", "日本", "𝒳", " ", " ", "$#%", "Ⅷ", "ß", "'s", "é", "a\x85b", "﻿", "\x0b \x0c"]
    encode = packing.encoder(FILE).encode
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(400)]
    for text, ids in zip(texts, encode(texts), strict=True):
        assert ids + b"\1\0\0\0" == ids_of(text).tobytes(), repr(text)


def squares(levels, window):
    return sum(int(v) ** 2 for v in levels[1:window])


def test_level_makes_the_sum_of_squares_smallest():
    rng = random.Random(6)
    packer = Packer(32)
    for k in range(600):
        size = rng.randrange(1, 32)
        best = []
        for h in range(0, 32 - size + 1):
            if h and not packer.levels[h]:
                continue
            after = packer.levels.copy()
            after[h] -= h > 0
            after[h + size] += h + size < 32
            best.append((squares(after, 32), -h))
        assert packer.level_for(size) == -min(best)[1]
        packer.add((k,), b"\0" * 4 * size)
        assert packer.levels.tolist() == [len(packer.open[h]) if h < 32 else 0 for h in range(33)]


@pytest.mark.parametrize("max_open", [3, 4096])
def test_every_id_is_placed_once(max_open):
    rng = random.Random(max_open)
    packer, sizes, sequences = Packer(64, max_open), {}, []
    for k in range(500):
        sizes[k] = rng.choice([1, 33, 40, 64, rng.randrange(1, 300)])
        packer.add((k,), np.arange(sizes[k], dtype="<u4").tobytes())
        assert packer.n_open <= max_open
        sequences += packer.take()
    packer.finish()
    sequences += packer.take()
    seen: dict = {}
    for pieces in sequences:
        total = 0
        for (doc,), start, ids, size in pieces:
            got = np.frombuffer(ids, "<u4")
            assert size == sizes[doc] and got.tolist() == list(range(start, start + len(got))) and len(got)
            seen.setdefault(doc, []).extend(got.tolist())
            total += len(got)
        assert total == 64 or total & (total - 1) == 0 and total < 64
    assert {d: sorted(v) for d, v in seen.items()} == {d: list(range(n)) for d, n in sizes.items()}


def test_packed_table(spark):
    rng = random.Random(9)
    rows = [(0, None), (1, ""), (2, "one"), (None, "no id"), (2, "one"), (3, "word " * 30_000)]
    rows += [(k, " ".join(rng.choice(["alpha", "étude", "x1", "日本"]) for _ in range(rng.randrange(1, 900))))
             for k in range(10, 90)]
    docs = spark.createDataFrame([(a, t, 0) for a, t in rows], "doc_id long, text string, offset int").repartition(3)
    got = packing.packed(docs, FILE, ["doc_id"]).collect()
    ids = {a: ids_of(t or "") for a, t in rows}
    pieces: dict = {}
    for r in got:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(part.tobytes()) and len(part) == r.length > 0
        assert r.doc_tokens == len(ids[r.doc_id])
        pieces.setdefault(r.doc_id, []).extend(range(r.start, r.start + r.length))
    times = {a: sum(1 for b, _ in rows if b == a) for a, _ in rows}
    assert {a: sorted(v) for a, v in pieces.items()} == \
        {a: sorted(list(range(len(ids[a]))) * times[a]) for a in ids}
    sequences: dict = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        total = sum(n for _, n in parts)
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()
        assert total == 2048 or total & (total - 1) == 0
    assert packing.packed(docs.limit(0), FILE, ["doc_id"]).count() == 0


def test_special_tokens_are_their_own_ids(spark):
    plain = Tokenizer.from_file(FILE)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "été<|endoftext|><|endoftext|>日本", "<|endoftext|", "word " * 3000 + "<|endoftext|>x"]
    want = [np.array(plain.encode(t, add_special_tokens=False).ids + [1], dtype="<u4") for t in texts]
    assert want[0].tolist() == [64, 220, 50256, 275, 1]
    got = packing.packed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), FILE, ["doc_id"]).collect()
    for r in got:
        part = want[r.doc_id][r.start:r.start + r.length]
        assert r.doc_tokens == len(want[r.doc_id]) and r.ids_crc32 == zlib.crc32(part.tobytes())
    assert {d: sum(r.length for r in got if r.doc_id == d) for d in range(5)} == {d: len(w) for d, w in enumerate(want)}
