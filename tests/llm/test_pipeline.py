"""The pipeline against a plain version of its stages, and each stage's promises."""
import random
import zlib

import pytest

import corpus_pipeline
import test_decontamination as tiling
import test_packing as packing
import test_quality as quality
import test_secrets as secrets
import test_simhash as simhash


def prose(rng, n_lines):
    word = ["the", "river", "stone", "éa", "runs", "over", "cold", "green", "fields", "and", "hills"]
    return "\n".join(" ".join(rng.choice(word) + rng.choice(["", "s", "ly", str(rng.randrange(90))])
                              for _ in range(rng.randrange(6, 14))) + "." for _ in range(n_lines))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    items = [(i, " ".join(f"q{rng.randrange(500)}" for _ in range(24)) + ".") for i in range(4)]
    rows = [(i, prose(rng, rng.randrange(3, 9)), "en") for i in range(40)]
    rows += [(100 + i, rows[i][1] + ("\nHome | News | Sport | About" if i % 2 else ""), "fr") for i in range(6)]
    rows += [(200, None, "en"), (201, "", None), (202, "too short.", "en"), (203, "junk ### $$$ line\n" * 30, "en"),
             (204, prose(rng, 3) + "\n" + items[1][1] + "\n" + prose(rng, 2), "de"),
             (205, prose(rng, 4) + "\ntoken = \"" + "%040x" % rng.getrandbits(160) + "\" ends here.\n" + prose(rng, 2), "en"),
             (206, prose(rng, 900), "en"), (206, rows[3][1], "en"), (None, prose(rng, 5), "en")]
    place = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(a, t, c, "src", len(t or "")) for a, t, c in rows],
                          "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    return place, rows, items


def plain(rows, items) -> list:
    """(doc_id, text) that reach the packing stage."""
    docs = []
    for a, t, _ in rows:
        *_, kept, text = quality.by_hand(t)
        if kept:
            docs.append((a, text))
    groups: dict = {}
    for k, (a, t) in enumerate(docs):
        groups.setdefault(simhash.by_hand(t), []).append((a is None, a or 0, k))
    docs = [docs[k] for _, _, k in sorted(set(simhash.roots_by_hand(groups).values()))]
    bad = {d for d, *_ in tiling.by_hand(docs, items)}
    docs = [d for d in docs if d[0] not in bad]
    out = []
    for a, t in docs:
        for k, x, y in reversed(secrets.base_by_hand(t)):
            if k == "assign":
                t = t[:x] + "[secret]" + t[y:]
        out.append((a, t))
    return out


def test_pipeline(spark, folder):
    place, rows, items = folder
    want = plain(rows, items)
    assert 20 < len(want) < len(rows) - 8 and 204 not in {a for a, _ in want}
    ids = {a: packing.ids_of(t) for a, t in want}
    got: dict = {}
    for r in corpus_pipeline.run(spark, place).collect():
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes())
        got.setdefault(r.doc_id, []).extend(range(r.start, r.start + r.length))
    assert {a: sorted(v) for a, v in got.items()} == {a: list(range(len(v))) for a, v in ids.items()}


def test_stages_keep_the_columns(spark, folder):
    place, *_ = folder
    docs = spark.read.parquet(f"{place}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, place)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert stage(spark, docs.limit(0), place).count() == 0
