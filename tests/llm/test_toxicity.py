"""The automata against plain edit distances, contexts, and held-out accuracy on made-up texts."""
import random
import zlib

import numpy as np
import pytest

from halfhourly.llm import toxicity as tox


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_nearest_term_against_edit_distances():
    rng = random.Random(1)
    terms = sorted({"".join(rng.choice("abcé") for _ in range(rng.randrange(1, 9))) for _ in range(60)})
    trie = tox.Trie(terms)
    for _ in range(500):
        word = "".join(rng.choice("abcéd") for _ in range(rng.randrange(0, 10)))
        for edits in (0, 1, 2):
            best = min((distance(word, t), t) for t in terms)
            assert trie.nearest(word, edits) == (best if best[0] <= edits else None), (word, edits)
    assert tox.Trie([]).nearest("word", 2) is None


def test_contexts_separate_quotation_from_abuse():
    scorer = tox.Scorer({"blockhead": 6.0, "fool": 5.0})
    plain = scorer.sums("The man is a blockhead.")
    assert plain[0] > 1.9 and plain[1] == 0 and plain[2] < 0.2
    assert scorer.sums("You are a blockhead.")[0] > plain[0]
    quoted = scorer.sums('He wrote the word "blockhead" on a page.')
    assert quoted[0] < 0.5 < quoted[2]
    assert scorer.sums('"Quiet!" The blockhead left.')[0] == pytest.approx(plain[0])
    fuzzy = scorer.sums("a bl0ckhed there")
    assert fuzzy[0] == 0 and fuzzy[1] > 1.4
    assert scorer.sums("foal")[1] == 0  # too short for an edit
    assert scorer.sums("") == (0.0, 0.0, 0.0)
    assert tox.Scorer({"blockhead": 6.0}, frozenset(["blockheads"])).sums("blockheads")[1] == 0


def prose(rng, n):
    return [rng.choice(["the", "river", "stone", "éa", "runs", "over", "cold", "green", "fields", "and", "hills"])
            + rng.choice(["", "s", "ly", "er"]) for _ in range(n)]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    bad = ["blockhead", "nitwit", "dunderhead", "scoundrel"]
    rows, labels = [], []
    for i in range(900):
        words, toxic = prose(rng, rng.randrange(20, 120)), i % 6 == 0
        if toxic:
            for _ in range(3):
                word = rng.choice(bad)
                if i > 700:                                     # misspelled in rows without labels only
                    at = rng.randrange(1, len(word))
                    word = word[:at] + "x" + word[at + 1:]
                words.insert(rng.randrange(len(words)), word)
        rows.append((i, " ".join(words), "y", 0.5))
        if i <= 700:
            labels.append((i, 1 if toxic else 0))
    same = " ".join(prose(rng, 50) + ["raresound", "otherrare"])
    for i in range(2000, 2040):                                 # copies of one toxic text count once
        rows.append((i, same, "y", 0.5))
        labels.append((i, 1))
    labels += [(None, 1), (3, None), (6, 1), (6, 0), (99999, 1)]
    rows += [(None, "You blockhead, nitwit!", "y", 0.5), (5000, None, "y", 0.5), (5001, "", "y", 0.5),
             (5001, "", "y", 0.5), (5002, " ".join(prose(rng, 100_000)) + " nitwit blockhead nitwit", "y", 0.5)]
    return (rows, spark.createDataFrame(rows, "doc_id long, text string, toxic string, score double"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_held_out_accuracy(tables):
    rows, docs, labels = tables
    model = tox.fit(docs, labels)
    assert set(model.weights) == {"blockhead", "nitwit", "dunderhead", "scoundrel"}
    got = tox.scored(docs, model).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    wrong = sum(by_id[i].predicted != (i % 6 == 0) for i in range(900) if i <= 700)
    misspelled = [by_id[i].predicted for i in range(702, 900) if i % 6 == 0]
    assert wrong == 0 and np.mean(misspelled) > 0.8
    assert by_id[None].predicted == 1 and by_id[5000].predicted == by_id[5001].predicted == 0
    assert by_id[5002].predicted == 1


def test_labels_of_one_kind_or_none(spark, tables):
    _, docs, labels = tables
    for some in (labels.limit(0), labels.where("toxic = 0")):
        model = tox.fit(docs, some)
        scores = {r.score for r in tox.scored(docs.limit(50), model).collect()}
        assert len(scores) == 1 and 0 < scores.pop() <= 0.5
    assert tox.scored(docs.limit(0), model).count() == 0
    assert tox.labelled(docs, labels, "doc_id", "text", "toxic", max_rows=10).count() <= 10


def test_edits_go_by_the_terms_own_length():
    scorer = tox.Scorer({"dumb": 1.0, "dummy": 1.0, "idiotic": 2.0})
    assert scorer.near("dumby") == (1, "dummy") and scorer.near("dumb") == (0, "dumb")
    assert scorer.near("dumbs") is None and scorer.near("idiotik") == (1, "idiotic")


def test_only_near_copies_leave_the_word_counts(spark):
    """Texts that share a long passage and differ in the rest are all counted; copies and near copies once."""
    common = " ".join(f"passage{k}" for k in range(12))
    rows = [(1, f"{common} " + " ".join(f"own{i}x{k}" for k in range(12))) for i in range(6)]
    long = [f"long{k}" for k in range(60)]
    rows += [(0, " ".join(long)), (0, " ".join(long)), (0, " ".join(long[:-1] + ["other"]))]
    docs = spark.createDataFrame(rows, "label int, text string")
    words = tox._different_words(docs).collect()
    assert sum(r.label == 1 for r in words) == 6 and sum(r.label == 0 for r in words) == 1


def test_bytes_that_are_no_text(spark):
    docs = spark.sql("SELECT 1L doc_id, CAST(X'61FF62' AS STRING) text")
    model = tox.Model({"dumb": 1.0}, frozenset(), (-1.0, 1.0, 1.0, 1.0))
    assert tox.scored(docs, model).count() == 1
