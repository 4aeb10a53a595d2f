"""Forward-backward against brute force, and held-out accuracy on made-up mixed texts."""
import itertools
import random
import zlib

import numpy as np
import pytest

from halfhourly.llm import language


def by_hand(scores, transitions, start):
    n, k = scores.shape
    out, pairs, total = np.zeros((n, k)), np.zeros((k, k)), 0.0
    for path in itertools.product(range(k), repeat=n):
        s = start[path[0]] + sum(scores[i, y] for i, y in enumerate(path))
        s = np.exp(s + sum(transitions[a, b] for a, b in zip(path, path[1:])))
        total += s
        for i, y in enumerate(path):
            out[i, y] += s
        for a, b in zip(path, path[1:]):
            pairs[a, b] += s
    return out / total, pairs / total


@pytest.mark.parametrize("block", [1, 2, 3, 32])
def test_forward_backward_is_exact(monkeypatch, block):
    monkeypatch.setattr(language, "BLOCK", block)
    monkeypatch.setattr(language, "_BLOCKS_AT_ONCE", 3)
    rng = np.random.default_rng(2)
    sizes = np.array([1, 6, 0, 3, 7, 2, 5, 1])
    scores, t, s = rng.normal(size=(sizes.sum(), 3)) * 2, rng.normal(size=(3, 3)), rng.normal(size=3)
    got, steps = language.forward_backward(scores, sizes, t, s, pairs=True)
    at, want = 0, np.zeros((3, 3))
    for n in sizes:
        if n:
            p, pairs = by_hand(scores[at:at + n], t, s)
            assert np.allclose(got[at:at + n], p, atol=1e-9)
            want += pairs
            at += n
    assert np.allclose(steps, want, atol=1e-9)


def test_long_texts_stay_finite():
    scores = np.random.default_rng(1).normal(size=(200_000, 4)) * 30
    p = language.forward_backward(scores, np.array([199_999, 1]), np.eye(4) * 5, np.zeros(4))
    assert np.isfinite(p).all() and np.allclose(p.sum(axis=1), 1)


SOUNDS = {"aa": ["ka", "to", "mi", "ra"], "bb": ["sch", "ung", "ein", "er"], "cc": ["eau", "oi", "elle", "é"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(2, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(5)
    rows = []
    for i in range(600):
        lang = rng.choice(list(SOUNDS))
        text = prose(rng, lang, rng.randrange(5, 60))
        if i % 9 == 0:                                           # switched code, mostly the text's language
            other = rng.choice([x for x in SOUNDS if x != lang])
            text = prose(rng, lang, 40) + " " + prose(rng, other, 12) + ". " + prose(rng, lang, 10)
        rows.append((i, text, lang if i % 11 else None, lang, 0.0))
    rows += [(None, prose(rng, "aa", 9), "aa", "aa", 0.0), (900, None, "bb", "und", 0.0), (901, "", None, "und", 0.0),
             (902, "12 _ ... 7", "cc", "und", 0.0), (902, "12 _ ... 7", "cc", "und", 0.0),
             (903, prose(rng, "cc", 60_000), None, "cc", 0.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double")


def test_held_out_accuracy(docs):
    model = language.fit(docs)
    assert model.languages == ("aa", "bb", "cc")
    assert np.diag(model.transitions).min() > (model.transitions.sum() - np.trace(model.transitions)) / 6
    truth = sorted((repr(r.doc_id), r.lang_pred) for r in docs.collect())
    got = language.predicted(docs, model).collect()
    assert len(got) == len(truth)
    assert np.mean([a == b for a, b in zip(truth, sorted((repr(r.doc_id), r.lang_pred) for r in got))]) > 0.99
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and (r.lang_pred != "und" or r.score == 0)
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {900, 901, 902}


def test_words_of_a_switched_text(docs):
    rng = random.Random(8)
    model = language.fit(docs)
    words = (prose(rng, "bb", 20) + " " + prose(rng, "cc", 15)).split()
    p = language.Tagger(model).marginals([words, []])
    assert (p[:20].argmax(axis=1) == 1).mean() >= 0.9 and (p[20:].argmax(axis=1) == 2).mean() >= 0.9


def test_nothing_to_learn_from(spark, docs):
    model = language.fit(docs.limit(0))
    assert {r.lang_pred for r in language.predicted(docs.limit(20), model).collect()} == {"und"}
    one = language.fit(docs.where("lang = 'aa'"))
    assert {r.lang_pred for r in language.predicted(docs.where("doc_id < 30"), one).collect()} == {"aa"}
    assert language.predicted(docs.limit(0), model).count() == 0


def test_signs_that_are_no_letters(spark):
    docs = spark.createDataFrame([(1, "½ ² ①"), (2, "Ⅷ a"), (3, "٣ 12 _")], "doc_id long, text string")
    model = language.Model(("x", "y"), {}, np.zeros((1 << language._BITS, 2)), 1.0, np.zeros((2, 2)), np.zeros(2))
    found = {r.doc_id: r.lang_pred for r in language.predicted(docs, model).collect()}
    assert found[1] == found[3] == "und" and found[2] != "und"
    broken = spark.sql("SELECT 1L doc_id, CAST(X'61FF62' AS STRING) text")
    assert [r.lang_pred != "und" for r in language.predicted(broken, model).collect()] == [True]


def test_what_of_a_text_is_learnt():
    assert language._taught(["one two three"]) == [["one", "two", "three"]]
    assert language._taught(["ab cd e", "f gh ij k", "l mn op"]) == [["ab", "cd"], ["gh", "ij"], ["mn", "op"]]
    many = language._taught([" ".join(["word"] * 60)])
    assert [len(m) for m in many] == [24, 24, 12]


def test_languages_of_short_texts_are_learnt(spark):
    rows = [(i, t, l) for i in range(400) for t, l in [(("hello there", "en") if i % 2 else ("guten tag", "de"))]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.predicted(docs, language.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.where("lang_pred <> lang").count() == 0
