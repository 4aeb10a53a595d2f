"""Token counts next to the library of the vocabulary, text by text."""

import random

import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

import public_tokenizers
from halfhourly.llm import tokencounts
from halfhourly.llm.queries import PIECES, QUERIES

PATH = public_tokenizers.path(PIECES)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def library(texts):
    return [len(ids) for ids in LIBRARY.encode(texts, num_threads=1)]


@pytest.fixture(scope="module")
def counter():
    return tokencounts.Counter(PATH)


CASES = ["", " ", "a", " a", "  a  ", "\n", "a\n\nb", " " * 14, " " * 15, " " * 16, " " * 17, " " * 300 + "x",
         "▁", "▁▁a ▁b", "<s> x </s>", "<unk><pad>", "\x00a\x00", "é", "é", "😀 日本語", "﻿x", "\t\t\r\n",
         "aaaaaaaaaaa", "abababababa", "thethethe" * 90, "a b" * 3000, "<0x0A>", " x　y", "ﬁ ½ ①"]


def test_odd_texts(counter):
    assert counter.counts(CASES) == library(CASES)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=80), max_size=8))
def test_any_text(texts):
    assert tokencounts.counter(PATH).counts(texts) == library(texts)


def test_texts_made_of_pieces(counter):
    draw = random.Random(7)
    pieces = [LIBRARY.id_to_piece(i) for i in range(259, 32000)]
    texts = ["".join(draw.choices(pieces, k=draw.randint(1, 40))) for _ in range(400)]
    texts += ["".join(draw.choices("etaoinsh01+/", k=draw.randint(1, 900))) for _ in range(100)]
    assert counter.counts(texts) == library(texts)


def test_the_index_takes_the_same_merges_as_the_rounds(counter):
    draw = random.Random(8)
    words = ["".join(draw.choices("etaoins▁日a", k=draw.randint(2, 200))) for _ in range(200)]
    rounds = tokencounts.merged_counts(counter.vocabulary, words).tolist()
    assert rounds == [tokencounts.merged_count(counter.vocabulary, w) for w in words]


def test_counts_that_are_kept_do_not_change_results(counter, monkeypatch):
    monkeypatch.setattr(tokencounts, "KNOWN", 50)
    monkeypatch.setattr(tokencounts, "_CHARS_AT_ONCE", 200)
    texts = [" ".join(f"word{k * j % 97}" for j in range(60)) for k in range(20)]
    assert tokencounts.Counter(PATH).counts(texts) == library(texts)


def test_one_very_long_text_and_one_very_long_word(counter):
    draw = random.Random(9)
    texts = ["some words, then more " * 120_000, "".join(draw.choices("etaoinshrdlu/+9", k=200_000)), " " * 50_000]
    assert counter.counts(texts) == library(texts)


def test_rows_of_a_table(spark):
    """Nulls, repeated rows, null ids, bytes that are no UTF-8 and columns with clashing names."""
    rows = [(1, "two words", 5), (1, "two words", 5), (None, "x", 6), (3, None, 7), (4, "", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    found = tokencounts.token_counts(docs, PATH, ["doc_id"], limit=1)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [(1, 9, 2, True), (1, 9, 2, True), (None, 1, 1, False), (3, 0, 0, False), (4, 0, 0, False)], key=repr)
    broken = spark.sql("SELECT 1L doc_id, CAST(X'61FF62' AS STRING) text")
    assert [tuple(r) for r in tokencounts.token_counts(broken, PATH, ["doc_id"]).collect()] == [
        (1, 3, library(["a�b"])[0], False)]
    assert tokencounts.token_counts(docs.limit(0), PATH, ["doc_id"]).count() == 0


def test_the_query_counts_every_document_as_the_library_does(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in QUERIES["op12_token_counts"](spark, sf).collect()}
    assert len(found) == len(docs)
    for row, n in zip(docs, library([d.text or "" for d in docs])):
        got = found[row.doc_id]
        assert (got.n_bytes, got.n_tokens, got.over_limit) == (len((row.text or "").encode()), n, n > 4096)
