"""A string column may hold bytes that are no UTF-8: no operator fails, and the bytes count as U+FFFD."""

import pytest
from public_tokenizers import path

from halfhourly.llm import decontamination, licenses, packing, quality, secrets, simhash
from halfhourly.llm.common import decoded


@pytest.fixture(scope="module")
def docs(spark):
    return spark.sql("""SELECT id doc_id, CAST(concat(X'FF', CAST(repeat('some words here, ', 9) AS BINARY), X'C328E2')
                        AS STRING) text, 150L n_chars FROM range(3)""")


def test_one_rule():
    assert decoded(b"a\xffb\xc3(") == "a�b�("


def test_secrets(docs):
    cells = secrets.fit(docs)
    assert secrets.found_secrets(docs, ["doc_id"], cells).count() == 3
    assert {r.text[0] for r in secrets.without_secrets(docs, cells).collect()} == {"�"}


def test_packing(docs):
    rows = packing.packed(docs, path("byte_bpe_50k.json"), ["doc_id"]).collect()
    text = decoded(b"\xff" + b"some words here, " * 9 + b"\xc3(\xe2")
    from tokenizers import Tokenizer
    ids = Tokenizer.from_file(path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids
    assert {r.doc_tokens for r in rows} == {len(ids) + 1}


def test_licenses_and_decontamination(docs):
    assert licenses.found_licenses(docs, ["doc_id"]).count() == 0
    items = docs.selectExpr("doc_id AS item_id", "text").limit(1)
    assert decontamination.contained_items(docs, items, ["doc_id"]).count() == 3
    assert decontamination.decontaminated(docs, items).count() == 0


def test_native_operators(docs):
    assert quality.clean(docs).count() <= 3
    assert simhash.simhash_distinct(docs, shingle=3, max_bits=2).count() == 1
