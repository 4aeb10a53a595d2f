"""License statements planted in prose, with and without changes."""
import random

import pytest

from halfhourly.llm import licenses

SCAN = licenses.Scanner(licenses.TEMPLATES)
BY_NAME = dict(licenses.TEMPLATES)


@pytest.mark.parametrize("name", list(BY_NAME))
def test_each_template_is_found_where_it_stands(name):
    for before, after in (("", ""), ("Ä line before.\n", "\nAnd after."), ("Some prose here. ", " More prose."),
                          ("Our software is new.\n\n", "\n\nCopyright by us all.")):
        text = before + BY_NAME[name] + after
        found = SCAN.find(text)
        assert [(f.license, f.start, f.end) for f in found] == [(name, len(before), len(before) + len(BY_NAME[name]))]
        assert found[0].similarity == 1 and found[0].missing == "" and found[0].with_bytes < found[0].alone_bytes


def test_differences_in_wording():
    (f,) = SCAN.find("x.\nThis fine work is licenced under the GNU General Public License, version 3.\ny")
    assert f.license == "GPL-3.0" and f.missing == "licensed" and f.extra == "fine licenced"
    assert [f.license for f in SCAN.find("RELEASED under the MIT license!")] == ["MIT"]
    assert not SCAN.find("This work is licensed under the GNU General Public License, version 7.")
    assert not SCAN.find("Licensed under CC BY-XX 4.0.") and not SCAN.find("The license was under the table.")
    wrapped = BY_NAME["MIT-text"].replace(" copy of", "\ncopy of").replace(" without limitation", "\nwithout limitation")
    assert [f.license for f in SCAN.find("Intro.\n" + wrapped)] == ["MIT-text"]


def test_several_in_one_block():
    text = "\n".join([BY_NAME["MIT"], BY_NAME["CC-BY-NC-4.0"], "Between.", BY_NAME["Apache-2.0"], BY_NAME["MIT"]])
    found = SCAN.find(text)
    assert [f.license for f in found] == ["MIT", "CC-BY-NC-4.0", "Apache-2.0", "MIT"]
    assert all(text[f.start:f.end] == BY_NAME[f.license] for f in found)


def test_long_texts_of_cues():
    assert SCAN.find("license software warranty " * 40_000) == []
    text = "permission license " * 20_000 + ". " + BY_NAME["GPL-2.0"]
    assert [(f.license, text[f.start:f.end]) for f in SCAN.find(text)] == [("GPL-2.0", BY_NAME["GPL-2.0"])]


def test_many_statements_in_one_text():
    text = "\n".join([BY_NAME["MIT"], BY_NAME["GPL-3.0"]] * 3000)
    found = SCAN.find(text)
    assert len(found) == 6000 and {f.similarity for f in found} == {1.0}


def test_table(spark):
    rng = random.Random(3)
    prose = lambda: "\n".join(" ".join(rng.choice(["the", "rivér", "ran"]) for _ in range(9)) + "." for _ in range(4))
    rows, want = [(None, BY_NAME["MIT"]), (1, None), (2, ""), (2, "")], [(None, "MIT", 0)]
    for i in range(10, 60):
        text = prose()
        if i % 3 == 0:
            name = rng.choice(list(BY_NAME))
            text += "\n"
            want.append((i, name, len(text)))
            text += BY_NAME[name] + "\n" + prose()
        rows.append((i, text))
    docs = spark.createDataFrame([(a, t, 1, "x") for a, t in rows], "doc_id long, text string, start int, license string")
    got = licenses.found_licenses(docs, ["doc_id"]).collect()
    assert sorted([(r.doc_id, r.license, r.start) for r in got], key=repr) == sorted(want, key=repr)
    assert licenses.found_licenses(docs, ["doc_id"], templates=()).count() == 0
    assert licenses.found_licenses(docs.limit(0), ["doc_id"]).count() == 0


@pytest.mark.parametrize("size", [20_000, 100_000, 5_000_000])
def test_statements_in_long_blocks_that_do_not_repeat(size):
    rng = random.Random(size)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 9))) for _ in range(2000)]
    prose, total = [], 0
    while total < size:
        prose.append(" ".join(vocabulary[int(2000 * rng.random() ** 3)] for _ in range(9)) + " the software.")
        total += len(prose[-1]) + 1
    names = ["CC-BY-4.0", "MIT", "GPL-3.0", "Apache-2.0-text", "MIT-text"]
    for k, name in enumerate(names[1:], 1):
        prose.insert(len(prose) * k // len(names), BY_NAME[name])
    text = " ".join([*prose, BY_NAME[names[0]]])
    found = SCAN.find(text)
    assert [(f.license, text[f.start:f.end]) for f in found] == [(n, BY_NAME[n]) for n in [*names[1:], names[0]]]


def test_a_statement_is_whole_wherever_its_block_is_cut():
    for before in range(480, 620):
        text = "the software " * (before // 2) + "x " * (before % 2) + BY_NAME["MIT-text"] + " the software" * 600
        (f,) = SCAN.find(text)
        assert (f.license, text[f.start:f.end], f.similarity) == ("MIT-text", BY_NAME["MIT-text"], 1), before


MIT_FILE = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
GPL_FILE = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
"""


@pytest.mark.parametrize("text, name", [
    (MIT_FILE, "MIT-full"), (GPL_FILE, "GPL-3.0-header"), (GPL_FILE.replace("General", "Affero General"), "AGPL-3.0-header"),
    (GPL_FILE.replace("General", "Lesser General"), "LGPL-3.0-header"), (GPL_FILE.replace("version 3", "version 2"), "GPL-2.0-header"),
    ("/* SPDX-License-Identifier: GPL-2.0-or-later */\nint main;", "SPDX:GPL-2.0-or-later"),
    ("// SPDX-License-Identifier: MIT OR Apache-2.0\n", "SPDX:MIT OR Apache-2.0"),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n", "GPL-3.0-title"),
    ("See below. This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.", "CC-BY-SA-3.0-text")])
def test_usual_forms(text, name):
    (f,) = SCAN.find("Intro.\n" + text)
    assert f.license == name and f.missing == ""


def test_words_in_order_bound_the_matches():
    import random
    from difflib import SequenceMatcher
    draw = random.Random(3)
    for template in licenses.Scanner(licenses.TEMPLATES).templates[:25]:
        for _ in range(20):
            words = draw.choices(template.lowered + ["other", None], k=draw.randrange(1, 2 * len(template.words) + 2))
            found = SequenceMatcher(None, words, template.lowered, autojunk=False).get_matching_blocks()
            table = [[0] * (len(template.lowered) + 1) for _ in range(len(words) + 1)]
            for i, w in enumerate(words):
                for j, t in enumerate(template.lowered):
                    table[i + 1][j + 1] = table[i][j] + 1 if w == t else max(table[i][j + 1], table[i + 1][j])
            assert template.in_order(words) == table[-1][-1] >= sum(m.size for m in found)


def test_a_text_of_shuffled_template_words_is_soon_read():
    import random
    import time
    draw = random.Random(5)
    scanner = licenses.Scanner(licenses.TEMPLATES)
    template = max(scanner.templates, key=lambda t: "MIT" in t.name and len(t.words))
    words = template.words * 120
    draw.shuffle(words)
    text = " ".join(words)[:122_000]
    whole = " ".join(template.words)
    began = time.process_time()
    assert scanner.find(text) == []
    assert time.process_time() - began < 3
    assert [f.license for f in scanner.find(text + " " + whole)] == [template.name]
