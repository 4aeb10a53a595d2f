"""Line-first cleaning against a plain version."""
import random
import re
from collections import Counter

import pytest

from halfhourly.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def passes(line: str) -> bool:
    words, chars = WORD.findall(line), len(re.sub(r"[\x20\x09-\x0D]+", "", line))
    return bool(re.search(quality.CLOSED.replace(r"\z", r"\Z"), line)
                and len(re.findall(r"(?:!!|\?\?)(?:[\x20\x09-\x0D]|\Z)", line)) * 10 <= len(words)
                and len(re.findall(quality.SEPARATORS, line)) < 3
                and not re.search(quality.MENU.replace(r"\z", r"\Z"), line)
                and len(re.findall(quality.SYMBOLS, line)) * 10 <= chars
                and not re.search(quality.STOCK, line))


def by_hand(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(grams)
    covered = {p for i, g in enumerate(grams) if often[g] > 1 for p in range(i, i + 8)}
    chars = sum(map(len, words))
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    lost, seen, out = 0, set(), []
    for x in text.split("\n"):
        has = bool(WORD.search(x))
        if has and (x in seen or not passes(x)):
            lost += len(re.sub(r"[\x20\x09-\x0D]+", "", x))
        else:
            out.append(x)
        if has:
            seen.add(x)
    return (len(words), chars, len(re.findall(quality.SYMBOLS, text)), len(lines) - len(set(lines)),
            len(covered), failed, lost, not failed and 100 * lost <= 50 * chars, "\n".join(out))


def prose(rng, n):
    return " ".join(rng.choice(["the", "éa", "river", "stone", "ran", "𝒳y"]) + rng.choice(["", "s", "ing", "7"])
                    for _ in range(n)) + "."


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    fixed = [None, "", " \n\n\t", "Home", "one two three.", "a b c\x1fd e\x0bf\x0cg\rh.", "x " * 40,
             "one two three four five six seven eight " * 6 + ".",
             "\n".join(["Read more about this", "Home | News | Sport | About", prose(rng, 30), prose(rng, 30),
                        "All rights reserved.", "", "LOUD!! WORDS!! HERE!!", "wi##th# sym$$ bols%%."]),
             "\n".join([prose(rng, 12)] * 4 + [prose(rng, 40)]), prose(rng, 30) + "\r\n" + prose(rng, 30) + "\r"]
    out = fixed + ["\n".join(prose(rng, rng.randrange(0, 25)) + rng.choice(["", "", " | x | y |", "!!", " end"])
                             for _ in range(rng.randrange(1, 8))) for _ in range(120)]
    same = prose(rng, 9)
    out.append("\n".join(rng.choice([same, prose(rng, 9)]) for _ in range(8000)))  # long, one line often
    out.append("a " * 60_000 + ".")                                                 # one window everywhere
    return out + out[:12]


def test_counts_and_verdicts(spark, texts):
    docs = spark.createDataFrame([(i if i % 7 else None, t, "x") for i, t in enumerate(texts)],
                                 "doc_id long, text string, kept string")
    got = quality.judged_texts(docs).select("doc_id", "judged.*").collect()
    assert len(got) == len(texts)
    for row, text in zip(got, texts):
        assert tuple(row)[1:] == by_hand(text), repr(text)[:200]


def test_kept_texts_lose_their_failing_lines(spark, texts):
    docs = spark.createDataFrame([(i, t, len(t or ""), "x") for i, t in enumerate(texts)],
                                 "doc_id long, text string, n_chars long, judged string")
    out = quality.clean(docs)
    assert out.schema == docs.schema
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    want = {i: by_hand(t)[-1] for i, t in enumerate(texts) if by_hand(t)[-2]}
    assert got == {i: (t, len(t)) for i, t in want.items()} and want


def test_no_python_in_the_plan_and_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    out = quality.judged_texts(empty)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert out.count() == 0


def test_sentences_of_other_scripts_end(spark):
    hindi, urdu = " ".join(f"शब्द{k}" for k in range(25)) + " ।", " ".join(f"لفظ{k}" for k in range(25)) + "۔"
    docs = spark.createDataFrame([(1, hindi), (2, urdu), (3, hindi[:-2])], "doc_id long, text string")
    kept = {r.doc_id for r in quality.clean(docs).collect()}
    assert {1, 2} <= kept and 3 not in kept
