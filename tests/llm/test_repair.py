"""Conversation repair next to a plain search over edits, in one piece, in blocks and over ranges."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from halfhourly.llm import repair
from halfhourly.llm.queries import QUERIES

FORM = re.compile(r"(s?(ua)+)?")
ROLES = [b"system", b"user", b"assistant", b"tool", b" "]
TEXTS = [b"Yes.", b"No!", b"and so", b" \t", b"", b"Why?\n"]
SCHEMA = "conv_id long, turn long, role string, text string"


def searched(rows):
    """(cost, audit, lines) of the best of all edits, by trying each, with at most two inserts at a place."""
    faults = plain_faults(rows)
    best = None
    for kinds in itertools.product("KRD", repeat=len(rows)):
        if any(k != "D" and f in (1, 2) for k, f in zip(kinds, faults)):
            continue
        for holes in itertools.product(range(3), repeat=len(rows) + 1):
            if sum(holes) > 3:
                continue
            audit = "I" * holes[0] + "".join(k + "I" * h for k, h in zip(kinds, holes[1:]))
            cost = sum({"K": 0, "R": 1, "D": 2, "I": 5}[e] for e in audit)
            cost += 5 * sum(k != "D" and f == 3 for k, f in zip(kinds, faults))
            if best and (cost, audit) >= best[:2]:
                continue
            slots, at = [], 0
            for e in audit:
                if e == "I":
                    slots.append((("user", "assistant"), b""))
                else:
                    _, role, text = rows[at]
                    at += 1
                    if e == "K":
                        slots.append(((role.decode(),), text))
                    elif e == "R":
                        slots.append((("user", "assistant"), text))
            for roles in itertools.product(*[s[0] for s in slots]):
                if FORM.fullmatch("".join(r[:1] for r in roles)):
                    best = (cost, audit, [r.encode() + b":" + s[1] for r, s in zip(roles, slots)])
                    break
    return best


def plain_faults(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        end = text.strip(b" \t\n\x0b\x0c\r")[-1:]
        faults.append(1 if not end else 2 if (role, text) in seen else 0 if end in b".!?" else 3)
        seen.add((role, text))
    return faults


def walked(rows):
    """(cost, audit) by one walk over the rows with the best of each last role."""
    steps = {0: 2, 1: 2, 2: 3, 3: 2}

    def inserted(best):
        for _ in range(3):
            for p, (cost, audit) in list(best.items()):
                new = (cost + 5, audit + "I")
                best[steps[p]] = min(best.get(steps[p], new), new)
        return best

    best = inserted({0: (0, "")})
    for (_, role, _), fault in zip(rows, plain_faults(rows)):
        new = {}
        for p, (cost, audit) in best.items():
            options = [(p, cost + 2, audit + "D")]
            if fault in (0, 3):
                more = 5 if fault else 0
                options.append((steps[p], cost + 1 + more, audit + "R"))
                first = role[:1]
                if first == b"s" and p == 0:
                    options.append((1, cost + more, audit + "K"))
                if first == b"u" and p != 2:
                    options.append((2, cost + more, audit + "K"))
                if first == b"a" and p == 2:
                    options.append((3, cost + more, audit + "K"))
            for q, c, a in options:
                new[q] = min(new.get(q, (c, a)), (c, a))
        best = inserted(new)
    return min(best[q] for q in (0, 3) if q in best)


def some_rows(draw, n):
    return [(k, draw.choice(ROLES), draw.choice(TEXTS)) for k in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_small_conversations_by_trying_all_edits(seed):
    draw = random.Random(seed)
    for n in [0, 1, 1, 2, 2, 3, 3, 3, 4, 4]:
        rows = some_rows(draw, n)
        done, (cost, audit, lines) = repair.Repaired(rows), searched(rows)
        assert (done.cost, done.audit) == (cost, audit), rows
        assert [r + b":" + x for _, _, r, x in done.turns] == lines


@pytest.mark.parametrize("n", [5, 16, 17, 40, 300])
def test_long_conversations_in_blocks(n):
    draw = random.Random(n)
    for _ in range(10):
        rows = [(k, draw.choice(ROLES[:4]), b"row %d." % draw.randrange(3 * n)) for k in range(n)]
        done = repair.Repaired(rows)
        assert (done.cost, done.audit) == walked(rows)
        assert FORM.fullmatch("".join(chr(r[0]) for _, _, r, _ in done.turns))


def test_all_cuts_of_a_span_give_the_same_cell():
    draw = random.Random(3)
    signs = [repair.sign(draw.choice("suao"), draw.randrange(4)) for _ in range(9)]
    leaves = [repair.block_cells(s) for s in signs]
    whole = repair.chart(leaves)
    for cut in range(1, 9):
        assert repair.chart([repair.chart(leaves[:cut]), repair.chart(leaves[cut:])]) == whole


def plain_summary(rows):
    rows = [(t, b" " if r is None else r, b" " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, done = plain_faults(rows), repair.Repaired(rows)
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1].decode() for _, r, _ in rows]
    lines = b"\n".join(r + b":" + x for _, _, r, x in done.turns)
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in (1, 2, 3)],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            *walked(rows), hashlib.sha256(lines).hexdigest())


def by_conversation(spark, data):
    rows = [(c, t, *[None if v is None else v.decode() for v in (r, x)]) for c, t, r, x in data]
    return spark.createDataFrame(rows, SCHEMA)


def test_tables_with_nulls_ties_repeats_and_clashing_names(spark):
    draw = random.Random(5)
    data = [(c, draw.choice([None, 0, 1, 2, 2, 7]), draw.choice([*ROLES, None, b""]), draw.choice([*TEXTS, None]))
            for c in [None, 1, 2, 3, 4, 5, 6, 7, 8, 9] for _ in range(draw.randrange(1, 9))]
    turns = by_conversation(spark, data).selectExpr("*", "1 AS cost", "'x' AS place", "turn AS Kind")
    found = {r[0]: tuple(r)[1:] for r in repair.repaired_conversations(turns).collect()}
    want = {}
    for c, *row in data:
        want.setdefault(c, []).append(tuple(row))
    assert found == {c: plain_summary(rows) for c, rows in want.items()}
    stays = repair.repaired_turns(turns).collect()
    for c, rows in want.items():
        lines = [f"{r.role}:{r.text}" for r in sorted((s for s in stays if s.conv_id == c), key=lambda s: s.place)]
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == found[c][-1]
    assert repair.repaired_conversations(turns.limit(0)).count() == 0


def test_a_conversation_far_larger_than_a_range(spark):
    """Most rows belong to one conversation, which is parsed in blocks over all tasks."""
    draw = random.Random(6)
    data = [(7, k // 2, draw.choice(ROLES[:4]), b"row %d%s" % (draw.randrange(9000), draw.choice([b".", b"!", b""])))
            for k in range(6000)]
    data += [(c, k, draw.choice(ROLES), draw.choice(TEXTS)) for c in (1, 9, 12) for k in range(4)]
    draw.shuffle(data)
    found = {r[0]: tuple(r)[1:] for r in repair.repaired_conversations(by_conversation(spark, data)).collect()}
    for c in (1, 7, 9, 12):
        assert found[c] == plain_summary([row[1:] for row in data if row[0] == c]), c


def test_bytes_that_are_no_text(spark):
    turns = spark.sql("SELECT 1L conv_id, 0L turn, 'user' role, CAST(X'FF2E' AS STRING) text")
    row = repair.repaired_conversations(turns).first()
    assert (row.truncated, row.blank, row.audit) == (0, 0, "D")


def test_damage_by_its_rule(spark):
    data = [(c, t, "assistant", f"One. Two {t}!") for c in range(40) for t in range(5)] + [(None, None, None, None)]
    found = sorted(map(tuple, repair.damaged(spark.createDataFrame(data, SCHEMA)).collect()), key=repr)
    want = []
    for c, t, r, x in data:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = (" " if v is None else v for v in (r, x))
        row = (c, t, "user" if kind == 4 else r, "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x)
        want += [row] * {0: 0, 3: 2}.get(kind, 1)
    assert found == sorted(want, key=repr)


def test_the_query_has_every_conversation(spark):
    sf = "/root/testdata/sf0.001"
    ids = {r[0] for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id").collect()}
    rows = QUERIES["op11_conversation_repair"](spark, sf).collect()
    assert sorted(r.conv_id for r in rows) == sorted(ids)
