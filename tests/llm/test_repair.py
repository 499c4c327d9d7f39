import hashlib
import itertools
import random
import re
import zlib

import pandas as pd
import pytest

from framelark.llm import repair

BLANK = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(symbols):
    """Least (cost, audit) by walking all edits through the states of the grammar."""
    steps = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def better(best, state, cost, audit):
        if state not in best or (cost, audit) < best[state]:
            best[state] = cost, audit

    def inserts(best):
        out = dict(best)
        for _ in range(4):
            for state, (cost, audit) in list(out.items()):
                for new in "ua":
                    if (state, new) in steps:
                        better(out, new, cost + 5, audit + "I")
        return out

    best = {"": (0, "")}
    for c in symbols:
        new = {}
        for state, (cost, audit) in inserts(best).items():
            better(new, state, cost + 2, audit + "D")
            if c != "d":
                extra = 5 if c.isupper() else 0
                if (state, c.lower()) in steps:
                    better(new, c.lower(), cost + extra, audit + "K")
                for role in "ua":
                    if (state, role) in steps and role != c.lower():
                        better(new, role, cost + 1 + extra, audit + "R")
        best = new
    return min(v for s, v in inserts(best).items() if s in ("", "a"))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4])
def test_every_short_conversation(n):
    for symbols in itertools.product("suaxSUAXd", repeat=n):
        ((_, cost, audit),) = repair.align("".join(symbols))
        assert (cost, audit) == cheapest(symbols), symbols


def test_longer_conversations():
    rng = random.Random(4)
    for n in (7, 12, 25, 60):
        for _ in range(40):
            symbols = "".join(rng.choice("uaxSUAd") if rng.random() < rng.choice([0.1, 0.6]) else "ua"[i % 2] for i in range(n))
            ((_, cost, audit),) = repair.align(symbols)
            assert (cost, audit) == cheapest(symbols), symbols


def slow_report(rows):
    """Conversations in a loop: damage, faults, cheapest edits, hashes."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, [])
        space = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        convs[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        seen, symbols, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in turns:
            known = role[:1] if role[:1] in ("s", "u", "a") else "x"
            told = BLANK.findall(text)
            fault = "blank" if not told else "duplicate" if (role, text) in seen else "truncated" if told[-1] not in ".!?" else None
            seen.add((role, text))
            symbols.append("d" if fault in ("blank", "duplicate") else known.upper() if fault else known)
            if fault:
                faults[fault] += 1
        cost, audit = cheapest(symbols)
        left, i, state = [], 0, ""
        for e in audit:
            if e == "K":
                left.append((turns[i][1], turns[i][2]))
            elif e in "RI":
                left.append(("assistant" if state == "u" else "user", turns[i][2] if e == "R" else ""))
            if e != "D":
                state = left[-1][0][0]
            i += e != "I"
        numbers = [t for t, _, _ in turns if t is not None]
        out[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *faults.values(),
                     sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(turns, turns[1:])), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest())
    return out


def talk(seed, convs, longest):
    rng, rows = random.Random(seed), []
    for conv in [*range(convs), None]:
        turn = 0
        for i in range(rng.choice([1, 2, 5, 9, longest])):
            turn += rng.choice([1, 1, 1, 2])
            role = rng.choice(["user", "assistant", "system", "tool", "", None, "ünknown"]) if rng.random() < 0.1 else "user assistant".split()[i % 2]
            text = rng.choice(["Yes.", "No", "what? ", "é!\n", " \t", "", None, f"said {i}.", f"more {i}!", f"again {i}.\x0b"])
            rows.append((conv, None if rng.random() < 0.03 else turn, role, text))
    rows.append((conv, 10**6, "user", "x" * 100_000 + "."))
    return rows


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("stretch", [64, 3, 1])
def test_report(spark, stretch):
    rows = talk(stretch, 60, 40)
    table = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, k string").repartition(5)
    got = repair.report(table, stretch).toPandas()
    want = slow_report(rows)
    assert len(got) == len(want)
    for r in got.itertuples(index=False):
        assert tuple(getattr(r, c) for c in COLUMNS) == want[None if pd.isna(r.conv_id) else int(r.conv_id)]


def test_repaired_turns(spark, tiny_limits):
    rows = talk(9, 20, 30)
    table = repair.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    wide, narrow = (repair.repair(table, s).orderBy("k", "stretch", "place").toPandas() for s in (10_000, 2))
    assert wide.groupby("k").role.agg(lambda r: "".join(x[0] for x in r)).str.fullmatch("s?(ua)+").all()
    assert wide[["k", "role", "text"]].equals(narrow[["k", "role", "text"]])


def test_empty_table_and_lost_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert repair.report(spark.createDataFrame([], schema)).count() == 0
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    row = repair.report(spark.createDataFrame([(lost, 0, "user", "Hi.")], schema)).first()
    assert tuple(row) == (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
