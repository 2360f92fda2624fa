"""Conversation repair against a plain dynamic program over whole strings, and against SQL."""

import hashlib
import zlib
from itertools import product

import pytest

from corpusmill.llm import conversations as C


def plain_audit(rows):
    """Cheapest (cost, letters) by keeping whole strings of every state; rows are (role initial, fault)."""
    def moved(state, to):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}.get((state, to))

    def spread(states):
        while True:
            more = dict(states)
            for s, (c, w) in states.items():
                for to in "ua":
                    t = moved(s, to)
                    if t and ((c + 2, w + "I") < more.get(t, (9e9, ""))):
                        more[t] = (c + 2, w + "I")
            if more == states:
                return states
            states = more

    states = spread({"": (0, "")})
    for initial, fault in rows:
        after = {}
        for s, (c, w) in states.items():
            steps = [(s, c + 3, "D")]
            if fault not in (C.BLANK, C.DUPLICATE):
                extra = fault == C.TRUNCATED
                if moved(s, initial):
                    steps.append((moved(s, initial), c + extra, "K"))
                steps += [(moved(s, to), c + 2 + extra, "R") for to in "ua" if moved(s, to)]
            for t, cost, letter in steps:
                after[t] = min(after.get(t, (9e9, "")), (cost, w + letter))
        states = spread(after)
    return min(v for s, v in states.items() if s in ("", "a"))


def fast_audit(rows):
    best = C.Survivors()
    settled = "".join([best.row(i, f) for i, f in rows])
    cost, rest = best.finish()
    return cost, settled + rest


def test_survivors_equal_whole_strings():
    kinds = [("s", 0), ("u", 0), ("a", 0), ("u", C.TRUNCATED), ("a", C.BLANK), ("x", 0)]
    for n in range(5):
        for rows in product(kinds, repeat=n):
            assert fast_audit(rows) == plain_audit(rows), rows


def test_open_part_is_bounded_and_ties_are_complete():
    import random

    rng = random.Random(5)
    for _ in range(200):
        rows = [(rng.choice("suaua"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(60)]
        assert fast_audit(rows) == plain_audit(rows)
    best, most = C.Survivors(), 0
    for i in range(3000):
        best.row("ua"[i % 2] if i % 7 else "u", 0)
        most = max(most, max(len(t) for _, t in best.ends().values()))
    assert most < 50


def brute(table):
    """Contract columns of damaged rows (conv, turn, role, text) in plain Python."""
    convs = {}
    for conv, turn, role, text in table:
        one = lambda v: " " if v is None else str(v)
        rows = convs.setdefault(conv, [])
        kind = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        role, text = one(role), one(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in rows:
            said = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append(C.BLANK if not said else C.DUPLICATE if (role, text) in seen else
                          C.NONE if said[-1] in ".!?" else C.TRUNCATED)
            seen.add((role, text))
        cost, audit = plain_audit([(r[1][:1], f) for r, f in zip(rows, faults)])
        left, made, role_before = list(rows), [], ""
        for letter in audit:
            role, text = ("", "") if letter == "I" else left.pop(0)[1:]
            if letter in "IR":
                role = "assistant" if role_before == "u" else "user"
            if letter != "D":
                made.append(f"{role}:{text}")
                role_before = role[:1]
        turns = [r[0] for r in rows if r[0] is not None]
        initials = [r[1][:1] for r in rows]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count(C.BLANK),
                     faults.count(C.DUPLICATE), faults.count(C.TRUNCATED),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(made).encode()).hexdigest())
    return out


SCHEMA = "conv_id long, turn long, role string, text string, key string, Edit long, times string"


def edge_table(spark):
    rows = [(1, 0, "system", "Be good."), (1, 1, "user", "Hi?"), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Yes"),
            (1, None, "user", "Null turn."), (2, 0, None, None), (2, None, None, "x"), (3, 5, "", "\n"), (None, 1, "user", "no id."),
            (None, 1, "assistant", "no id."), (None, None, None, None), (5, 3, "tool", "é😀."), (5, 9, "user", "w " * 300_000)]
    rows += [(4, t, ("user", "assistant", "assistant")[t % 3], f"Turn {t % 5}" + ".?x "[t % 4]) for t in range(80)]
    rows += [(7, t, "user", "Same.") for t in range(40)] + [(c, t, "ua"[t % 2], f"{t}.") for c in range(10, 60) for t in range(c % 6)]
    return spark.createDataFrame([(*r, "k", 1, "t") for r in rows], SCHEMA), rows


@pytest.mark.parametrize("long_rows", [C.LONG_ROWS, 3, 0])
def test_report_equals_brute_force(spark, long_rows, monkeypatch):
    df, rows = edge_table(spark)
    monkeypatch.setattr(C, "HOT_ROWS", 7)
    got = {r[0]: tuple(r)[1:] for r in C.report(df.repartition(5), long_rows).collect()}
    assert got == brute(rows)


def test_edits_make_the_repaired_table(spark):
    df, rows = edge_table(spark)
    whole, cut = [C.repair(df, long_rows=n).collect() for n in (C.LONG_ROWS, 5)]
    assert sorted(map(repr, whole)) == sorted(map(repr, cut))
    by_conv = {}
    for r in sorted(whole, key=lambda r: r["place"]):
        by_conv.setdefault(r["conv_id"], []).append(r)
    for steps in by_conv.values():
        assert [r["place"] for r in steps] == list(range(len(steps)))
        initials = "".join(r["role"][:1] for r in steps if r["edit"] != "D")
        assert not initials.lstrip("s")[1:] or initials.replace("ua", "") in ("", "s")


def test_empty_table(spark):
    assert C.report(spark.createDataFrame([], SCHEMA)).collect() == []
    assert C.repair(spark.createDataFrame([], SCHEMA)).collect() == []
