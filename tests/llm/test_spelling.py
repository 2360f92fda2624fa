"""Spelling variants against a quadratic comparison of all words."""

import random
import re
import zlib
from collections import Counter

import pytest

from corpusmill.llm import spelling as S
from tests.llm.edges import EDGE_TEXTS, docs


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    around = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, vs in around.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(around[w]), words[form[w]] if form[w] is not None else None))
    return out


def corpus():
    rng = random.Random(3)
    bases = ["".join(rng.choice("abcé") for _ in range(rng.choice([7, 8, 9, 12, 70]))) for _ in range(25)]
    bases += ["aaaaaaaa", "aaaaaaa", "aaaaaaaaa", "bbaaaaaa", "b" * 63, "b" * 64, "b" * 65, "b" * 66, "b" * 64 + "c"]
    words = []
    for w in bases:
        words += [w] * rng.choice([2, 30, 400])
        for _ in range(6):
            i, c = rng.randrange(len(w)), rng.choice("abcéÿ")
            v = rng.choice([w[:i] + c + w[i:], w[:i] + w[i + 1:], w[:i] + c + w[i + 1:]])
            words += [v] * rng.choice([1, 2, 3, 35])
            words += [v[:3] + "x" + v[3:]] * rng.choice([2, 3])
    rng.shuffle(words)
    rows = [(k, rng.choice(" .\n1").join(words[k::90])) for k in range(90)]
    return rows + EDGE_TEXTS + [(9, "Ärgerlich ÄRGERLICH ärgerlich ärgerlich ÷×÷×÷×÷ ÷×÷×÷×÷"), (9, "a" * 50_001), (9, "a" * 50_001), (10, "a" * 50_000)]


@pytest.mark.parametrize("long", [S.LONG, 9])
def test_variants_equal_brute_force(spark, long):
    rows = corpus()
    got = {tuple(r) for r in S.report(docs(spark, rows).repartition(3), long).collect()}
    short = [(i, t) for i, t in rows if not t or "a" * 1000 not in t]
    want = brute(short)
    assert {r for r in got if len(r[0]) < 1000} == want
    assert any(r[1] is not None and r[1] != r[2] for r in want)
    # crc32 decides about a letter of the long runs; those that are left are near each other
    assert all(set(r[0]) == {"a"} and r[1] is None and r[2] == r[0] for r in got if len(r[0]) >= 1000)


def test_each_pair_meets_once():
    assert S.neighbours("b$a", [("", True, 5), ("x", True, 3), ("y", False, 9)]) == [
        ("ayb", 1, 3, "axb"), ("axb", 2, 9, "ayb"), ("ab", 1, 3, "axb")]


def test_scan_over_batch_ends():
    import pyarrow as pa

    rows = [("p$", e, True, n) for e, n in (("", 3), ("a", 4), ("b", 5))] + [("q$", "c", True, 1)] + [("r$", "d", True, 1), ("r$", "e", True, 2)]
    table = pa.table({k: list(v) for k, v in zip(("prefix", "edited", "own", "n"), zip(*rows))})
    whole = [r for b in S.scan(table.to_batches()) for r in b.to_pylist()]
    for size in (1, 2, 3, 4):
        assert [r for b in S.scan(table.to_batches(max_chunksize=size)) for r in b.to_pylist()] == whole
    assert len(whole) == 5


def test_empty_table(spark):
    assert S.report(docs(spark, [])).collect() == []
