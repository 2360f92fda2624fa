"""Decontamination, SimHash near-duplicates and repeated byte strings against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusmill.llm import decontaminate, simhash, substrings
from tests.llm.edges import EDGE_TEXTS, docs

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s or "")


def brute_hits(texts, bench):
    wins = {}
    for item, t in bench:
        w = WORD.findall(lower(t))
        for i in range(max(1, len(w) - 12) if w else 0):
            wins.setdefault(tuple(w[i:i + 13]), set()).add(item)
    out = []
    for _, t in texts:
        w = WORD.findall(lower(t))
        hit, items = set(), set()
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                got = wins.get(tuple(w[i:i + n]))
                if got is not None:
                    hit |= set(range(i, i + n))
                    items |= got
        names = sorted(str(i) for i in items if i is not None)
        out.append((len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block_words", [1_000_000, 20])
def test_decontamination(spark, block_words):
    rng = random.Random(1)
    words = ["ab", "Cd", "e1", "né", "x"]
    text = lambda n: " ".join(rng.choice(words) + rng.choice(["", ".", "-"]) for _ in range(n))
    bench = [(i, text(rng.randrange(10, 30))) for i in range(6)] + [(7, "ab cd"), (7, "ab cd"), (8, ""), (9, None),
                                                                    (None, text(14))]
    texts = list(EDGE_TEXTS)
    for i in range(40):
        t = text(rng.randrange(0, 120))
        texts.append((100 + i, t + " " + (rng.choice(bench)[1] or "")[:80] if i % 2 else t))
    b = spark.createDataFrame(bench, "item_id long, text string")
    out = decontaminate.decontaminate(docs(spark, texts), b, block_words=block_words)
    got = [(r.bench_words, r.bench_hits, len(r.bench_items),
            hashlib.sha256(",".join(r.bench_items).encode()).hexdigest(), r.bench_contaminated) for r in out.collect()]
    assert sorted(got) == sorted(brute_hits(texts, bench))
    assert decontaminate.remove_contaminated(docs(spark, texts), b).columns == docs(spark, texts).columns


def test_decontamination_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(not r.contaminated for r in decontaminate.report(docs(spark, EDGE_TEXTS), none).collect())
    assert decontaminate.report(docs(spark, []), none).count() == 0


def test_removal_spans_cut_whole_passages(spark):
    b = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    r = decontaminate.decontaminate(docs(spark, [(1, "é, One two-THREE four")]), b).collect()[0]
    assert [tuple(s) for s in r.bench_spans] == [(3, 16)]


def test_fm_index_counts_and_locates():
    rng = np.random.default_rng(2)
    text = np.concatenate([[0], rng.integers(1, 4, 300), [0], rng.integers(1, 4, 200)])
    index = decontaminate.FMIndex(text, 4)
    for n in (1, 2, 5):
        patterns = rng.integers(1, 4, (20, n))
        lo, hi = index.search(patterns)
        for p, a, z in zip(patterns, lo, hi):
            want = [i for i in range(len(text) - n + 1) if (text[i:i + n] == p).all()]
            assert sorted(index.locate(np.arange(a, z))) == want


def brute_print(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    parts = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] if len(w) > 4 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_classes(points, max_bits=4):
    label = list(range(len(points)))
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= max_bits
    label = np.arange(len(points))
    while True:
        new = np.where(near, label[None, :], len(points)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def near_texts():
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefghij") * 3 for _ in range(300)).split() for _ in range(4)]
    texts = list(EDGE_TEXTS)
    for i in range(80):
        w = list(base[i % 4])
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(len(w))] = "zz"
        texts.append((200 - i, " ".join(w)))
    return texts


def test_fingerprints():
    for _, t in near_texts():
        assert simhash.fingerprint(t) % (1 << 64) == brute_print(t)


def test_classes(spark):
    texts = near_texts()
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id)
                  for r in simhash.report(docs(spark, texts)).collect()), key=str)
    prints = np.array([brute_print(t) for _, t in texts], np.uint64)
    label = brute_classes(prints)
    least = {}
    for (i, _), c in zip(texts, label):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    want = sorted(((i is None, i or 0, f"{int(f):016x}", least.get(c)) for (i, _), f, c in zip(texts, prints, label)),
                  key=str)
    assert got == want
    kept = simhash.keep_first(docs(spark, texts))
    assert kept.columns == docs(spark, texts).columns
    assert kept.count() == len(set(label.tolist()))
    assert simhash.report(docs(spark, [])).count() == 0


@pytest.mark.parametrize("small,section,large", [(48, 1024, 1 << 15), (2, 8, 1 << 15), (2, 8, 20), (1, 4, 3)])
def test_all_three_ways_find_the_same_classes(spark, small, section, large):
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    points = set()
    for c in centres.tolist() + [0]:
        for _ in range(40):
            p = c
            for b in rng.integers(0, 64, rng.integers(0, 7)).tolist():
                p ^= 1 << b
            points.add(p)
    points = np.array(sorted(points), np.uint64)
    df = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    edges = simhash.links(df, 4, small, section, large).collect()
    at = {int(p): i for i, p in enumerate(points.view(np.int64))}
    label = list(range(len(points)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for e in edges:
        a, b = root(at[e.src]), root(at[e.dst])
        label[max(a, b)] = min(a, b)
    assert [root(i) for i in range(len(points))] == brute_classes(points).tolist()


def brute_cut(texts):
    data = [(i, (t or "").encode()) for i, t in texts]
    seen = Counter(b[p:p + 200] for _, b in data for p in range(len(b) - 199))
    out = []
    for i, b in data:
        cover = bytearray(len(b))
        for p in range(len(b) - 199):
            if seen[b[p:p + 200]] > 1:
                cover[p:p + 200] = b"\1" * 200
        spans = sum(1 for k in range(len(b)) if cover[k] and (k == 0 or not cover[k - 1]))
        kept = bytes(x for x, c in zip(b, cover) if not c)
        out.append((i, len(b), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("many", [2000, 3])
def test_repeated_substrings(spark, many):
    rng = random.Random(5)
    w = "".join(rng.choice("abcdefgh é") for _ in range(800))
    texts = [t for t in EDGE_TEXTS if t[0] not in (7, 8)] + [
        (10, "x" * 500), (11, w[:400] + "Q" + w[400:]), (12, "é" + w[100:600] + "ü"), (13, w[250:]), (14, "ab" * 99),
        (15, "ab" * 100), (16, "ab" * 101 + "c"), (17, w[600:] + w[:240]), (18, w), (18, w)]
    texts += [(100 + i, w[150:345] + str(i) + w[345:560] + chr(97 + i) * 3 + w[430:600]) for i in range(20)]
    out = substrings.remove_repeats(docs(spark, texts), many=many).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long"), F.size("removed_spans"),
        F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, out), key=str) == sorted(brute_cut(texts), key=str)


def test_repeated_substrings_long_and_empty(spark):
    out = {r.doc_id: r for r in substrings.report(docs(spark, EDGE_TEXTS[-2:])).collect()}
    assert out[7].n_removed == out[7].n_bytes == 300_000 and out[8].n_removed == 50_000 and out[8].n_spans == 1
    assert substrings.report(docs(spark, [])).count() == 0
