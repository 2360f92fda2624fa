"""Packing: ids against the library, every id in one piece, no padding, differencing against brute force."""

import random
from array import array
from itertools import product
from zlib import crc32

import pytest
from tokenizers import Tokenizer

from corpusmill.llm import packing as P
from tests.llm.edges import EDGE_TEXTS, docs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.default_tokenizer())


@pytest.fixture(scope="module")
def encoder():
    with open(P.default_tokenizer(), encoding="utf-8") as f:
        return P.UnitEncoder(f.read())


def same(encoder, library, text):
    assert array("I", encoder.encode(text)).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_ids_equal_the_library(spark, encoder, library):
    for row in spark.read.parquet(f"{SF}/documents.parquet").collect():
        same(encoder, library, row["text"] or "")
    for c in [*range(0x300), *range(0x2000, 0x2070), 0x1680, 0x180e, 0x3000, 0xfeff, 0x1f600]:
        same(encoder, library, f"Ab{chr(c)}c {chr(c)} d{chr(c)}{chr(c)}  It's{chr(c)}'Ś é")
    rng = random.Random(2)
    odd = "aB'sé́İΣς \t\n\x0b\x0c\r\x1c\x85\xa0 <|endoftext|>|1２٣ßǅ中。😀\x00\x7f"
    for _ in range(3000):
        same(encoder, library, "".join(rng.choice([*odd, "<|endoftext|>", "'ll", "'RE", " "]) for _ in range(rng.randrange(30))))


def test_kept_units_change_nothing(library):
    with open(P.default_tokenizer(), encoding="utf-8") as f:
        small = P.UnitEncoder(f.read(), keep=3)
    for text in ["the the cat sat on, the mat. the", "THE Cat; the cat é the"] * 3:
        same(small, library, text)


def test_differencing_is_near_equal():
    rng = random.Random(4)
    for _ in range(60):
        sizes, k = [rng.randint(1, 9) for _ in range(rng.randint(1, 7))], rng.randint(1, 3)
        parts = P.difference(sizes, k)
        assert sorted(i for p in parts for i in p) == list(range(len(sizes))) and len(parts) == k
        spread = lambda ps: max(map(sum, ps)) - min(map(sum, ps))
        best = min(spread([[s for s, w in zip(sizes, ws) if w == j] for j in range(k)]) for ws in product(range(k), repeat=len(sizes)))
        assert best <= spread([[sizes[i] for i in p] for p in parts]) <= best + max(sizes)
    sizes = [rng.randint(1, 512) for _ in range(3000)]
    sums = [sum(sizes[i] for i in p) for p in P.difference(sizes, 300)]
    assert max(sums) - min(sums) < 25


def test_window_count_rises_beyond_capacity():
    # three pieces of six do not fit two windows of ten; a third one is opened, and cut up
    windows, left = P.divide([(0, 0, 6), (1, 0, 6), (2, 0, 6)], 10)
    assert [sum(p[2] for p in w) for w in windows] == [10] and sum(p[2] for p in left) == 8


def check(rows, want, window, library_ids):
    """Every document's ids in gapless pieces, every sequence gapless and full or a power of two."""
    by_doc, by_seq = {}, {}
    for r in rows:
        assert 1 <= r["length"] <= window
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_seq.values():
        parts.sort()
        at = 0
        for offset, length in parts:
            assert offset == at
            at += length
        assert at == window or (at < window and at & (at - 1) == 0)
    for r in rows:
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"], r["ids_crc32"]))
    assert sorted(map(repr, by_doc)) == sorted({repr((i, len(library_ids(t)))) for i, t in want})
    for i, t in want:
        ids = library_ids(t)
        twins = sum(1 for j, u in want if j == i and len(library_ids(u)) == len(ids))
        parts = sorted(by_doc[(i, len(ids))])
        assert sum(p[1] for p in parts) == len(ids) * twins
        if twins == 1:
            at = 0
            for start, length, crc in parts:
                assert start == at and crc == crc32(array("I", ids[at:at + length]).tobytes())
                at += length


@pytest.mark.parametrize("window", [2048, 32])
def test_pieces_of_edge_texts(spark, library, window):
    kept = {}

    def ids(text):
        if text not in kept:
            kept[text] = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        return kept[text]

    for parts in (1, 4):
        rows = P.pack(docs(spark, EDGE_TEXTS).repartition(parts), P.default_tokenizer(), window=window, digests=True).collect()
        check(rows, EDGE_TEXTS, window, ids)
    whole = P.pack(docs(spark, EDGE_TEXTS), P.default_tokenizer(), window=window).collect()
    assert all(len(r["ids"]) == r["length"] for r in whole)


def test_many_groups(library, monkeypatch):
    rng = random.Random(9)
    packer, rows, made = P.Packer(64, 16, 8), [], []
    for i in range(400):
        made.append((i, array("I", range(rng.randint(1, 150))).tobytes()))
        rows += packer.add(*made[-1])
        assert packer.size < 8 * 64 + 150
    rows += packer.finish()
    check([{"doc_id": r[0], "start": r[1], "length": r[2], "ids_crc32": crc32(r[3]), "doc_tokens": r[4], "sequence_id": r[5],
            "offset": r[6]} for r in rows], [(i, ids) for i, ids in made], 64, lambda ids: array("I", ids).tolist())


def test_whole_table_and_empty_table(spark, library):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = P.report(table).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in table.collect()], 2048,
          lambda t: [*library.encode(t or "", add_special_tokens=False).ids, 1])
    # most pieces are whole documents or as long as a cut
    assert len(rows) < 4 * len({r["doc_id"] for r in rows}) + 2 * len({r["sequence_id"] for r in rows})
    assert P.report(docs(spark, [])).collect() == []
