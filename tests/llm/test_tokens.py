"""BPE, token counts and URL rules against the public library and brute force."""

import hashlib
import random
from fnmatch import fnmatchcase

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer, models

from corpusmill.llm import bpe, tokencount, urlfilter
from tests.llm.edges import EDGE_TEXTS, docs

ODD = [" ", "  a", "a  ", " \n x", "it's we'll", "<|endoftext|>a<|endoftext|> b", "\x1c a", "\u00a0\u3000z", "1a2"]


def fuzz(seed, letters, n=300):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 40))) for _ in range(n)]


def test_bpe_equals_library_and_round_trips(spark):
    path = bpe.default_tokenizer()
    library = Tokenizer.from_file(path)
    texts = EDGE_TEXTS + list(enumerate(ODD + fuzz(1, " \n\tab'sLL12é!?中\u0301😀"), 100))
    got = sorted(map(tuple, bpe.report(docs(spark, texts)).collect()), key=str)
    want = []
    for i, t in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    full = bpe.encode_texts(docs(spark, [(1, "round trip é")]), path).collect()[0]
    assert full.bpe_text == "round trip é" and len(full.bpe_ids) == full.n_tokens
    assert bpe.report(docs(spark, [])).count() == 0


def test_bpe_small_cache_changes_nothing():
    v = bpe.Vocabulary(bpe.default_tokenizer())
    a, b = bpe.Encoder(v), bpe.Encoder(v, 3)
    for t in fuzz(2, "abc de ,fgh"):
        assert a.encode(t) == b.encode(t) == a.encode(t)


def test_token_counts_equal_library(spark):
    v = tokencount.Unigram.read(tokencount.default_tokenizer())
    library = Tokenizer(models.Unigram(
        vocab=[("<unk>", 0.0), *v.pieces, *[(f"<0x{b:02X}>", 0.0) for b in range(256)]], unk_id=0, byte_fallback=True))
    texts = [t for t in EDGE_TEXTS if t[0] != 8] + list(enumerate(ODD[:5] + fuzz(3, "the ing onaé中😀\n"), 100))
    got = sorted(map(tuple, tokencount.report(docs(spark, texts)).collect()), key=str)
    count = lambda t: len(library.encode("▁" + t.replace(" ", "▁")).ids) if t else 0
    assert got == sorted(((i, count(t)) for i, t in texts), key=str)
    assert tokencount.report(docs(spark, [])).count() == 0


def test_long_unbroken_text_in_bounded_memory():
    import tracemalloc

    counter = tokencount.Counter(tokencount.Unigram.read(tokencount.default_tokenizer()))
    library = Tokenizer(models.Unigram(vocab=[("<unk>", 0.0), *counter.v.pieces], unk_id=0, byte_fallback=False))
    rng = random.Random(7)
    for n in (1, 2, 30, 3000):  # the ring is shorter than the text, as long, and longer
        text = "".join(rng.choice("theinganor") for _ in range(n))
        assert counter.segment(text) == len(library.encode(text).ids)
    text = "theinganor" * 40_000
    tracemalloc.start()
    assert counter.segment(text) > 0
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6 * len(text)  # the automaton's own copy of the text has four bytes for a character


URLS = [None, "", "no scheme", "http://", "https://EXAMPLE.org/es/1", "http://a.example.org/en/12?x=/de/", "http://x.com",
        "http://notexample.org/es/", "http://fr.com/fr/", "http://com/de/#a", "http://a.net/b.org/", "http://u.net/x.zip",
        "http://u.net/login", "ftp://x.casino.net/a", "http://a.com?u=http://b.org/", "x\n://h.org/p\nq",
        "http://a.org/" + "y" * 5000]


def test_url_rules_equal_sql(spark):
    rows = [(i, u, "<p>", "clash") for i, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, verdict string")
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", [r[:2] for r in rows])
    assert sorted(map(tuple, urlfilter.report(pages).collect())) == sorted(con.execute(urlfilter.ORACLE_SQL).fetchall())
    assert urlfilter.report(pages.limit(0)).count() == 0


@pytest.mark.parametrize("n_rules", [3, 60])
def test_shift_and_equals_globbing(n_rules):
    rng = random.Random(n_rules)
    globs = ["".join(rng.choice("ab/*") for _ in range(rng.randrange(1, 9))) for _ in range(n_rules)]
    strings = ["".join(rng.choice("ab/") for _ in range(rng.randrange(0, 12))) for _ in range(200)]
    got = urlfilter.ShiftAnd(globs).matches([s.encode() for s in strings])
    assert got.tolist() == [[fnmatchcase(s, g) for g in globs] for s in strings]
