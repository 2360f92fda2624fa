"""Byte-level BPE encoding and decoding, as the public tokenizer file defines it.

A piece of text (the file's pre-tokenization pattern) is a doubly linked list
of symbols; a heap holds the rank of every mergeable neighbour pair with its
place, entries made stale by an earlier merge are skipped, and pairs merge in
order of rank, leftmost first.  A worker keeps the ids of the strings that it
met last, at most twice CACHE_PIECES of each kind.  Decoding concatenates
vocabulary strings.

Defined results: a null text is empty, and an empty text has no ids and
decodes to the empty text; added tokens written in a text are their own ids;
repeated rows are encoded one by one; other columns are not read.
"""

from __future__ import annotations

import json
import re
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import regex
from pyspark.sql import DataFrame

from corpusmill.llm.common import add_columns, kept, sha256_hex

# Fixed value: the byte-level pre-tokenization pattern of the tokenizer file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLANK_START = re.compile(r" (?=\S)")
BLANK_RUN = re.compile(r" \s")
CACHE_PIECES = 150_000
#: Longer pieces are encoded without being kept.
CACHE_CHARS = 64


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    rest = [b for b in range(256) if b not in letters]
    return letters | {b: chr(256 + i) for i, b in enumerate(rest)}


class Vocabulary:
    """Merge ranks over ids, byte ids and byte strings of a byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, letters = file["model"], byte_letters()
        kind, pre = model["type"], file["pre_tokenizer"] or {}
        if kind != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or file["normalizer"]:
            raise ValueError("not a plain byte-level BPE tokenizer file")
        ids = model["vocab"]
        byte_of = {c: b for b, c in letters.items()}
        self.byte_ids = [ids[letters[b]] for b in range(256)]
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        by_id = {i: bytes(byte_of[c] for c in s) for s, i in ids.items() if s not in self.added}
        by_id |= {i: s.encode() for s, i in self.added.items()}
        self.strings = np.array([by_id.get(i, b"") for i in range(max(by_id) + 1)], object)
        # a merge is known by its rank: the pair (left << 32 | right) and the id that it makes
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        self.pair: list[int] = []
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.pair.append(ids[a] << 32 | ids[b])
            self.made.append(ids[a + b])
            self.rank[self.pair[-1]] = rank


def merge(symbols: list[int], v: Vocabulary) -> list[int]:
    """Ids after all merges of one piece.  A heap entry is rank << 32 | place."""
    n = len(symbols)
    get, pair, made = v.rank.get, v.pair, v.made
    heap = []
    for i in range(n - 1):
        r = get(symbols[i] << 32 | symbols[i + 1])
        if r is not None:
            heap.append(r << 32 | i)
    if not heap:
        return symbols
    heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    symbols.append(-1)  # the end: pairs with nothing
    while heap:
        entry = heappop(heap)
        i, r = entry & 0xFFFFFFFF, entry >> 32
        j = after[i]
        if symbols[i] << 32 | symbols[j] != pair[r]:
            continue  # stale: one of the two symbols has merged since
        new = symbols[i] = made[r]
        symbols[j] = -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            r = get(new << 32 | symbols[k])
            if r is not None:
                heappush(heap, r << 32 | i)
        p = before[i]
        if p >= 0:
            r = get(symbols[p] << 32 | new)
            if r is not None:
                heappush(heap, r << 32 | p)
    return [s for s in symbols if s >= 0]


class Kept:
    """Ids by string in two generations: when the young one is full it becomes the old one."""

    def __init__(self, most: int):
        self.most = most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def put(self, key: str, ids: bytes) -> bytes:
        if len(key) <= CACHE_CHARS:
            if len(self.young) >= self.most:
                self.old, self.young = self.young, {}
            self.young[key] = ids
        return ids


class Encoder:
    """Encodes texts.  A unit, a blank and all up to the next blank before a
    character that is no white space, is cut into pieces alike wherever it
    stands, so whole units are kept too."""

    def __init__(self, vocabulary: Vocabulary, cache_pieces: int = CACHE_PIECES):
        self.v = vocabulary
        self.find = regex.compile(PATTERN).findall
        self.split = regex.compile("|".join(map(regex.escape, sorted(vocabulary.added, key=len, reverse=True)))) \
            if vocabulary.added else None
        self.pieces, self.units = Kept(cache_pieces), Kept(cache_pieces)

    def piece(self, piece: str) -> bytes:
        ids = self.v.byte_ids
        return self.pieces.put(piece, array("I", merge([ids[b] for b in piece.encode()], self.v)).tobytes())

    def unit(self, unit: str, blank: bool) -> bytes:
        if blank and unit in self.units.old:
            return self.units.put(unit, self.units.old[unit])
        get, old = self.pieces.young.get, self.pieces.old
        out = []
        for p in self.find(" " + unit if blank else unit):
            ids = get(p)
            if ids is None:
                ids = self.pieces.put(p, old[p]) if p in old else self.piece(p)
            out.append(ids)
        ids = b"".join(out)
        return self.units.put(unit, ids) if blank and unit else ids

    def plain(self, text: str) -> bytes:
        if not text:
            return b""
        units = (BLANK_START.split(text) if BLANK_RUN.search(text) or text[-1] == " " else text.split(" "))
        first = self.unit(units.pop(0), False)
        found = list(map(self.units.young.get, units))
        if None in found:
            unit = self.unit
            found = [f or unit(u, True) for f, u in zip(found, units)]
        return first + b"".join(found)

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.split is None or not any(s in text for s in self.v.added):
            return self.plain(text)
        out, at = [], 0
        for m in self.split.finditer(text):
            out += [self.plain(text[at:m.start()]), array("I", [self.v.added[m.group()]]).tobytes()]
            at = m.end()
        return b"".join([*out, self.plain(text[at:])])

    def decode(self, ids: bytes) -> str:
        return b"".join(self.v.strings[np.frombuffer(ids, "<u4")].tolist()).decode("utf-8", "replace")


def encode_texts(docs: DataFrame, tokenizer: str, text_col: str = "text", digests: bool = False,
                 keep: list[str] | None = None) -> DataFrame:
    """``docs`` with n_tokens and either bpe_ids (array<int>) and bpe_text (the ids
    decoded), or their digests ids_sha256 and decoded_sha256.  ``tokenizer`` is the
    path of a byte-level tokenizer file on the driver; its tables (as large as the
    file) are broadcast."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(tokenizer))

    def make():
        encoder = kept(("bpe", tokenizer), lambda: Encoder(vocabulary.value))

        def fn(texts):
            n, first, second = [], [], []
            for t in texts:
                ids = encoder.encode(t)
                text = encoder.decode(ids)
                n.append(len(ids) // 4)
                first.append(sha256_hex(ids) if digests else array("I", ids).tolist())
                second.append(sha256_hex(text.encode()) if digests else text)
            return [n, first, second]

        return fn

    columns = "ids_sha256 string, decoded_sha256 string" if digests else "bpe_ids array<int>, bpe_text string"
    return add_columns(docs, [text_col], f"n_tokens long, {columns}", make, keep)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def report(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The contract's columns of a documents table."""
    return encode_texts(docs, tokenizer or default_tokenizer(), digests=True, keep=["doc_id"]).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
