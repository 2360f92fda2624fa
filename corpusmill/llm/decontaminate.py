"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of documents inside a task.  Its words become symbols
(the number of the word among the benchmark's words, 0 for any other), the
benchmark's windows are searched backward through the ranks of a wavelet
tree over the shard's BWT, occurrences are located by sampled suffix
positions, and the hit spans are merged per document.

Symbol 0 occurs in no window, so runs of benchmark words shorter than the
shortest window cannot hold one; they are left out of the shard's index.
That is exact and keeps the index small.

Defined results: null and wordless texts have no words and no hits and are
not contaminated; a benchmark item without words has no window; an item
whose id is null marks words as hit but is listed nowhere; repeated
documents are judged row by row, repeated benchmark rows count once per id;
an empty benchmark leaves every document clean; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import add_columns, alnum_words, boxed, ranges, runs, unboxed

WINDOW = 13
#: A window's words are searched in blocks of so many benchmark words, one pass
#: over a shard's index for each; the driver and a task hold one block at a time.
BLOCK_WORDS = 1_000_000
#: Every so many positions of a shard the suffix position is kept.
SAMPLE = 8
#: A shard closes after so many indexed symbols.
SHARD_SYMBOLS = 400_000
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array of symbols by doubling; breaks (0) are distinct, in the order they stand."""
    n = len(text)
    n_breaks = int((text == 0).sum())
    rank = text.astype(np.int64) + n_breaks
    rank[text == 0] = np.arange(n_breaks)
    width = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - width] = rank[width:] + 1 if width < n else 0
        key = rank * (max(int(after.max(initial=0)), 1) + 1) + after
        order = np.argsort(key, kind="stable")
        step = np.empty(n, np.int64)
        step[0] = 0
        step[1:] = key[order[1:]] != key[order[:-1]]
        names = np.cumsum(step)
        if names[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = names
        width *= 2


class WaveletTree:
    """Ranks of symbols in a sequence, for arrays of queries at once."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.levels: list[tuple[int, np.ndarray, int]] = []
        for bit in reversed(range(max(1, int(sigma - 1).bit_length()))):
            ones = (seq >> bit) & 1
            zeros_before = np.concatenate(([0], np.cumsum(1 - ones))).astype(np.int32)
            self.levels.append((bit, zeros_before, int(zeros_before[-1])))
            seq = np.concatenate((seq[ones == 0], seq[ones == 1]))

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before position ``end``."""
        lo, hi = np.zeros(len(end), np.int64), end.astype(np.int64)
        for bit, zeros, total in self.levels:
            one = ((symbol >> bit) & 1).astype(bool)
            lo0, hi0 = zeros[lo], zeros[hi]
            lo = np.where(one, total + lo - lo0, lo0)
            hi = np.where(one, total + hi - hi0, hi0)
        return hi - lo


class FMIndex:
    """FM-index of a sequence of symbols below ``sigma`` in which 0 is a break.

    The sequence must start with a break.  Positions after a break and every
    SAMPLE-th position keep their suffix position, so a walk back never
    crosses a break.
    """

    def __init__(self, text: np.ndarray, sigma: int):
        order = suffix_order(text)
        self.bwt = text[order - 1]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))
        self.tree = WaveletTree(self.bwt, sigma)
        self.sampled = (order % SAMPLE == 0) | (self.bwt == 0)
        self.sample_no = np.cumsum(self.sampled) - 1
        self.samples = order[self.sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [lo, hi) of the suffixes that begin with each pattern (a row of symbols)."""
        lo, hi = self.first[patterns[:, -1]], self.first[patterns[:, -1] + 1]
        live = np.flatnonzero(lo < hi)
        for k in range(patterns.shape[1] - 2, -1, -1):
            if not len(live):
                break
            c = patterns[live, k]
            lo[live] = self.first[c] + self.tree.rank(c, lo[live])
            hi[live] = self.first[c] + self.tree.rank(c, hi[live])
            live = live[lo[live] < hi[live]]
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position of each row's suffix: walk back to a sampled one."""
        row, steps = rows.astype(np.int64), np.zeros(len(rows), np.int64)
        live = np.flatnonzero(~self.sampled[row])
        while len(live):
            c = self.bwt[row[live]]
            row[live] = self.first[c] + self.tree.rank(c, row[live])
            steps[live] += 1
            live = live[~self.sampled[row[live]]]
        return self.samples[self.sample_no[row]] + steps


class Windows:
    """The windows of one block of benchmark items, as rows of symbols."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.vocab: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item, words in items:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                mine = owners[tuple(ids[i:i + window])]
                if item is not None:
                    mine.add(item)
        by_len: dict[int, list[tuple[int, ...]]] = defaultdict(list)
        for w in owners:
            by_len[len(w)].append(w)
        #: (length, patterns, owners of each) by length
        self.groups = [(n, np.array(ws, np.int64).reshape(len(ws), n), [sorted(owners[w]) for w in ws])
                       for n, ws in sorted(by_len.items())]
        self.shortest = min(by_len, default=0)

    def hits(self, docs: list[list[bytes]]) -> tuple[list[np.ndarray | None], list[set[str]]]:
        """For each document the hit words as merged (start, end) spans, and the items that occur."""
        spans: list[np.ndarray | None] = [None] * len(docs)
        items: list[set[str]] = [set() for _ in docs]
        if not self.shortest:
            return spans, items
        lens = np.array([len(d) for d in docs], np.int64)
        offsets = np.concatenate(([0], np.cumsum(lens + 1)))  # a break after each document
        ids = np.zeros(int(offsets[-1]), np.int32)
        for d, at in zip(docs, offsets):
            if d:
                ids[at:at + len(d)] = np.fromiter(map(self.vocab.get, d, repeat(0)), np.int32, len(d))
        known = np.concatenate(([0], (ids != 0).astype(np.int8), [0]))
        edge = np.diff(known)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long_enough = end - start >= self.shortest
        start, end = start[long_enough], end[long_enough]
        # shards of whole runs of known words
        shard = np.cumsum(end - start) // SHARD_SYMBOLS
        found: list[tuple[np.ndarray, int, list[list[str]], np.ndarray]] = []
        for k in np.unique(shard):
            s, e = start[shard == k], end[shard == k]
            where = ranges(s - 1, e)  # the break before each run stands for the word there
            text = np.where(np.isin(where, s - 1), 0, ids[np.maximum(where, 0)]).astype(np.int64)
            index = FMIndex(text, len(self.vocab) + 1)
            for n, patterns, owners in self.groups:
                lo, hi = index.search(patterns)
                hit = np.flatnonzero(lo < hi)
                if len(hit):
                    at = index.locate(ranges(lo[hit], hi[hit]))
                    found.append((where[at], n, owners, np.repeat(hit, hi[hit] - lo[hit])))
        if not found:
            return spans, items
        change = np.zeros(len(ids) + 1, np.int64)
        for at, n, owners, which in found:
            np.add.at(change, at, 1)
            np.add.at(change, at + n, -1)
            doc = np.searchsorted(offsets, at, "right") - 1
            for d, w in set(zip(doc.tolist(), which.tolist())):
                items[d].update(owners[w])
        edge = np.diff(np.concatenate(([0], (np.cumsum(change) > 0).astype(np.int8), [0])))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        doc = np.searchsorted(offsets, start, "right") - 1
        for d in np.unique(doc):
            mine = doc == d
            spans[d] = np.stack([start[mine], end[mine]], 1) - offsets[d]
        return spans, items


def merge_spans(spans: np.ndarray) -> np.ndarray:
    """Union of (start, end) rows as sorted disjoint rows."""
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    far = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate(([True], spans[1:, 0] > far[:-1]))
    at = np.flatnonzero(new)
    return np.stack([spans[at, 0], far[np.append(at[1:] - 1, len(spans) - 1)]], 1)


def character_spans(text: str, spans: np.ndarray) -> list[tuple[int, int]]:
    """Code point spans, end exclusive, from the first to the last word of each word span."""
    words = [m.span() for m in WORD.finditer(text)]
    return [(words[a][0], words[b - 1][1]) for a, b in spans]


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int):
    """The benchmark's items in blocks of about ``block_words`` words, one at a time."""
    block, size = [], 0
    for r in benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        words = alnum_words(r["t"])
        if not words:
            continue
        block.append((r["i"], words))
        size += len(words)
        if size >= block_words:
            yield block
            block, size = [], 0
    if block:
        yield block


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "item_id",
                  bench_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
                  keep: list[str] | None = None) -> DataFrame:
    """``docs`` (columns ``keep``, default all) with bench_words, bench_hits,
    bench_items (item ids sorted as strings), bench_spans (merged code point
    spans to remove) and bench_contaminated.

    Every benchmark block is one more search of each shard inside the same
    narrow pass; its windows reach the tasks as a broadcast bounded by
    ``block_words``.
    """
    sc = docs.sparkSession.sparkContext
    blocks = [sc.broadcast(b) for b in benchmark_blocks(benchmark, id_col, bench_text_col, block_words)]

    def make():
        ready = Windows(blocks[0].value, window) if len(blocks) == 1 else None

        def fn(texts):
            n_words, n_hits, items, cut, bad = [], [], [], [], []
            for a, b in runs(texts):
                part = [alnum_words(t) for t in texts[a:b]]
                spans: list[list[np.ndarray]] = [[] for _ in part]
                named: list[set[str]] = [set() for _ in part]
                for block in blocks:
                    found, who = (ready or Windows(block.value, window)).hits(part)
                    for k, (s, w) in enumerate(zip(found, who)):
                        if s is not None:
                            spans[k].append(s)
                            named[k] |= w
                for text, words, s, who in zip(texts[a:b], part, spans, named):
                    merged = merge_spans(np.concatenate(s)) if s else None
                    hit = int((merged[:, 1] - merged[:, 0]).sum()) if s else 0
                    n_words.append(len(words))
                    n_hits.append(hit)
                    items.append(sorted(who))
                    cut.append([{"start": x, "end": y} for x, y in character_spans(text, merged)] if s else [])
                    bad.append(hit > 0 and 20 * hit >= len(words))
            return [n_words, n_hits, items, cut, bad]

        return fn

    return add_columns(
        docs, [text_col],
        "bench_words long, bench_hits long, bench_items array<string>, "
        "bench_spans array<struct<start:int,end:int>>, bench_contaminated boolean", make, keep)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns of a documents table."""
    out = decontaminate(docs, benchmark, keep=["doc_id"])
    return out.select(
        "doc_id", F.col("bench_words").alias("n_words"), F.col("bench_hits").alias("n_hit"),
        F.size("bench_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("bench_items", ","), 256).alias("items_sha256"),
        F.col("bench_contaminated").alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated, unchanged."""
    out = decontaminate(boxed(docs, text=text_col), benchmark, keep=["row"])
    return unboxed(out.where(~F.col("bench_contaminated")))


ORACLE_SQL = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
bench AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS win, len(ws[i:i + {WINDOW - 1}]) AS n
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - {WINDOW - 1}, 1) + 1)) AS i FROM bench WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT n FROM wins),
places AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, n, ws, unnest(range(1, len(ws) - n + 2)) AS i FROM words, lens WHERE len(ws) >= n)),
hits AS (SELECT p.doc_id, p.i, p.n, w.item_id FROM places p JOIN wins w USING (win, n)),
hit_words AS (SELECT doc_id, count(DISTINCT place) AS n_hit
              FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
              FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM words w LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
