"""Packing of documents into windows of at most 2048 ids, by multiway differencing.

A task tokenizes its documents one after the other.  What fills whole windows
of its own is cut off a document; the rest, in pieces of at most CUT ids, is
gathered until it would fill GROUP_WINDOWS windows, and is then divided by
Karmarkar and Karp's multiway differencing: each piece begins as a partial
partition of k windows, all empty but one; the two partitions whose windows
differ most are merged, the fullest window of one with the emptiest of the
other, until one partition is left, whose windows are nearly equal.  If one of
them exceeds the capacity, k rises by one.  The emptiest windows, as many as
the sum of all pieces does not need, are then cut up to fill the gaps of the
others; what is left of them opens the next group.  At a task's end it goes
to sequences whose lengths are powers of two, which are not padded.  So no
sequence has padding, a document is cut only where its pieces are, and no
rows are shuffled: a frequent id, a hot source or a large group of copies
makes no task larger.

Ids are those of the public ``tokenizers`` library.  Its pre-tokenization cuts
texts into pieces that no token crosses; a worker keeps the ids of the pieces
that it met last, and of units between white space where a text has
characters that need the library's own rules.

Defined results: a null text is empty; an empty text is its end id alone, one
piece of one id; repeated rows are documents of their own; a null id is an id;
very long texts fill windows of their own; the empty table gives none; extra
columns are not read.  Sequence ids are unique, not dense: a task's number and
the sequence's in it.
"""

from __future__ import annotations

import json
import re
from array import array
from bisect import insort
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from zlib import crc32

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusmill.llm.bpe import Kept, byte_letters
from corpusmill.llm.common import kept, small_batches

# Fixed values of the contract: the window and the id that ends a document.
WINDOW, END_ID = 2048, 1
CUT = 512
GROUP_WINDOWS = 256
KEPT_UNITS = 100_000
#: Rows of one Arrow batch.
BATCH_ROWS = 10_000

# The pre-tokenization and normalization that the tokenizer file must have.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
#: Texts of these characters are in normal form, and the pattern is PLAIN_PIECES on them.
PLAIN = re.compile("[\t\n\r\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-įı-ňŊ-ſ]*")
PLAIN_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-ſ]+|[0-9]|[^\t\n\r\x20a-z0-9\xdf-\xf6\xf8-ſ]+")
#: Other texts are cut at white space of which there is no doubt.
SPACE = re.compile("[ \t\n\r]+")


class UnitEncoder:
    """Ids of texts under a tokenizer that drops white space."""

    def __init__(self, file: str, keep: int = KEPT_UNITS):
        from tokenizers import Tokenizer

        told = json.loads(file)
        kinds = [n["type"] for n in (told["normalizer"] or {}).get("normalizers", [])]
        pre = (told["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        if kinds != NORMALIZERS or pre.get("pattern", {}).get("Regex") != PATTERN or pre.get("behavior") != "Removed":
            raise ValueError("not a tokenizer file that drops white space between words")
        self.tokenizer = Tokenizer.from_str(file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = [t["content"] for t in told["added_tokens"]]
        self.letters = byte_letters()
        self.units, self.pieces = Kept(keep), Kept(3 * keep)

    def ids(self, letters: str) -> bytes:
        """Ids of one piece in the letters that stand for bytes."""
        return array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def piece(self, piece: str) -> bytes:
        ids = self.pieces.old.get(piece)
        if ids is None:
            ids = self.ids(piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters))
        return self.pieces.put(piece, ids)

    def plain(self, text: str) -> bytes:
        pieces = PLAIN_PIECES.findall(text.lower())
        found = list(map(self.pieces.young.get, pieces))
        if None in found:
            piece = self.piece
            found = [f or piece(p) for f, p in zip(found, pieces)]
        return b"".join(found)

    def unit(self, unit: str) -> bytes:
        ids = self.units.young.get(unit, self.units.old.get(unit))
        if ids is None:
            if any(a in unit for a in self.added):
                ids = array("I", self.tokenizer.encode(unit, add_special_tokens=False).ids).tobytes()
            elif PLAIN.fullmatch(unit):
                ids = self.plain(unit)
            else:
                parts = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(unit))
                ids = b"".join([self.ids(p) for p, _ in parts])
        return self.units.put(unit, ids)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if PLAIN.fullmatch(text) and not any(a in text for a in self.added):
            return self.plain(text)
        return b"".join([self.unit(u) for u in SPACE.split(text) if u])


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """The places of ``sizes`` in k windows of nearly equal sums.

    A partial partition is a sorted list of (sum over the least sum, bag); windows
    that are not listed are empty.  A bag is a place, or a pair of bags.
    """
    bags: list = list(range(len(sizes)))
    heap = [(-s, i, [(s, i)]) for i, s in enumerate(sizes)]
    heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        (_, _, a), (_, _, b) = heappop(heap), heappop(heap)
        if len(a) < len(b):
            a, b = b, a
        if len(a) + len(b) <= k:  # the full windows of each fall on empty ones of the other
            if len(b) == 1:
                insort(a, b[0])
            else:
                a = sorted(a + b)
        else:
            full = [(0, None)] * (k - len(a)) + a
            other = b[::-1] + [(0, None)] * (k - len(b))
            a = []
            for (x, p), (y, q) in zip(full, other):
                if p is not None and q is not None:
                    bags.append((p, q))
                    p = len(bags) - 1
                a.append((x + y, q if p is None else p))
            a.sort(key=lambda w: w[0])
            least = a[0][0]
            a = [(x - least, p) for x, p in a]
        made += 1
        heappush(heap, (-a[-1][0], made, a))
    windows = []
    for _, bag in heap[0][2] if heap else []:
        items, todo = [], [bag]
        while todo:
            b = bags[todo.pop()]
            if isinstance(b, tuple):
                todo += b
            else:
                items.append(b)
        windows.append(sorted(items))
    return windows + [[] for _ in range(k - len(windows))]


Piece = tuple[int, int, int]  # document in the group, start, length


def divide(pieces: list[Piece], window: int = WINDOW) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows of pieces, and the pieces that are left, which are less than one window."""
    total = sum(p[2] for p in pieces)
    k = max(1, -(-total // window))
    while True:
        parts = difference([p[2] for p in pieces], k)
        sums = [sum(pieces[i][2] for i in part) for part in parts]
        if max(sums) <= window:
            break
        k += 1
    order = sorted(range(k), key=lambda w: -sums[w])
    needed = total // window
    spare = [pieces[i] for w in reversed(order[needed:]) for i in parts[w]]
    out = []
    for w in order[:needed]:
        mine, gap = [pieces[i] for i in parts[w]], window - sums[w]
        while gap:
            doc, start, length = spare.pop()
            taken = min(gap, length)
            mine.append((doc, start, taken))
            if taken < length:
                spare.append((doc, start + taken, length - taken))
            gap -= taken
        out.append(sorted(mine))
    return out, spare


def powers(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """The pieces in sequences whose lengths are powers of two, the longest first."""
    left, total = sorted(pieces, reverse=True), sum(p[2] for p in pieces)
    while total:
        room = 1 << total.bit_length() - 1
        total -= room
        mine = []
        while room:
            doc, start, length = left.pop()
            taken = min(room, length)
            mine.append((doc, start, taken))
            if taken < length:
                left.append((doc, start + taken, length - taken))
            room -= taken
        yield mine


class Packer:
    """Packs the documents of a task; ``documents`` holds (id, ids) of those with pieces still to be placed."""

    def __init__(self, window: int = WINDOW, cut: int = CUT, group: int = GROUP_WINDOWS, first: int = 0):
        self.window, self.cut, self.most, self.next = window, cut, group * window, first
        self.documents: list[tuple[object, bytes]] = []
        self.pieces: list[Piece] = []
        self.size = 0

    def add(self, doc_id, ids: bytes) -> Iterator[tuple]:
        n, number = len(ids) // 4, len(self.documents)
        self.documents.append((doc_id, ids))
        whole = n - n % self.window
        for start in range(0, whole, self.window):
            yield from self.sequence([(number, start, self.window)])
        self.pieces += [(number, at, min(self.cut, n - at)) for at in range(whole, n, self.cut)]
        self.size += n - whole
        if self.size >= self.most:
            windows, left = divide(self.pieces, self.window)
            for w in windows:
                yield from self.sequence(w)
            used = sorted({p[0] for p in left})
            at = {doc: i for i, doc in enumerate(used)}
            self.documents = [self.documents[doc] for doc in used]
            self.pieces = [(at[doc], start, length) for doc, start, length in left]
            self.size = sum(p[2] for p in left)
        elif whole == n:
            self.documents.pop()

    def finish(self) -> Iterator[tuple]:
        windows, left = divide(self.pieces, self.window)
        for w in [*windows, *powers(left)]:
            yield from self.sequence(w)

    def sequence(self, pieces: list[Piece]) -> Iterator[tuple]:
        """(doc_id, start, length, the piece's ids, doc_tokens, sequence_id, offset) of one sequence."""
        offset = 0
        for number, start, length in pieces:
            doc_id, ids = self.documents[number]
            yield doc_id, start, length, ids[4 * start:4 * (start + length)], len(ids) // 4, self.next, offset
            offset += length
        self.next += 1


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         end_id: int = END_ID, digests: bool = False) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset) of each piece, with ids as array<int>,
    or ids_crc32 in their place.  ``tokenizer`` is a file's path on the driver, whose text is broadcast."""
    with open(tokenizer, encoding="utf-8") as f:
        file = f.read()
    sent = docs.sparkSession.sparkContext.broadcast(file)
    ids_of = T.StructField("ids_crc32", T.LongType()) if digests else T.StructField("ids", T.ArrayType(T.IntegerType()))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    long = lambda name: T.StructField(name, T.LongType())
    schema = T.StructType([rows.schema["doc_id"], long("start"), long("length"), ids_of, long("doc_tokens"),
                           long("sequence_id"), long("offset")])
    arrow = to_arrow_schema(schema)
    small_batches(docs.sparkSession)

    def run(batches):
        encoder = kept(("packing", tokenizer), lambda: UnitEncoder(sent.value))
        packer = Packer(window, first=TaskContext.get().partitionId() << 33)
        end = array("I", [end_id]).tobytes()

        def pieces():
            for b in batches:
                for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                    yield from packer.add(doc_id, encoder.encode(text.as_py()) + end)
            yield from packer.finish()

        held = []
        for doc_id, start, length, ids, *rest in pieces():
            held.append((doc_id, start, length, crc32(ids) if digests else array("I", ids).tolist(), *rest))
            if len(held) >= BATCH_ROWS:
                yield as_batch(held)
                held = []
        if held:
            yield as_batch(held)

    def as_batch(held):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)

    return rows.mapInArrow(run, schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def report(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The contract's columns of a documents table."""
    return pack(docs, tokenizer or default_tokenizer(), digests=True)
