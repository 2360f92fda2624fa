"""The fixed lexers over a whole Arrow batch, in numpy.

``regexp_extract_all`` makes a match object for every token; here the bytes of a batch
are classified at once.  A token is an identifier, a run of digits or any single other
character that is not white space, as of ``tokenize.CODE_TOKEN_PATTERN`` and
``sequences.SEQ_TOKEN_PATTERN``, which the tests compare.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

# Bytes of an Arrow batch of texts, and of text whose classes a task holds at once.
BATCH_BYTES = 8 << 20
CHUNK_BYTES = 256 << 10

SPACE, LETTER, DIGIT, OTHER, INNER = range(5)  # INNER: a byte within a character
# White space beyond ASCII as Python sees it (``text.PY_WS``).
WIDE_SPACES = tuple(chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def small_batches() -> None:
    """Batches to Python are bounded by bytes, whatever the length of a text (runtime SQL setting)."""
    if spark := SparkSession.getActiveSession():
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def byte_classes(spaces: bytes) -> np.ndarray:
    classes = np.full(256, OTHER, np.uint8)
    classes[0x80:0xC0] = INNER
    classes[list(spaces)] = SPACE
    classes[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz_")] = LETTER
    classes[list(b"0123456789")] = DIGIT
    return classes


CODE_CLASSES = byte_classes(b"\t\n\x0b\f\r ")
PY_CLASSES = byte_classes(bytes([*range(9, 14), *range(28, 33)]))


def occurrences(data: np.ndarray, ends: np.ndarray, word: bytes, at: np.ndarray) -> np.ndarray:
    """Those of the places ``at`` where ``word`` stands whole within one text; ``ends`` are the ends of all texts."""
    at = at[at + len(word) <= len(data)]
    for i, byte in enumerate(word):
        at = at[data[at + i] == byte]
    return at[at + len(word) <= ends[np.searchsorted(ends, at, "right")]]


def lex(texts: pa.Array, classes: np.ndarray = CODE_CLASSES, markers: tuple[bytes, ...] = (),
        wide_spaces: tuple[bytes, ...] = ()) -> pa.Array:
    """The tokens of each text as a list of strings, null for null; ``markers`` (from '<' to '>') are tokens of their own."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    base = int(offsets[0])
    content = texts.buffers()[2]
    data = np.frombuffer(content, np.uint8)[base:int(offsets[-1])] if content is not None else np.empty(0, np.uint8)
    offsets = offsets.astype(np.int64) - base
    cls = classes[data]
    ends = offsets[1:]
    for space in wide_spaces:
        for i in range(len(space)):
            if i == 0:
                at = occurrences(data, ends, space, np.flatnonzero(data == space[0]))
            cls[at + i] = SPACE
    before = np.empty_like(cls)
    before[1:], before[:1] = cls[:-1], SPACE
    before[offsets[:-1][ends > offsets[:-1]]] = SPACE
    letter, after_digit = cls == LETTER, before == DIGIT
    word, after_word = letter | (cls == DIGIT), (before == LETTER) | after_digit
    start = (cls == OTHER) | (word & ~after_word)
    # digits that begin a word end where its first letter stands
    turns = np.flatnonzero(letter & after_digit)
    if len(turns):
        words = np.flatnonzero(word & ~after_word)
        begin = words[np.searchsorted(words, turns, "right") - 1]
        letters = np.cumsum(letter, dtype=np.int32)
        start[turns[(letters[turns] - letters[begin] == 1) & ~letter[begin]]] = True
    if markers:
        opened = np.flatnonzero(data == ord("<"))
        for marker in markers:
            at = occurrences(data, ends, marker, opened)
            for i in range(1, len(marker)):
                start[at + i] = False
    kept = cls != SPACE
    to = np.append(np.flatnonzero(start[kept]), np.count_nonzero(kept)).astype(np.int32)
    strings = pa.StringArray.from_buffers(len(to) - 1, pa.py_buffer(to), pa.py_buffer(data[kept]))
    upto = np.append(0, np.cumsum(np.add.reduceat(np.append(start, False), offsets[:-1], dtype=np.int64) * (ends > offsets[:-1]))
                     if len(texts) else []).astype(np.int32)
    mask = pc.is_null(texts) if texts.null_count else None
    return pa.ListArray.from_arrays(pa.array(upto), strings, mask=mask)


def chunks(texts: pa.Array):
    """``texts`` in slices of about CHUNK_BYTES, at least one text each."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        done = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, done + CHUNK_BYTES, "right")))
        yield texts.slice(start, stop - start)
        start = stop


def lexed(texts: pa.Array, *how) -> pa.Array:
    """``lex`` in chunks."""
    parts = [lex(part, *how) for part in chunks(texts.cast(pa.string()))]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))
