"""Supervised subword embeddings: the model behind the quality and toxicity classifiers.

A word's features are its own hashed vector and those of its character
n-grams (with word boundary marks); a segment's vector is the average over
the features of all its words, and a linear softmax over it gives the
classes.  Vectors and output weights are learned jointly by plain stochastic
gradient descent in numpy.

Scoring needs no vectors: with the output layer applied, each word adds a
fixed amount to the logit, so a task keeps one number pair for each word.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import add_columns, crc_mod, kept

KEPT_WORDS = 200_000


@dataclass(frozen=True)
class Settings:
    """Fixed by each classifier.  ``sample`` bounds the labelled documents of class 0 and of
    class 1 that a model is fitted on."""

    sample: tuple[int, int] = (2000, 2000)
    buckets: int = 1 << 16
    dim: int = 12
    grams: tuple[int, int] = (2, 4)
    epochs: int = 6
    steps: int = 6000
    rate: float = 0.3
    out_rate: float = 0.1
    least_texts: int = 1
    adaptive: bool = False
    each: int = 8  # segments of a class 0 text in one pass: all but one of them the likeliest for class 1
    top: int = 3  # likeliest segments that a class 1 text stands for
    lower: bool = False
    segment: int = 0  # words in a segment; 0: the whole text is one
    repeats: bool = False  # a feature for a word that equals the one before it
    seed: int = 13


def word_features(word: str, s: Settings) -> list[int]:
    """Buckets of the word and of its n-grams; bucket 0 is the repeat mark."""
    marked, crc, most = f"<{word}>".encode(), zlib.crc32, s.buckets - 1
    size = len(marked)
    return [crc(marked) % most + 1] + [crc(marked[i:i + n], n) % most + 1 for n in range(s.grams[0], s.grams[1] + 1)
                                       for i in range(size - n + 1)]


def words_of(text: str | None, s: Settings) -> list[str]:
    return (text.lower() if s.lower else text).split() if text else []


def starts(words: int, s: Settings) -> np.ndarray:
    """Where the segments of so many words start: even parts of about ``segment`` words, one at least."""
    n = max(1, round(words / s.segment)) if s.segment else 1
    return words * np.arange(n) // n


@dataclass(frozen=True)
class Example:
    """The segments of a text, one after the other: features, their shares of the segment's
    average, and the bounds."""

    ids: np.ndarray
    shares: np.ndarray
    bounds: np.ndarray

    def segment(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.bounds[k], self.bounds[k + 1])
        return self.ids[part], self.shares[part]

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean of all segments."""
        ids, at = np.unique(self.ids, return_inverse=True)
        return ids, np.bincount(at, self.shares, len(ids)) / (len(self.bounds) - 1)


class Model:
    """Embedding rows and the logit of class 1 over class 0."""

    def __init__(self, settings: Settings):
        rng = np.random.default_rng(settings.seed)
        self.s = settings
        self.rows = rng.uniform(-1, 1, (settings.buckets, settings.dim)) / settings.dim
        self.out = np.zeros((settings.dim, 2))
        self.bias = np.zeros(2)

    def examples(self, texts: list[str | None]) -> list[Example]:
        s = self.s
        features: dict[str, array] = {}
        data = []
        for t in texts:
            words = words_of(t, s)
            first = starts(len(words), s).tolist()
            mine = []
            for a, b in zip(first, first[1:] + [len(words)]):
                ids: list[int] = []
                for w in words[a:b]:
                    f = features.get(w)
                    if f is None:
                        f = features[w] = array("i", word_features(w, s))
                    ids += f
                if s.repeats:
                    ids += [0] * sum(map(eq, words[a:b], words[a + 1:b]))
                u, c = np.unique(np.array(ids, np.int64), return_counts=True)
                mine.append((u.astype(np.int32), c / max(1, len(ids))))
            # three arrays a text, not two a segment
            data.append(Example(np.concatenate([u for u, _ in mine]), np.concatenate([w for _, w in mine]),
                                np.cumsum([0] + [len(u) for u, _ in mine])))
        # a bucket of fewer texts would only help to learn those by heart
        texts_with = np.zeros(s.buckets, np.int64)
        for x in data:
            texts_with[np.unique(x.ids)] += 1
        common = texts_with >= s.least_texts
        self.rows[~common] = 0
        for i, x in enumerate(data):
            kept_ids = common[x.ids]
            data[i] = Example(x.ids[kept_ids], x.shares[kept_ids], np.concatenate(([0], np.cumsum(kept_ids)))[x.bounds])
        return data

    def fit(self, texts: list[str | None], labels: list[int]) -> "Model":
        return self.descend(self.examples(texts), labels)

    def gaps(self, x: Example) -> np.ndarray:
        """Logit of class 1 over class 0 of each segment, without the bias."""
        each = (self.rows[x.ids] @ (self.out[:, 1] - self.out[:, 0])) * x.shares
        return np.diff(np.concatenate(([0.0], np.cumsum(each)))[x.bounds])

    def lesson(self, x: Example, y: int, first_pass: bool, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
        """What one pass learns from a text.

        A text of several segments is averaged as a whole in the first pass,
        which finds the features that texts of class 1 share.  After it, a text of
        class 1 stands for its likeliest segments (it is toxic by its passages)
        and one of class 0 for those of its segments that are likeliest mistaken.
        """
        n, s = len(x.bounds) - 1, self.s
        if n == 1:
            return [(x.ids, x.shares)]
        if first_pass:
            return [x.whole()]
        order = np.argsort(self.gaps(x), kind="stable")
        if y == 1:
            order = order[-s.top:]
        elif n > s.each:
            order = np.append(order[n - s.each + 1:], rng.choice(order[:n - s.each + 1]))
        return [x.segment(k) for k in order]

    def descend(self, data: list[Example], labels: list[int]) -> "Model":
        """Stochastic gradient descent over whole texts or segments."""
        s, rng = self.s, np.random.default_rng(self.s.seed + 1)
        # a small sample is gone through more often
        epochs = max(s.epochs, min(25, -(-s.steps // max(1, len(data)))))
        total, step = epochs * len(data), 0
        seen, seen_out = np.full(s.buckets, 1e-12), np.full(s.dim, 1e-12)
        for epoch in range(epochs):
            for i in rng.permutation(len(data)):
                decay = 1 - step / total
                step += 1
                y = labels[i]
                for u, w in self.lesson(data[i], y, epoch == 0, rng):
                    if not len(u):
                        continue
                    rows = self.rows[u]
                    h = w @ rows
                    z = h @ self.out + self.bias
                    p = np.exp(z - z.max())
                    p /= p.sum()
                    p[y] -= 1
                    grad = self.out @ p
                    self.bias -= decay * s.out_rate * p
                    if s.adaptive:  # a step of its own for each row, so that rare features learn as fast
                        seen_out += (h * h) * (p @ p) / 2
                        self.out -= decay * s.out_rate * np.outer(h / np.sqrt(seen_out), p)
                        seen[u] += w * w * (grad @ grad) / s.dim
                        self.rows[u] = rows - np.outer(decay * s.rate * w / np.sqrt(seen[u]), grad)
                    else:  # a step that moves the logits alike for short, long and repetitive texts
                        self.out -= decay * s.out_rate * np.outer(h, p)
                        self.rows[u] = rows - np.outer(w * (decay * s.rate / (w @ w)), grad)
        return self

    def compact(self) -> bytes:
        """The gap of the two logits by bucket, and the bias, as float32."""
        gap = self.rows @ (self.out[:, 1] - self.out[:, 0])
        return np.append(gap, self.bias[1] - self.bias[0]).astype("<f4").tobytes()


class Scorer(dict):
    """Word -> (sum of its features' logits) + (their number)j; the words met last are kept,
    in two generations."""

    def __init__(self, compact: bytes, settings: Settings):
        super().__init__()
        self.gap = np.frombuffer(compact, "<f4").tolist()
        self.s, self.bias, self.same = settings, self.gap[-1], complex(self.gap[0], 1)
        self.old: dict[str, complex] = {}

    def __missing__(self, word: str) -> complex:
        value = self.old.get(word)
        if value is None:
            f = word_features(word, self.s)
            value = complex(sum(map(self.gap.__getitem__, f)), len(f))
        if len(word) <= 64:
            if len(self) >= KEPT_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = value
        return value

    def score(self, text: str | None) -> float:
        """Probability of class 1; the highest of the segments."""
        words = words_of(text, self.s)
        first = starts(len(words), self.s)
        if len(first) == 1:
            total = sum(map(self.__getitem__, words), 0j)
            if self.s.repeats:
                total += self.same * sum(map(eq, words, words[1:]))
            best = total.real / max(1.0, total.imag)
        else:
            values = np.fromiter(map(self.__getitem__, words), np.complex128, len(words))
            if self.s.repeats:
                again = np.fromiter(map(eq, words[1:], words), bool, len(words) - 1)
                again[first[1:] - 1] = False
                values[1:] += self.same * again
            parts = np.add.reduceat(values, first)
            best = (parts.real / np.maximum(1.0, parts.imag)).max()
        return float(1 / (1 + np.exp(-np.clip(best + self.bias, -60, 60))))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, fold: Callable, sample: tuple[int, int],
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, y) of at most ``sample[y]`` labelled documents of the learning fold for each
    class y, spread by a hash of the id.  An id labelled both ways is left out; of an id's rows the
    least text counts, so that repeated rows cannot fill the one task that learns."""
    known = (labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & fold(labels))
             .groupBy(F.col(id_col).alias("labelled_id"))
             .agg(F.max(label).cast("int").alias("y"), F.min(label).cast("int").alias("z"))
             .where("y = z").select("labelled_id", "y"))
    order = [F.xxhash64("labelled_id"), F.col("labelled_id")]
    chosen = (known.where("y = 0").orderBy(*order).limit(sample[0])
              .unionByName(known.where("y = 1").orderBy(*order).limit(sample[1])))
    return (docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t"))
            .join(F.broadcast(chosen), F.col("id") == F.col("labelled_id"))
            .groupBy("id", "y").agg(F.min("t").alias("t")).select("id", "t", "y"))


def fit(rows: DataFrame, settings: Settings) -> bytes:
    """Fit on (id, t, y) in one task; the sample's bound bounds it."""

    def run(batches):
        rows = sorted(((r["id"], r["t"] or "", r["y"]) for b in batches for r in b.to_pylist()),
                      key=lambda r: (zlib.crc32(str(r[0]).encode()), r))
        if rows:
            model = Model(settings).fit([r[1] for r in rows], [r[2] for r in rows]).compact()
            yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])

    found = rows.repartition(1).mapInArrow(run, "model binary").collect()
    if found:
        return bytes(found[0]["model"])
    # nothing to learn from: every score is one half
    return np.zeros(settings.buckets + 1, "<f4").tobytes()


def score_texts(docs: DataFrame, model: bytes, settings: Settings, text_col: str, out: str,
                keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the probability of class 1 as column ``out``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = kept(("subword", zlib.crc32(sent.value)), lambda: Scorer(sent.value, settings))
        return lambda texts: [[scorer.score(t) for t in texts]]

    return add_columns(docs, [text_col], f"`{out}` double", make, keep)


def learning_fold(modulus: int, held_out: int, id_col: str = "doc_id"):
    """Condition of the rows that may be learned from: crc32 of the id as text, modulo, is not ``held_out``."""
    return lambda df: crc_mod(id_col, modulus) != held_out
