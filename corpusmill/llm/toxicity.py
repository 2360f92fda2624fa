"""Toxicity: subword-bag embeddings averaged into a linear softmax.

Words are lower-cased; their character n-grams share vectors, so a
misspelling of a toxic word is near it.  The texts that hold one need not hold
much of it, so the average runs over segments of about three words and the
likeliest one counts: a toxic passage weighs the same in a short and in a long
text.  The first pass learns from averages of whole texts, the later ones from
the likeliest segments of both classes.  Buckets that few of the learning texts
have are left out.  See ``subword`` for the model.

Defined results: null and empty texts get the score of the model's bias; a null
id is in no fold (held_out is null); labels that are null, of unknown documents or
contradictory teach nothing, and without labels every score is one half; repeated
rows are scored one by one, and of an id's rows the least text is learned from;
very long texts are read whole, in time and memory proportional to their words;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import crc_mod
from corpusmill.llm.subword import Settings, fit, labelled_sample, learning_fold, score_texts

SETTINGS = Settings(sample=(2500, 1500), buckets=1 << 17, dim=12, grams=(3, 5), epochs=5, rate=0.3, out_rate=0.3,
                    lower=True, segment=3, adaptive=True, least_texts=5)
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1


def train(docs: DataFrame, labels: DataFrame, settings: Settings = SETTINGS) -> bytes:
    """A model fitted on at most ``settings.sample`` labelled documents of the learning folds."""
    fold = learning_fold(FOLDS, HELD_OUT)
    return fit(labelled_sample(docs, labels, "toxic", fold, settings.sample), settings)


def score(docs: DataFrame, model: bytes, text_col: str = "text", out: str = "toxic_score",
          keep: list[str] | None = None, settings: Settings = SETTINGS) -> DataFrame:
    """``docs`` with the probability that a text is toxic."""
    return score_texts(docs, model, settings, text_col, out, keep)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns of a documents table."""
    scored = score(docs, train(docs, labels), out="score", keep=["doc_id"])
    return scored.select("doc_id", (crc_mod("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
