"""Quality classifier: supervised subword embeddings averaged per document.

Words keep their case and punctuation; a word that equals the one before it
adds a learned repeat feature, so that stuttering texts of unseen words are
known.  See ``subword`` for the model.

Defined results: null and empty texts have no features and get the score of
the model's bias; a null id is in no fold (held_out is null); labels that are
null, of unknown documents or contradictory teach nothing; without labels
every score is one half; repeated rows are scored one by one; extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import boxed, crc_mod, unboxed
from corpusmill.llm.subword import Settings, fit, labelled_sample, learning_fold, score_texts

SETTINGS = Settings(sample=(1000, 2000), buckets=1 << 16, dim=12, grams=(2, 4), epochs=3, rate=0.3, out_rate=0.1,
                    repeats=True)
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0


def train(docs: DataFrame, labels: DataFrame, settings: Settings = SETTINGS) -> bytes:
    """A model fitted on at most ``settings.sample`` labelled documents of the learning folds."""
    fold = learning_fold(FOLDS, HELD_OUT)
    return fit(labelled_sample(docs, labels, "quality", fold, settings.sample), settings)


def score(docs: DataFrame, model: bytes, text_col: str = "text", out: str = "quality_score",
          keep: list[str] | None = None, settings: Settings = SETTINGS) -> DataFrame:
    """``docs`` with the probability that a text is good."""
    return score_texts(docs, model, settings, text_col, out, keep)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns of a documents table."""
    scored = score(docs, train(docs, labels), out="score", keep=["doc_id"])
    return scored.select("doc_id", (crc_mod("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, unchanged."""
    scored = score(boxed(docs, text="text"), train(docs, labels), out="score", keep=["row"])
    return unboxed(scored.where(F.col("score") >= threshold))
