"""Token counts under a unigram vocabulary, by a count-only Viterbi.

An Aho-Corasick automaton enumerates all vocabulary pieces in a segment;
dynamic programming carries, for each position, only the best score and the
number of pieces behind it.  Of equal scores the path found first stays:
starts go up, and a piece from an earlier start is not displaced by an equal
one, as in the unigram model of the public ``tokenizers`` library.  A character that no piece covers
becomes an unknown piece, ten below the lowest score, or its bytes if the
vocabulary has byte pieces.

Blanks become the mark U+2581 and one is put in front of the text.  As no
piece of the vocabulary has a mark after another character, a text is cut
before each run of marks and segments are counted on their own; a worker
keeps the counts of segments.  Scores are added in double precision.

The pieces and scores come from a tokenizer file whose path is a parameter;
the file at hand holds a merge vocabulary with scores, which is used here as
a unigram vocabulary.

Defined results: null and empty texts have no tokens; repeated rows are
counted one by one; a very long unbroken text is one segment, of which only the
length of the longest piece is held beside the text and the automaton's copy of it; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
from pyspark.sql import DataFrame

from corpusmill.llm.common import add_columns, kept

MARK = "▁"
SEGMENT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
KEPT_SEGMENTS = 300_000
#: Longer segments are counted in bounded memory, and not kept.
KEPT_CHARS = 64
# Fixed values of the file format: types of pieces, and what an unknown piece scores below the lowest.
NORMAL, USER_DEFINED, BYTE = 1, 4, 6
UNKNOWN_PENALTY = 10.0


@dataclass(frozen=True)
class Unigram:
    pieces: tuple[tuple[str, float], ...]
    byte_fallback: bool
    add_prefix: bool

    @classmethod
    def read(cls, path: str) -> "Unigram":
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kinds = {p.type for p in model.pieces}
        if USER_DEFINED in kinds or model.normalizer_spec.name != "identity" \
                or model.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only plain vocabularies without text normalization are read")
        pieces = tuple((p.piece, p.score) for p in model.pieces if p.type == NORMAL)
        if any(MARK in p.lstrip(MARK) for p, _ in pieces):
            raise ValueError("a piece crosses the start of a word")
        return cls(pieces, BYTE in kinds, model.normalizer_spec.add_dummy_prefix)


class Counter:
    def __init__(self, vocabulary: Unigram):
        self.v = vocabulary
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        self.longest = max((len(p) for p, _ in vocabulary.pieces), default=1)
        self.kept: dict[str, int] = {}

    def ends(self, s: str) -> Iterable[list[tuple[int, float]]]:
        """The pieces that end at each character; those of a long segment one character after the other."""
        if len(s) <= KEPT_CHARS:
            out: list[list[tuple[int, float]]] = [[] for _ in s]
            for last, piece in self.automaton.iter(s):
                out[last].append(piece)
            return out
        matches = self.automaton.iter(s)  # in order of their ends
        return self.streamed(len(s), matches)

    @staticmethod
    def streamed(n: int, matches) -> Iterator[list[tuple[int, float]]]:
        last, piece = next(matches, (-1, None))
        for end in range(n):
            ending = []
            while last == end:
                ending.append(piece)
                last, piece = next(matches, (-1, None))
            yield ending

    def segment(self, s: str) -> int:
        score, count, unknown_before = [0.0], [0], [False]
        gone, most = 0, self.longest + KEPT_CHARS  # no piece reaches further back than the longest one
        for end, ending in enumerate(self.ends(s), 1):
            best, pieces, by_unknown = None, 0, False
            single = False
            for length, value in sorted(ending, reverse=True):  # earlier starts first
                single |= length == 1
                total = score[end - length - gone] + value
                if best is None or total > best:
                    best, pieces, by_unknown = total, count[end - length - gone] + 1, False
            if not single:
                total = score[-1] + self.unknown
                if best is None or total > best:
                    if self.v.byte_fallback:
                        more = len(s[end - 1].encode())
                    else:  # neighbouring unknown characters are one piece
                        more = 0 if unknown_before[-1] else 1
                    best, pieces, by_unknown = total, count[-1] + more, True
            score.append(best)
            count.append(pieces)
            unknown_before.append(by_unknown)
            if len(score) > most:
                gone += KEPT_CHARS
                del score[:KEPT_CHARS], count[:KEPT_CHARS], unknown_before[:KEPT_CHARS]
        return count[-1]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        marked = text.replace(" ", MARK)
        total = 0
        get = self.kept.get
        for s in SEGMENT.findall(MARK + marked if self.v.add_prefix else marked):
            n = get(s)
            if n is None:
                n = self.segment(s)
                if len(s) <= KEPT_CHARS:
                    if len(self.kept) >= KEPT_SEGMENTS:
                        self.kept.clear()
                    self.kept[s] = n
            total += n
        return total


def count_tokens(docs: DataFrame, tokenizer: str, text_col: str = "text", out: str = "n_tokens",
                 keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the number of tokens of each text; ``tokenizer`` is a vocabulary file's path on
    the driver, whose pieces are broadcast."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Unigram.read(tokenizer))

    def make():
        counter = kept(("tokens", tokenizer), lambda: Counter(vocabulary.value))
        return lambda texts: [[counter.count(t) for t in texts]]

    return add_columns(docs, [text_col], f"`{out}` long", make, keep)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def report(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) of a documents table."""
    return count_tokens(docs, tokenizer or default_tokenizer(), keep=["doc_id"]).select("doc_id", "n_tokens")
