"""Prediction scoring (PRJ15-PRJ16, MET1, AGG13-AGG14, JN10), native throughout.

Edit similarity is the indel ratio: 2 * LCS / total length, rounded
half-to-even, 0 when a side is empty.  The longest common subsequence is
computed with bit vectors inside one expression: the shorter string lies in
words of WORD_BITS bits, and a fold over the longer string's code points
updates all of them with one addition each, the carry going from word to word
(what both have in common at the start and at the end is set aside before; the
bit-parallel recurrence V' = (V + (V & M)) | (V - (V & M)), where M marks
the places of the code point).  ``native_ratio`` is the built-in Levenshtein
variant (substitution costs 1) for when that definition is acceptable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import cut_prediction, let, normalise_literals, normalise_ws, strip_ws, ws_tokens

#: Bits of a word; with the carry an addition stays below 2^63.
WORD_BITS = 62


def _characters(s: Column) -> Column:
    return F.slice(F.split(s, ""), F.lit(1), F.length(s))


def _shared_start(a: Column, b: Column) -> Column:
    """How many elements two arrays have in common at their start."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differs > 0, differs - 1).otherwise(F.size(a)).cast("int")


def _behind(a: Column, n: Column) -> Column:
    return F.slice(a, n + 1, F.size(a) - n)


def _word_masks(chars: Column, c: Column) -> Column:
    """Words that mark the places of ``c`` among ``chars``, place 0 in the lowest bit of the first."""
    words = F.sequence(F.lit(0), F.ceil(F.size(chars) / F.lit(WORD_BITS)).cast("int") - 1)
    return F.transform(words, lambda w: F.aggregate(
        F.reverse(F.slice(chars, w * WORD_BITS + 1, WORD_BITS)), F.lit(0).cast("long"),
        lambda bits, x: bits * 2 + F.when(x == c, 1).otherwise(0)))


def lcs_length(a: Column | str, b: Column | str) -> Column:
    """Length of the longest common subsequence of two strings' code points."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    full = F.lit((1 << WORD_BITS) - 1)
    no_words = F.array().cast("array<long>")

    def updated(words: Column, masks: Column) -> Column:
        def one(done: Column, x: Column) -> Column:
            hit = x["v"].bitwiseAND(x["m"])
            total = x["v"] + hit + done["carry"]
            word = total.bitwiseOR(x["v"] - hit).bitwiseAND(full)
            return F.struct(F.concat(done["words"], F.array(word)).alias("words"),
                            F.shiftright(total, WORD_BITS).alias("carry"))

        start = F.struct(no_words.alias("words"), F.lit(0).cast("long").alias("carry"))
        return F.aggregate(F.arrays_zip(words.alias("v"), masks.alias("m")), start, one, lambda done: done["words"])

    def updated_word(words: Column, masks: Column) -> Column:
        """The usual case: the shorter string fits one word."""
        v = words[0]
        hit = v.bitwiseAND(masks[0])
        return F.array((v + hit).bitwiseOR(v - hit).bitwiseAND(full))

    def folded(x: Column) -> Column:
        # a code point that the shorter string lacks changes nothing
        shared = F.filter(x["long"], lambda c: F.array_contains(x["short"], c))
        masks = F.map_from_entries(F.transform(F.array_intersect(x["short"], x["long"]),
                                               lambda c: F.struct(c, _word_masks(x["short"], c))))
        count = F.ceil(F.size(x["short"]) / F.lit(WORD_BITS)).cast("int")
        start = F.array_repeat(full, count)

        def run(step):
            return let(F.struct(shared.alias("chars"), masks.alias("masks")), lambda y: F.aggregate(
                y["chars"], start, lambda words, c: step(words, F.element_at(y["masks"], c))))

        words = F.when(count == 1, run(updated_word)).otherwise(run(updated))
        ones = F.aggregate(words, F.lit(0), lambda n, w: n + F.bit_count(w))
        return count * WORD_BITS - ones

    def without_end(x: Column) -> Column:
        """Both arrays, backwards, from behind their common end."""
        return let(_shared_start(x["a"], x["b"]), lambda n: F.struct(
            (x["n"] + n).alias("n"), _behind(x["a"], n).alias("short"), _behind(x["b"], n).alias("long")))

    def without_start(x: Column) -> Column:
        return let(_shared_start(x["a"], x["b"]), lambda n: F.struct(
            n.alias("n"), F.reverse(_behind(x["a"], n)).alias("a"), F.reverse(_behind(x["b"], n)).alias("b")))

    def whole(x: Column) -> Column:
        return x["n"] + F.when((F.size(x["short"]) == 0) | (F.size(x["long"]) == 0), 0).otherwise(folded(x))

    ordered = F.when(F.length(a) <= F.length(b), F.struct(_characters(a).alias("a"), _characters(b).alias("b"))).otherwise(
        F.struct(_characters(b).alias("a"), _characters(a).alias("b")))
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0)).otherwise(
        let(ordered, lambda x: let(without_start(x), lambda y: let(without_end(y), whole))))


def indel_ratio(a: Column | str, b: Column | str) -> Column:
    """MET1: round(100 * 2 * LCS / total length), half to even; 0 when a side is null or empty."""
    a, b = (F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit("")) for x in (a, b))
    total = F.length(a) + F.length(b)
    return (F.when((F.length(a) == 0) | (F.length(b) == 0), 0)
            .when(a == b, 100)
            .otherwise(F.bround(F.lit(100.0) * (2 * lcs_length(a, b)) / total, 0).cast("int")))


def native_ratio(a: Column | str, b: Column | str) -> Column:
    """Built-in Levenshtein ratio: round(100 * (len sum - distance) / len sum)."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    total = F.length(ca) + F.length(cb)
    return F.when((F.length(ca) == 0) | (F.length(cb) == 0), F.lit(0)).otherwise(
        F.bround(F.lit(100.0) * (total - F.levenshtein(ca, cb)) / total, 0).cast("int"))


def prepare_predictions(preds: DataFrame, brace: str = "none", literals: bool = False,
                        pred_col: str = "pred", gold_col: str = "gold") -> DataFrame:
    """PRJ16 (+PRJ15): cut the raw prediction; optionally normalise literals."""
    p = cut_prediction(pred_col, brace)
    g = F.col(gold_col)
    if literals:
        p = normalise_literals(strip_ws(p))
        g = normalise_literals(g)
    return preds.withColumn("pred_cut", p).withColumn("gold_norm", g)


def score_rows(preds: DataFrame, pred_col: str = "pred_cut", gold_col: str = "gold_norm",
               indel: bool = True) -> DataFrame:
    """Per-row exact match (whitespace tokens equal) and edit similarity."""
    em = (ws_tokens(pred_col) == ws_tokens(gold_col)).cast("int")
    p = normalise_ws(pred_col)
    g = normalise_ws(gold_col)
    sim = indel_ratio(p, g) if indel else native_ratio(p, g)
    return preds.withColumn("exact", em).withColumn("edit_sim", sim)


def exact_match(scored: DataFrame) -> DataFrame:
    """AGG13: share of exact rows x100, 2 decimals."""
    return scored.agg(F.round(F.avg("exact") * 100, 2).alias("exact_match"))


def edit_similarity(scored: DataFrame) -> DataFrame:
    """AGG14: mean edit similarity, 2 decimals."""
    return scored.agg(F.round(F.avg("edit_sim"), 2).alias("edit_similarity"))
