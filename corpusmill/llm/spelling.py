"""Spelling variants by permuterm rotations.

Words of the corpus are counted natively.  Every word, ended by a mark, is
rotated in all ways.  Two words that differ in one code point have rotations
that agree but for their last character, the edited one: so the prefix of a
rotation without it is a range of the sorted rotations, in which a shorter
word's whole rotation comes first and the longer words follow, one for each
edited character.  Rotations are sorted by prefix, and tasks scan the ranges
and put out for each word its number of neighbours and the best one; a range
holds at most one word for each letter and one more, so no group can grow.  An
inserted letter that equals the one after it is taken at the last of the run
only, so that each pair of words meets once.

A word's form is the neighbour of largest count, if that is ``ratio`` times its
own; forms lead to ever larger counts, so following them by pointer jumping
ends after few rounds.

Rotations of long words would take the square of their length.  Prefixes of
more than LONG code points are therefore named by two rolling hashes, and the
pairs that meet there are compared letter by letter.

Defined results: null, empty and wordless texts have no words; a null id is
the empty text in the deletion rule; repeated rows count again; very long
texts are read whole; the empty table has no words; extra columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import LOWER, UPPER
from corpusmill.operators.graph import tree_roots
from corpusmill.session import reliable_checkpoint

# What a word is, the end mark, and the contract's bounds.
RUN = "[A-Za-zÀ-ÿ]+"
MARK = "$"
LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
DROP_MODULUS = 31
#: Prefixes of more code points are hashed.
LONG = 64
# A prime below 2^61 and two bases of the rolling hashes.
PRIME, BASES = (1 << 61) - 1, (1_000_003, 998_244_353)


def runs(text_col: str) -> Column:
    """The letter runs of a text, A-Z lower-cased."""
    text = F.translate(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(text, F.lit(RUN), F.lit(0))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop: bool = False,
                least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of words of at least ``least_length`` code points and ``least_count`` occurrences.
    ``drop`` applies the contract's deletion of a letter by the hash of id and run."""
    # explode would have the optimizer split the texts a second time to look for empty lists
    found = (docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
                         F.explode_outer(runs(text_col)).alias("run"))
             .where(F.length("run") >= least_length))
    if drop:
        h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
        at = (F.col("h") % F.length("run")).cast("int")
        found = found.withColumn("h", h).select(F.when(
            F.col("h") % DROP_MODULUS == 0,
            F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run")).alias("word"))
    else:
        found = found.select(F.col("run").alias("word"))
    return (found.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= least_count))


def rotations(words: DataFrame, long: int = LONG) -> DataFrame:
    """(prefix, edited, own, n): a rotation without its last character, which is ``edited``; a whole
    rotation has the empty text there.  ``own`` marks the last letter of a run of equal ones."""
    w, size = F.col("word"), F.length("word")
    twice = F.concat(w, F.lit(MARK), w)
    letter = lambda i: F.substring(w, i + 1, F.lit(1))
    without = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        F.substring(twice, i + 2, size).alias("prefix"), letter(i).alias("edited"),
        (letter(i) != F.substring(w, i + 2, F.lit(1))).alias("own")))
    whole = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(
        F.substring(twice, i + 1, size + 1).alias("prefix"), F.lit("").alias("edited"), F.lit(True).alias("own")))
    rows = F.when(size < long, F.concat(without, whole)).otherwise(without)
    return words.where(size <= long).select(F.explode(rows).alias("r"), "n").select("r.*", "n")


NEAR = "word string, n_near long, best_n long, best string"


def neighbours(prefix: str, members: list[tuple[str, bool, int]]) -> list[tuple[str, int, int, str]]:
    """(word, number of neighbours, count and text of the best) in one prefix range; members are (edited, own, n)."""
    behind, _, ahead = prefix.partition(MARK)
    words = [(-n, ahead + e + behind, own) for e, own, n in members]
    short = next((w for w, m in zip(words, members) if not m[0]), None)
    longer = sorted(w for w, m in zip(words, members) if m[0])
    out = []
    for k, (_, word, own) in enumerate(longer):
        others = len(longer) - 1 + (short is not None and own)
        if others:
            best = min(([longer[k == 0]] if len(longer) > 1 else []) + ([short] if short is not None and own else []))
            out.append((word, others, -best[0], best[1]))
    if short is not None:
        mine = [w for w in longer if w[2]]
        if mine:
            out.append((short[1], len(mine), -mine[0][0], mine[0][1]))
    return out


def scan(batches):
    """Neighbours within each range of equal prefixes of sorted rotations."""
    held: list[tuple] = []

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["word", "n_near", "best_n", "best"])

    for b in batches:
        out = []
        prefix = b.column("prefix")
        if held:
            alike = pc.equal(prefix, held[0][0])
            more = pc.index(alike, False).as_py()
            more = len(prefix) if more < 0 else more
            held += zip(*[c.slice(0, more).to_pylist() for c in b.columns])
            if more == len(prefix):
                continue
            out += neighbours(held[0][0], [r[1:] for r in held])
            b = b.slice(more)
            prefix = b.column("prefix")
        # ranges of one rotation have nothing to tell; the last range may go on in the next batch
        same = pc.equal(prefix.slice(1), prefix.slice(0, len(prefix) - 1)).to_numpy(zero_copy_only=False)
        paired = set(same.nonzero()[0].tolist())
        rows = sorted(paired | {i + 1 for i in paired} | {len(prefix) - 1})
        held = []
        for r in zip(*[c.to_pylist() for c in b.take(pa.array(rows)).columns]):
            if held and held[0][0] != r[0]:
                if len(held) > 1:
                    out += neighbours(held[0][0], [x[1:] for x in held])
                held = []
            held.append(r)
        if out:
            yield batch(out)
    out = neighbours(held[0][0], [r[1:] for r in held]) if held else []
    if out:
        yield batch(out)


def hashed(batches):
    """(place, name, edited, own, id): rotations of long words, prefixes longer than LONG named by rolling hashes."""
    for b in batches:
        for word, number, least in zip(*[b.column(c).to_pylist() for c in ("word", "id", "long")]):
            points, size = [ord(c) for c in word], len(word)
            keys = []
            for base in BASES:
                total, power = [0], [1]
                for p in points:
                    total.append((total[-1] * base + p) % PRIME)
                    power.append(power[-1] * base % PRIME)

                def part(a, b):
                    return (total[b] - total[a] * power[b - a]) % PRIME

                def around(stop, start):  # word[start:], the mark, word[:stop]
                    return (part(start, size) * base * power[stop] + ord(MARK) * power[stop] + part(0, stop)) % PRIME

                keys.append([around(i, i + 1) for i in range(size)] + [around(i, i) for i in range(size + 1)])
            rows = [(f"{size if i < size else size + 1}:{x:x}:{y:x}", i < size,
                     i >= size or i == size - 1 or points[i] != points[i + 1]) for i, (x, y) in enumerate(zip(*keys))]
            if size <= least:  # its other rotations are sorted as texts
                rows = rows[size:]
            names, longer, own = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(longer), pa.array(own), pa.array([number] * len(names), pa.int64())],
                                             names=["name", "longer", "own", "id"])


def long_neighbours(words: DataFrame, long: int = LONG) -> DataFrame:
    """Neighbours of words whose rotations are named by hashes: the pairs that meet, compared letter by letter."""
    known = reliable_checkpoint(words.where(F.length("word") >= long).withColumn("id", F.monotonically_increasing_id()))
    named = known.select("word", "id", F.lit(long).alias("long")).mapInArrow(hashed, "name string, longer boolean, own boolean, id long")
    # a range has at most one word for each letter, and the shorter word
    ranges = (named.groupBy("name").agg(F.collect_list(F.struct("id", "longer", "own")).alias("m")).where(F.size("m") > 1))
    pairs = (ranges.select(F.explode("m").alias("a"), "m").select("a", F.explode("m").alias("b"))
             .where((F.col("a.id") != F.col("b.id")) & F.col("a.own") & F.col("b.own")
                    | (F.col("a.id") != F.col("b.id")) & F.col("a.longer") & F.col("b.longer"))
             .select(F.col("a.id").alias("id"), F.col("b.id").alias("id2")).distinct())
    other = known.select(F.col("id").alias("id2"), F.col("word").alias("best"), F.col("n").alias("best_n"))
    return (pairs.join(known.select("id", "word"), "id").join(other, "id2")
            .where(F.levenshtein("word", "best", 1) == 1)
            .select("word", F.lit(1).cast("long").alias("n_near"), "best_n", "best"))


def near_words(words: DataFrame, long: int = LONG) -> DataFrame:
    """(word, n_near, best, best_n) of words (word, n) that have a neighbour."""
    found = (rotations(words, long).repartition("prefix").sortWithinPartitions("prefix", "edited")
             .select("prefix", "edited", "own", "n").mapInArrow(scan, NEAR))
    if words.where(F.length("word") >= long).limit(1).count():
        found = found.unionByName(long_neighbours(words, long))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                      F.min(F.struct((-F.col("best_n")).alias("minus"), "best")).alias("b"))
            .select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.minus")).alias("best_n")))


def variants(words: DataFrame, ratio: int = RATIO, long: int = LONG) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of words (word, n)."""
    words = reliable_checkpoint(words)
    known = words.join(near_words(words, long), "word", "left")
    better = F.col("best_n") >= ratio * F.col("n")
    known = reliable_checkpoint(known.select(
        "word", F.when(better, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(better, F.col("best_n")).alias("form_n")))
    roots = tree_roots(known.where(F.col("form").isNotNull()).select(F.col("word").alias("node"), F.col("form").alias("label")))
    return (known.join(roots.select(F.col("node").alias("word"), F.col("label").alias("root")), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def report(docs: DataFrame, long: int = LONG) -> DataFrame:
    """The contract's columns of a documents table."""
    return variants(word_counts(docs, drop=True), long=long)
