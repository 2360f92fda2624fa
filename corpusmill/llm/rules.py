"""Quality rules as a learned decision list, in DataFrame functions only.

Each text gets native statistics.  From labelled rows a sequential covering
learner grows one conjunction of threshold conditions after another (the
condition with the best gain of information first), prunes its last
conditions on rows kept aside, and takes the rows that it covers out of the
game; a rule enters the list only if it is nearly pure.  The list becomes one
ordered ``CASE WHEN`` expression; no rule fitting means that the text is kept.

Defined results: a null or wordless text has no words, so it fails the base
check; labels that are null or of unknown documents teach nothing; without
labels the list is empty and only the base check rejects; repeated rows are
judged one by one; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most so many labelled rows' statistics are learned from.
SAMPLE = 6000
#: Thresholds tried for a statistic are at most so many quantiles of it.
QUANTILES = 24
MAX_CONDITIONS = 3
MAX_RULES = 12
#: A rule must be right for this share of the rows it covers, in both parts, and cover so many.
PRECISION = 0.98
COVER = 8

WORD_SPLIT = "[\\x20\\x09-\\x0D]+"
STATISTICS = ["n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share",
              "upper_share", "mark_share", "same_share", "longest_line"]


def let(value: Column, body) -> Column:
    """``body`` over a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words in 5-word windows that occur twice or more in the text.

    Window hashes tell most texts apart at once; only where two are equal
    are they sorted with their places, equal neighbours compared word by
    word, and the places of equal windows joined to covered words.
    """
    places = F.sequence(F.lit(0), F.size(words) - 5)
    window = lambda i: [F.get(words, i + k).alias(f"w{k}") for k in range(5)]  # noqa: E731  (slice copies the array)
    hashes = F.transform(places, lambda i: F.xxhash64(*window(i)))
    same = lambda i, j: (F.struct(*window(i)) == F.struct(*window(j)))

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda v, k: F.struct(v.alias("h"), k.alias("i"))))
        return let(placed, lambda s: let(starts(s), lengths))

    def starts(s: Column) -> Column:
        def twin(x: Column, y: Column) -> Column:
            return (y["h"] == x["h"]) & same(x["i"], y["i"])

        return F.sort_array(F.transform(
            F.filter(s, lambda x, k: twin(x, F.get(s, k - 1)) | twin(x, F.get(s, k + 1))), lambda x: x["i"]))

    def lengths(p: Column) -> Column:
        # a start covers 5 words, less those that the next one covers
        return F.aggregate(F.transform(p, lambda v, k: F.least(F.lit(5), F.get(p, k + 1) - v)),
                           F.lit(0), lambda a, v: a + v)

    return (F.when(F.size(words) < 6, 0)
            .otherwise(let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))))
            .cast("long"))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and the
    shares in STATISTICS) of each whole text."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    words = F.filter(F.split(text, WORD_SPLIT), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    # one expression over words and lines that are bound once: a filter on the result that Spark
    # pushes below a projection cannot make it split the text again for each word
    counted = let(F.struct(text.alias("t"), words.alias("ws"), lines.alias("ls")), count_all)
    out = docs.select(F.col(f"`{id_col}`").alias("id"), counted.alias("s")).select("id", "s.*")
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return out.select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
        share("word_chars", "n_words").alias("mean_word"), share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("n_distinct", "n_words").alias("distinct_share"), share("upper", "word_chars").alias("upper_share"),
        share("marks", "word_chars").alias("mark_share"), share("n_same", "n_words").alias("same_share"),
        F.col("longest_line").cast("double").alias("longest_line"))


def count_all(x: Column) -> Column:
    """The counts over a struct of text, words and lines."""
    text, words, lines = x["t"], x["ws"], x["ls"]
    long = lambda c, name: c.cast("long").alias(name)
    found = lambda what: F.length(text) - F.length(F.regexp_replace(text, what, ""))
    ahead = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice(words, 1, ahead).alias("a"), F.slice(words, 2, ahead).alias("b"))
    return F.struct(
        long(F.size(words), "n_words"), long(F.length(F.array_join(words, "")), "word_chars"),
        long(found("[#*$%&|<>]+"), "n_symbols"),
        long(F.size(lines) - F.size(F.array_distinct(lines)), "n_dup_lines"),
        repeated_words(words).alias("n_repeat_words"), long(F.size(lines), "n_lines"),
        long(F.size(F.array_distinct(words)), "n_distinct"), long(found("[A-Z]+"), "upper"),
        long(found("[!?]+"), "marks"), long(F.size(F.filter(pairs, lambda p: p["a"] == p["b"])), "n_same"),
        F.coalesce(F.array_max(F.transform(lines, F.length)), F.lit(0)).alias("longest_line"))


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    value: float

    def holds(self, row: dict) -> bool:
        return row[self.name] >= self.value if self.above else row[self.name] < self.value

    def column(self) -> Column:
        return F.col(self.name) >= self.value if self.above else F.col(self.name) < self.value


Rule = tuple[Condition, ...]


def fits(rule: Rule, row: dict) -> bool:
    return all(c.holds(row) for c in rule)


def counts(rule: Rule, rows: list[dict]) -> tuple[int, int]:
    """(bad, good) rows that the rule covers."""
    covered = [r["bad"] for r in rows if fits(rule, r)]
    return sum(covered), len(covered) - sum(covered)


def thresholds(rows: list[dict], name: str) -> list[float]:
    """Midpoints at up to QUANTILES quantiles of the bad rows' and of all rows' values."""
    out = set()
    for part in ([r[name] for r in rows if r["bad"]], [r[name] for r in rows]):
        values = sorted(set(part))
        step = max(1, len(values) // QUANTILES)
        out |= {(a + b) / 2 for a, b in list(zip(values, values[1:]))[::step]}
    return sorted(out)


def grow(rows: list[dict]) -> Rule:
    """Add the condition with the largest information gain until no good row is covered."""
    rule: Rule = ()
    covered = rows
    while len(rule) < MAX_CONDITIONS:
        bad = sum(r["bad"] for r in covered)
        if not bad or bad == len(covered):
            break
        base, best, chosen = math.log2(bad / len(covered)), 0.0, None
        for name in STATISTICS:
            values = sorted((r[name], r["bad"]) for r in covered)
            for at in thresholds(covered, name):
                above = [b for v, b in values if v >= at]
                for is_above, n, k in ((True, len(above), sum(above)),
                                       (False, len(values) - len(above), bad - sum(above))):
                    if k:
                        gain = k * (math.log2(k / n) - base)
                        if gain > best:
                            best, chosen = gain, Condition(name, is_above, at)
        if chosen is None:
            break
        rule += (chosen,)
        covered = [r for r in covered if chosen.holds(r)]
    return rule


def prune(rule: Rule, rows: list[dict]) -> Rule:
    """The prefix of the rule that is worth most on rows kept aside."""
    def worth(r: Rule) -> float:
        bad, good = counts(r, rows)
        return (bad - good) / (bad + good) if bad + good else -1.0

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth) if rule else rule


def learn(rows: list[dict]) -> list[Rule]:
    """Sequential covering of the bad rows; ``rows`` are dicts of STATISTICS and ``bad`` (0 or 1)."""
    kept_aside, growing = rows[::3], [r for i, r in enumerate(rows) if i % 3]
    rules: list[Rule] = []
    while len(rules) < MAX_RULES and any(r["bad"] for r in growing):
        rule = prune(grow(growing), kept_aside)
        (bad, good), (bad2, good2) = counts(rule, growing), counts(rule, kept_aside)
        if not rule or bad < COVER or bad < PRECISION * (bad + good) or bad2 < PRECISION * (bad2 + good2):
            break
        rules.append(rule)
        growing = [r for r in growing if not fits(rule, r)]
        kept_aside = [r for r in kept_aside if not fits(rule, r)]
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that rejects a row, from 1; null if none does."""
    out = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        every = rule[0].column()
        for c in rule[1:]:
            every = every & c.column()
        out = F.when(every, F.lit(number)).otherwise(out)
    return out


def labelled_rows(docs: DataFrame, labels: DataFrame, sample: int, id_col: str, text_col: str) -> DataFrame:
    """Statistics and label of those of at most ``sample`` labelled documents, by a hash of the id, that pass the base
    check.  Of contradictory labels the smaller one counts."""
    known = (labels.where(F.col("quality").isin(0, 1) & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("labelled_id")).agg(F.min("quality").alias("quality"))
             .orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(sample))
    # of an id's rows the least text counts, so that repeated rows cannot fill the driver; the aggregation also keeps
    # the base check above the join, or the statistics of every text would be computed for this sample
    chosen = (docs.select(F.col(f"`{id_col}`").alias("known_id"), F.col(f"`{text_col}`").alias("t"))
              .join(F.broadcast(known), F.col("known_id") == F.col("labelled_id"))
              .groupBy(F.struct("labelled_id", "quality").alias("id")).agg(F.min("t").alias("t")))
    found = (statistics(chosen, "id", "t").where(~F.col("base_failed"))
             .select(F.col("id.labelled_id").alias("labelled_id"), (1 - F.col("id.quality")).alias("bad"), *STATISTICS)
             .orderBy(F.xxhash64("labelled_id"), *STATISTICS))
    return found


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          sample: int = SAMPLE) -> DataFrame:
    """Statistics of each text with rule (number of the rejecting rule or null) and kept."""
    rules = learn([r.asDict() for r in labelled_rows(docs, labels, sample, id_col, text_col).collect()])
    out = statistics(docs, id_col, text_col).withColumn("rule", verdict(rules))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()).withColumnRenamed("id", id_col)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns of a documents table."""
    return judge(docs, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                      "base_failed", "kept")
