"""Classifiers, personal data and quality rules: held-out accuracy, and brute force of the fixed parts."""

import itertools
import random
import re
import tracemalloc
import zlib
from collections import Counter
from dataclasses import replace

import duckdb
import numpy as np
import pytest

from corpusmill.llm import pii, quality, rules, subword, toxicity
from tests.llm.edges import EDGE_TEXTS, docs

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def held_out(report, labels, label):
    known = {r.doc_id: r[label] for r in labels.collect()}
    return [(r.predicted, known[r.doc_id]) for r in report.collect() if r.held_out and r.doc_id in known]


def test_quality_held_out(spark, tables):
    pairs = held_out(quality.report(*tables), tables[1], "quality")
    assert len(pairs) > 50 and np.mean([p == y for p, y in pairs]) >= 0.97


def test_toxicity_held_out(spark):
    """125 of 144 held-out toxic texts when it was written, with 16 false alarms."""
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    labels = labels.where("toxic is not null")
    labelled = documents.join(labels.select("doc_id"), "doc_id", "left_semi")
    pairs = Counter(held_out(toxicity.report(labelled, labels), labels, "toxic"))
    assert pairs[1, 1] >= 0.85 * (pairs[1, 1] + pairs[0, 1])
    assert pairs[1, 1] >= 0.85 * (pairs[1, 1] + pairs[1, 0])


@pytest.mark.parametrize("s", [quality.SETTINGS, toxicity.SETTINGS, replace(toxicity.SETTINGS, repeats=True, least_texts=1)])
def test_scorer_equals_the_forward_pass(s):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["Eins", "zwei", "zwei", "drei!", "\u00e9t\u00e9"]) for _ in range(rng.randrange(40))) for _ in range(60)]
    model = subword.Model(replace(s, epochs=1, steps=60))
    rows = model.rows.copy()
    model.fit(texts, [i % 2 for i in range(60)])
    assert (model.rows != rows).any()
    scorer = subword.Scorer(model.compact(), s)
    for text in texts + ["", None, "neu"]:
        words = (text or "").lower().split() if s.lower else (text or "").split()
        n = max(1, round(len(words) / s.segment)) if s.segment else 1
        best = 0.0
        for k in range(n):
            part = words[len(words) * k // n:len(words) * (k + 1) // n]
            ids = [f for w in part for f in subword.word_features(w, s)]
            ids += [0] * (s.repeats and sum(a == b for a, b in zip(part, part[1:])))
            h = model.rows[ids].mean(0) if ids else np.zeros(s.dim)
            z = np.exp(h @ model.out + model.bias)
            best = max(best, z[1] / z.sum())
        assert abs(scorer.score(text) - best) < 1e-5


def test_toxicity_learns_word_families():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice(["th", "er", "on", "in", "an", "es"]) for _ in range(rng.randrange(1, 4)))
    text = lambda n, bad: " ".join("grum" + word() if rng.random() < bad else word() for _ in range(n))
    data = [(text(rng.randrange(20, 500), 0.02 * (i % 2)), i % 2) for i in range(800)]
    learn, test = data[:600], data[600:]
    s = toxicity.SETTINGS
    scorer = subword.Scorer(subword.Model(s).fit([t for t, _ in learn], [y for _, y in learn]).compact(), s)
    right = [(scorer.score(t) >= 0.7) == (y == 1) for t, y in test if y == 0 or "grum" in t]
    assert np.mean(right) > 0.95
    assert scorer.score(text(30, 0) + " grumshthor grumsher") > 0.7  # endings never seen


def test_folds_teach_nothing_held_out(spark, tables):
    s = quality.SETTINGS
    rows = subword.labelled_sample(*tables, "quality", subword.learning_fold(5, 0), s.sample).collect()
    assert rows and all(zlib.crc32(str(r.id).encode()) % 5 for r in rows)


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifier_edges(spark, module, label):
    labels = spark.createDataFrame([(4, 1, 0), (5, None, None), (6, 0, 1), (6, 1, 1), (None, 1, 1), (7, 0, 1), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    out = module.report(docs(spark, EDGE_TEXTS), labels).collect()
    assert len(out) == len(EDGE_TEXTS)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= module.THRESHOLD) for r in out)
    assert all((r.held_out is None) == (r.doc_id is None) for r in out)
    none = module.report(docs(spark, EDGE_TEXTS), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert module.report(docs(spark, []), labels).count() == 0
    if module is quality:
        assert quality.keep_good(docs(spark, EDGE_TEXTS), labels, 0.0).columns == docs(spark, []).columns


PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            d = [int(c) for c in m.group() if c in "0123456789"]
            total = sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(d[::-1]))
            if kind == 0 or kind == 1 and max(map(int, m.group().split("."))) <= 255 \
                    or kind == 2 and 12 <= len(d) <= 19 and total % 10 == 0 or kind == 3 and 9 <= len(d) <= 15:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    for _ in range(5000):
        t = "".join(rng.choice("0123456789..@@a-b +(). 12345") for _ in range(rng.randrange(1, 40)))
        assert pii.base_spans(t) == brute_spans(t)


def test_windows_cover_every_anchor():
    rng = random.Random(3)
    for _ in range(300):
        t = "".join(rng.choice("aaaaaaaaaaaaaaaaaaaa1@") for _ in range(rng.randrange(1, 900)))
        covered = {k for a in pii.windows(t) for k in range(a, a + pii.T)}
        assert all(k in covered for k, c in enumerate(t) if c in "1@")


def test_gradients_equal_differences():
    rng = np.random.default_rng(4)
    tagger = pii.Tagger()
    ids, tags = rng.integers(0, pii.SYMBOLS, (2, pii.T)), rng.integers(0, pii.TAGS, (2, pii.T))

    def loss():
        e, _ = tagger.emissions(ids)
        a, z = tagger.p["trans"], e[:, 0]
        for t in range(1, pii.T):
            z = e[:, t] + np.logaddexp.reduce(z[:, :, None] + a, axis=1)
        path = np.take_along_axis(e, tags[:, :, None], 2).sum((1, 2)) + a[tags[:, :-1], tags[:, 1:]].sum(1)
        return float((np.logaddexp.reduce(z, axis=1) - path).mean())

    g = tagger.gradients(ids, tags)
    for name, p in tagger.p.items():
        at = np.unravel_index(np.abs(g[name]).argmax(), p.shape)
        p[at] += 1e-5
        up = loss()
        p[at] -= 2e-5
        down = loss()
        p[at] += 1e-5
        assert abs((up - down) / 2e-5 - g[name][at]) < 1e-4 * max(1, abs(g[name][at])), name


def test_best_tags_equal_enumeration(monkeypatch):
    monkeypatch.setattr(pii, "T", 4)
    rng = np.random.default_rng(9)
    tagger = pii.Tagger()
    tagger.p["trans"] = rng.normal(0, 1, (pii.TAGS, pii.TAGS))
    ids = rng.integers(0, pii.SYMBOLS, (6, 4))
    e, _ = tagger.emissions(ids)
    paths = np.array(list(itertools.product(range(pii.TAGS), repeat=4)))
    inner = tagger.p["trans"][paths[:, :-1], paths[:, 1:]].sum(1)
    for row, found in zip(e, tagger.decode(ids)):
        assert (paths[(row[np.arange(4), paths].sum(1) + inner).argmax()] == found).all()


def test_windows_reconciled_by_nearest_middle():
    rng = random.Random(12)
    for _ in range(200):
        text = "".join(rng.choice("aaaaaaaaaaaaaaaaa1@") for _ in range(rng.randrange(1, 500)))
        starts = pii.windows(text)
        if not starts:
            continue
        tags = np.array([[rng.randrange(pii.TAGS) for _ in range(pii.T)] for _ in starts], np.int8)
        want = {}
        for k, a in enumerate(starts):
            for t in range(min(pii.T, len(text) - a)):
                key = (abs(t - (pii.T - 1) / 2), k)
                if a + t not in want or key < want[a + t][0]:
                    want[a + t] = (key, tags[k, t])
        at, got = pii.reconciled(starts, tags, len(text))
        assert dict(zip(at.tolist(), got.tolist())) == {c: int(v) for c, (_, v) in want.items()} and len(at) == len(want)
        chars, runs = {c: int(v) for c, (_, v) in want.items()}, []
        for c in sorted(chars):
            kind = (chars[c] - 1) // 2
            if chars[c] and runs and runs[-1][2] == c and runs[-1][1] == kind and chars[c] % 2 == 0:
                runs[-1][2] += 1
            elif chars[c]:
                runs.append([c, kind, c + 1])
        assert [list(r) for r in pii.tagged_runs(at, got)] == runs


def test_added_spans_on_withheld_variants():
    """Trained on one part of the documents; on variants of the spans of the others: 523 of 534 found, no
    false one, when it was written (sf 0.1).  No added span cuts a run of digits or touches a base span."""
    texts = [r[0] or "" for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.1/documents.parquet' ORDER BY doc_id").fetchall()]
    learn = [t for i, t in enumerate(texts) if i % 3 == 0 and pii.ANCHOR.search(t)]
    held = [t for i, t in enumerate(texts) if i % 3]
    tagger = pii.Tagger().fit(*pii.examples(learn))
    cases, n = [], 0
    for t in held:
        spans = pii.base_spans(t)
        for a, kind, b in spans:
            n += 1
            lo, hi = max(0, a - 80), min(len(t), b + 80)
            if sum(y > lo and x < hi for x, _, y in spans) == 1:
                for _, form, x, y in pii.variants(kind, t[a:b], n):
                    changed = t[lo:a] + form + t[b:hi]
                    if not pii.base_spans(changed):
                        cases.append((changed, (a - lo + x, kind, a - lo + y)))
    got = pii.added_spans([t for t, _ in cases], [[] for _ in cases], tagger)
    found, right = sum(map(len, got)), sum(want in g for (_, want), g in zip(cases, got))
    assert len(cases) > 300 and right >= .9 * len(cases) and right >= .9 * found
    base = [pii.base_spans(t) for t in held]
    for t, b, g in zip([*held, *[t for t, _ in cases]], [*base, *[[]] * len(cases)], [*pii.added_spans(held, base, tagger), *got]):
        for x, _, y in g:
            assert not re.match("[0-9]{2}", t[x - 1:x + 1]) or x == 0
            assert not re.match("[0-9]{2}", t[y - 1:y + 1])
            assert all(y <= u or v <= x for u, _, v in b)


def test_widened_spans():
    card = "4111 1111 1111 1111"
    t = f"a 5389 {card} 22 b"
    for a, b in [(9, 20), (7, 26), (12, 16)]:
        assert pii.widened(t, 2, a, b) == (7, 26)
    assert pii.widened("x 4111 1111 1111 1112 y", 2, 2, 21) is None
    assert pii.widened("so bob @ mail . example . org, x", 0, 4, 27) == (3, 29)
    assert pii.widened("v 10[.]20[.]30[.]40 x", 1, 2, 18) == (2, 19)
    assert pii.widened("v 1 . 2 . 3 . 4.5 x", 1, 2, 15) is None and pii.widened("v 1 . 2 . 3 . 400 x", 1, 2, 17) is None
    assert pii.widened("1" * 500, 2, 200, 216) is None


def test_long_dense_text(monkeypatch):
    """Digits all over: one batch of windows is held at a time, and a byte for a character, no Python entry."""
    monkeypatch.setattr(pii, "DECODE_BATCH", 64)
    tagger, peaks = pii.Tagger(), []
    tagger.p["out0"][0] = 50  # untrained: everything outside
    for n in (1000, 4000):
        text = "1234567 89 " * n
        base = pii.base_spans(text)
        tracemalloc.start()
        assert pii.added_spans([text], [base], tagger) == [[]]
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] - peaks[0] < 40 * 33_000


def test_personal_data(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    kinds = [lambda: f"{word()}@{word()}.com", lambda: f"1{number(1)}.2.{number(1)}.9", lambda: f"+1 ({number(3)}) 555-{number(4)}",
             lambda: f"version {number(2)}"]
    texts = [(i, f"{word()} {word()} {kinds[i % 4]()} {word()} {word()}") for i in range(400)]
    texts += [(1000 + i, t) for i, (_, t) in enumerate(EDGE_TEXTS)] + [(2000, "abcde (988) 555-2485 abcde abcde")]
    frame = docs(spark, texts)
    model = pii.train(frame)
    out = {r.doc_id: r for r in pii.find(frame, model).collect()}
    for i, t in texts:
        base, got = out[i].base_spans, out[i].spans
        assert base == pii.listed(brute_spans(t or ""))
        assert set(filter(None, base.split(","))) <= set(filter(None, got.split(",")))
    assert out[2000].spans == "phone:6:20" and out[2000].masked_text == "abcde [PHONE] abcde abcde"
    assert all(out[i].spans == "" for i in range(3, 400, 4))  # numbers that are no personal data
    masked = pii.mask(frame)
    assert masked.columns == frame.columns and masked.count() == len(texts)
    assert pii.train(docs(spark, [])) is None and pii.report(docs(spark, [])).count() == 0


def brute_rules(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    wins = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n, cover = Counter(wins), set()
    for i, x in enumerate(wins):
        if n[x] > 1:
            cover |= set(range(i, i + 5))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover),
            len(w) < 10 or 100 * len(cover) > 20 * len(w))


def test_rule_statistics(spark):
    rng = random.Random(6)
    texts = EDGE_TEXTS + [(100 + i, "".join(rng.choice("ab \n#|\x1c\x0b") for _ in range(rng.randrange(0, 120))))
                          for i in range(100)] + [(300, "l\nl\n\nl \n l\nl"), (301, "a b " * 40)]
    labels = spark.createDataFrame([(4, 1), (None, 0), (5, None)], "doc_id long, quality int")
    out = rules.report(docs(spark, texts), labels).collect()
    assert sorted((tuple(r)[:7] for r in out), key=str) == sorted(((i, *brute_rules(t)) for i, t in texts), key=str)
    assert all(r.kept == (not r.base_failed) for r in out)  # nothing learned
    assert rules.report(docs(spark, []), labels).count() == 0


def test_rules_reject_bad_and_keep_good(spark, tables):
    known = {r.doc_id: r.quality for r in tables[1].collect()}
    out = [r for r in rules.report(*tables).collect() if r.doc_id in known]
    assert all(r.kept or r.base_failed for r in out if known[r.doc_id] == 1)
    assert sum(not r.kept for r in out if known[r.doc_id] == 0) > sum(r.base_failed for r in out if known[r.doc_id] == 0)


def test_rules_run_no_python(spark, tables):
    plan = rules.judge(*tables)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_rules_learn_from_the_sample_only(spark, tables):
    plan = rules.labelled_rows(*tables, 100, "doc_id", "text")._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join Inner", 1)
    assert "regexp_replace" in above and "regexp_replace" not in below and "transform" not in below


@pytest.mark.parametrize("rows", [20_000])
def test_repeated_labelled_ids_are_one_example(spark, rows):
    table = spark.range(rows).selectExpr("1L AS doc_id", "concat('some words number ', id % 7, ' 4@5.com') AS text").unionAll(
        spark.createDataFrame([(2, "other"), (3, None)], "doc_id long, text string"))
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, 0, 0)], "doc_id long, quality int, toxic int")
    sample = subword.labelled_sample(table, labels, "quality", lambda df: df["doc_id"] > 0, (10, 10)).collect()
    assert sorted((r.id, r.y) for r in sample) == [(1, 1), (2, 0), (3, 0)]
    assert len(rules.labelled_rows(table, labels, 10, "doc_id", "text").collect()) <= 3


def test_learned_conjunction():
    rng = random.Random(7)
    rows = []
    for _ in range(900):
        r = {k: rng.random() for k in rules.STATISTICS}
        r["bad"] = int(r["symbol_share"] > 0.6 and r["upper_share"] < 0.5)
        rows.append(r)
    learned = rules.learn(rows)
    wrong = [any(rules.fits(x, r) for x in learned) != bool(r["bad"]) for r in rows]
    assert learned and len(learned[0]) == 2 and np.mean(wrong) < 0.03


def test_examples_are_held_in_few_arrays():
    """Many short segments take the memory of their features, not of two arrays and lists of numbers for each."""
    import random
    import tracemalloc

    from corpusmill.llm import subword, toxicity

    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(1000)) for _ in range(3)]
    model = subword.Model(toxicity.SETTINGS)
    tracemalloc.start()
    try:
        data = model.examples(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 1900 * 3000  # bytes a word; 2,218 before, 1,611 now
    assert all(len(x.bounds) == 334 and x.bounds[-1] == len(x.ids) == len(x.shares) for x in data)
