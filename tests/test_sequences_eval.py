import random

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import evaluation as E
from corpusmill.operators import logs as L
from corpusmill.operators import ordering as O
from corpusmill.operators import sequences as Q

L_ = 20
W = L_ - 3
OFF = 5


@pytest.mark.parametrize("n,expected", [(W - 1, 1), (W, 1), (W + 1, 1), (W + (W - OFF), 2), (0, 1)])
def test_window_counts(spark, n, expected):
    df = spark.createDataFrame([(1, [f"t{i}" for i in range(n)])], "id long, tokens array<string>")
    w = Q.token_windows(df, "tokens", L_, OFF).collect()
    assert len(w) == expected
    assert df.select(Q.window_count(F.size("tokens"), L_, OFF)).first()[0] == expected
    assert all(x.window[:3] == ["<s>", "<decoder-only>", "</s>"] for x in w)
    assert all(len(x.window) == min(n, W) + 3 for x in w)


def test_window_options_validated():
    with pytest.raises(ValueError):
        Q.validate_window(3, 0)
    with pytest.raises(ValueError):
        Q.validate_window(20, 17)


def test_train_features_padded(spark):
    seqs = spark.createDataFrame([(1, "<s> a b c </s>"), (2, "<s> " + " ".join(["z"] * 40) + " </s>")],
                                 "id long, seq string")
    f = Q.train_features(seqs, None, L_, OFF).orderBy("id", "window_index").collect()
    assert all(len(r.ids) == L_ for r in f)
    assert f[0].n_real == 3 + 4 and f[0].ids[:3] == [0, 4, 2]
    assert sum(1 for r in f if r.id == 2) == (41 - W) // (W - OFF) + 1


def dp_lcs(a, b):
    m = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            m[i][j] = m[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] else max(m[i - 1][j], m[i][j - 1])
    return m[-1][-1]


def test_lcs_equals_dynamic_programming(spark):
    rng = random.Random(8)
    pairs = [("kitten", "sitting"), ("", ""), ("", "a"), ("abc", "abc"), ("a" * 300, "ab" * 200), ("😀é😀", "é😀x😀")]
    for alphabet, most, count in (("ab", 12, 1500), ("abcdef é", 70, 1500), ("a😀b🎉é中", 40, 1500), ("abcdefgh", 200, 500), ("xy", 330, 30)):
        pairs += [tuple("".join(rng.choice(alphabet) for _ in range(rng.randrange(most))) for _ in "ab") for _ in range(count)]
    assert len(pairs) > 5000
    rows = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", E.lcs_length("a", "b").alias("l"), E.indel_ratio("a", "b").alias("r")).collect()
    for r in rows:
        want = dp_lcs(r.a, r.b)
        assert r.l == want, (r.a, r.b)
        assert r.r == (round(100.0 * 2 * want / (len(r.a) + len(r.b))) if r.a and r.b else 0)
    nulls = spark.createDataFrame([(None, "a"), ("a", None), (None, None)], "a string, b string")
    assert [r[0] for r in nulls.select(E.indel_ratio("a", "b")).collect()] == [0, 0, 0]


def test_scores_run_no_python(spark):
    p = spark.createDataFrame([(1, "a", "b")], "example_id long, pred string, gold string")
    plan = E.edit_similarity(E.score_rows(E.prepare_predictions(p)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_exact_match_whitespace(spark):
    p = spark.createDataFrame([(1, "a b</s>c", "a  b"), (2, "x", "y")], "example_id long, pred string, gold string")
    scored = E.score_rows(E.prepare_predictions(p, "none"), indel=True)
    assert E.exact_match(scored).first()[0] == 50.0
    rows = {r.example_id: r.edit_sim for r in scored.collect()}
    assert rows[1] == 100 and rows[2] == 0


def test_best_checkpoint_ties_keep_earlier(spark):
    ep = spark.createDataFrame([(0, "e0", 10.0), (1, "e1", 12.0), (2, "e2", 12.0), (3, "e3", 11.0)],
                               "epoch int, model string, acc double")
    flags = [r.is_best for r in L.best_checkpoint(ep).orderBy("epoch").collect()]
    assert flags == [True, True, False, False]
    assert L.final_best(ep).first().epoch == 1


def test_trailing_mean_spans_epochs(spark):
    rows = [(0, 0 if s <= 3 else 1, s, s if s <= 3 else s - 3, float(s)) for s in range(1, 7)]
    log = spark.createDataFrame(rows, "run long, epoch int, step long, epoch_step long, loss double")
    out = L.trailing_mean(log, every=2, window=3).orderBy("step").collect()
    assert [(r.step, r.trailing_loss) for r in out] == [(2, 1.5), (5, 4.0)]
    tot = L.running_totals(log).orderBy("step").collect()
    assert [r.examples for r in tot] == [1, 2, 3, 1, 2, 3]


def test_row_index_dense_and_zip(spark):
    df = spark.range(0, 1000).repartition(7).withColumn("k", F.col("id") * 3)
    idx = O.with_row_index(df, [F.col("k")], "ri").collect()
    assert sorted(r.ri for r in idx) == list(range(1000))
    assert all(r.ri == r.id for r in idx)
    a = spark.range(0, 5)
    b = spark.range(10, 13)
    z = O.zip_rows(a, b.withColumnRenamed("id", "bid"), [F.col("id")], [F.col("bid")]).collect()
    assert len(z) == 3


def test_fixed_batches_last_short(spark):
    df = spark.range(0, 10)
    b = O.fixed_batches(df, 4, [F.col("id")]).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in b] == [4, 4, 2]


def test_group_prefix_hot_group(spark):
    rows = [(0, i, float(i % 7)) for i in range(1, 1001)] + [(g, i, 1.0) for g in range(1, 6) for i in range(1, 4)]
    df = spark.createDataFrame(rows, "g long, t long, v double").repartition(5)
    out = O.with_group_prefix(df, ["g"], ["t"], "v", "rn", "ps").collect()
    expect_ps = {}
    acc = {}
    for g, t, v in sorted(rows):
        acc[g] = acc.get(g, 0.0) + v
        expect_ps[(g, t)] = acc[g]
    assert len(out) == len(rows)
    for r in out:
        assert r.rn == r.t  # t runs 1..n inside every group
        assert r.ps == pytest.approx(expect_ps[(r.g, r.t)])


def test_trailing_mean_halo_blocks(spark):
    rng = random.Random(5)
    losses = [rng.random() for _ in range(50)]
    rows = [(1, 0, s, s, losses[s - 1]) for s in range(1, 51)]
    log = spark.createDataFrame(rows, "run long, epoch int, step long, epoch_step long, loss double")
    out = {r.step: r.trailing_loss for r in L.trailing_mean(log, every=1, window=3, block=4).collect()}
    for s in range(1, 51):
        w = losses[max(0, s - 3):s]
        assert out[s] == round(sum(w) / len(w), 4)


def test_clusters_stay_whole(spark):
    from corpusmill.operators import graph as G
    comp = spark.createDataFrame([(n, 10) for n in range(10, 15)] + [(20, 20), (21, 20)], "node long, cluster_id long")
    assert sorted(map(tuple, G.cluster_members(comp).collect())) == (
        [(10, 5, n) for n in range(10, 15)] + [(20, 2, 20), (20, 2, 21)])
    assert {r.cluster_id: r.members for r in G.cluster_lists(comp).collect()} == {10: list(range(10, 15)), 20: [20, 21]}
    with pytest.raises(Exception, match="more than 2 members"):
        G.cluster_lists(comp, max_members=2).collect()


@pytest.mark.parametrize("local_edges", [200_000, 3])
def test_graph_rounds(spark, local_edges, monkeypatch):
    """Components and leaders of random graphs and a long chain, in few rounds, with all keys salted or none."""
    from corpusmill.operators import graph as G
    monkeypatch.setattr(G, "HOT_LABEL_ROWS", 20 if local_edges == 3 else 20_000)
    rng = random.Random(11)
    chain = [(i, i + 1) for i in range(200)]
    edges = chain + [(300 + rng.randrange(60), 300 + rng.randrange(60)) for _ in range(70)]
    hub = [(1000, 1001 + i) for i in range(40)]
    edges += hub
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    label, leader = {}, {}
    for n in sorted(near):
        leader[n] = not any(leader.get(m) for m in near[n] if m < n)
        if n not in label:
            todo = [n]
            while todo:
                x = todo.pop()
                if x not in label:
                    label[x] = n
                    todo += near[x]
    df = spark.createDataFrame(edges, "src long, dst long")
    writes = []
    real = G.reliable_checkpoint
    monkeypatch.setattr(G, "reliable_checkpoint", lambda f: (writes.append(1), real(f))[1])
    got = {r.node: r.cluster_id for r in G.connected_components(df, local_edges=local_edges).collect()}
    assert got == label and len(writes) < 60
    writes.clear()
    assert {r.node: r.is_leader for r in G.leader_status(df, local_edges=local_edges).collect()} == leader
    assert len(writes) < 80


def test_group_prefix_sub_groups(spark):
    rng = random.Random(9)
    rows = [(g, t, rng.randrange(3)) for g in range(3) for t in range(1, 200)]
    df = spark.createDataFrame(rows, "g long, t long, e long").repartition(4)
    out = O.with_group_prefix(df, ["g"], ["t"], None, "rn", sub_groups={"ern": ["g", "e"]}).collect()
    seen = {}
    expect = {}
    for g, t, e in sorted(rows):
        seen[(g, e)] = seen.get((g, e), 0) + 1
        expect[(g, t)] = (t, seen[(g, e)])
    assert len(out) == len(rows)
    assert all((r.rn, r.ern) == expect[(r.g, r.t)] for r in out)
    with pytest.raises(ValueError):
        O.with_group_prefix(df, ["g"], ["t"], sub_groups={"x": ["e"]})


def test_sequence_token_array_matches_normalised_path(spark):
    from corpusmill.functions.text import drop_first_token
    cases = ["<s> a  b </s>  </s>", "  <s>\tx=1;\n y </s>", "<s>", "", "one", "<s>foo bar\t\tbaz </s>"]
    df = spark.createDataFrame([(c,) for c in cases], "seq string")
    rows = df.select(Q.sequence_token_array("seq").alias("a"),
                     Q.seq_tokens(drop_first_token("seq")).alias("b")).collect()
    assert all(r.a == r.b for r in rows)


def test_vocab_lookup_salted_and_repeated(spark, monkeypatch):
    """Every way of the lookup gives the ids of a plain dictionary, documents without tokens included."""
    from corpusmill.operators import bags as B
    rng = random.Random(12)
    docs = [(i, [rng.choice("abcdefgh") * rng.choice([1, 1, 2]) for _ in range(rng.randrange(60))]) for i in range(120)] + [(500, [])]
    words = [a * n for a in "abcdefg" for n in (1, 2)]
    ids = {w: k for k, w in enumerate(words)}
    want = {i: [ids.get(t, -1) for t in ts] for i, ts in docs}
    df = spark.createDataFrame(docs, "id long, tokens array<string>")
    vocab = spark.createDataFrame(list(ids.items()), "token string, token_id long")
    monkeypatch.setattr(B, "HOT_TOKEN_ROWS", 9)
    for bound in (1000, 0):
        got = {r.id: r.token_ids for r in B.vocab_encode(df, vocab, broadcast_max_rows=bound).collect()}
        assert got == want
    pairs = B.token_positions(df).where("token IS NOT NULL")
    assert pairs.count() == sum(len(set(ts)) for _, ts in docs)


def test_tokens_are_encoded_where_they_are(spark):
    """Rows of one id, null tokens and null arrays are encoded, and no row is made for a token."""
    from corpusmill.operators import bags as B
    rows = [(1, ["a", None, "z"]), (1, ["b", "a"]), (2, None), (None, ["b"]), (3, ["é", "b", "b"])]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    vocab = spark.createDataFrame([("b", 10), ("a", 20), ("é", 30)], "token string, token_id long")
    out = B.vocab_encode(df, vocab)
    assert {r.id: r.token_ids for r in out.collect()} == {1: [10, 20, -1, 20, -1], 2: [], None: [10], 3: [30, 10, 10]}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "MapInArrow" in plan


def test_halo_copies_few_rows(spark):
    rows = [(1, 0, s, s, float(s)) for s in range(1, 1001)]
    log = spark.createDataFrame(rows, "run long, epoch int, step long, epoch_step long, loss double")
    for window, block in ((10, 100), (1, 7), (7, 7)):
        n = L.with_halo(log, window, block).count()
        assert n <= 1000 * (1 + window / block)
        out = {r.step: r.trailing_loss for r in L.trailing_mean(log, 1, window, block).collect()}
        assert all(out[s] == round(sum(range(max(1, s - window + 1), s + 1)) / min(s, window), 4) for s in range(1, 1001))


@pytest.mark.parametrize("kind", ["ladder", "random", "hub"])
def test_leader_rounds_follow_batches_not_depth(spark, kind, monkeypatch):
    """Deep graphs of 10,000 nodes are settled in few rounds of bounded batches; one node of more edges than a batch is too."""
    from corpusmill.operators import graph as G

    n, rng = 10_000, random.Random(3)
    if kind == "ladder":  # a node depends on the two before it on its rail and rung: 5,000 links deep
        edges = {(i, i + 2) for i in range(n - 2)} | {(i, i + 1) for i in range(0, n, 2)}
    elif kind == "random":
        edges = {tuple(sorted(rng.sample(range(n), 2))) for _ in range(100_000)}
    else:
        edges = {(i, 6_000) for i in range(6_000)} | {(i, i + 1) for i in range(6_000, 9_000)}
    earlier = {}
    for a, b in edges:
        earlier.setdefault(b, []).append(a)
    want = {}
    for v in sorted({v for e in edges for v in e}):
        want[v] = not any(want[u] for u in earlier.get(v, ()))
    rounds = []
    handed_on = G._with_status
    monkeypatch.setattr(G, "_with_status", lambda *a: rounds.append(1) or handed_on(*a))
    named = [(f"f{a:05d}", f"f{b:05d}") for a, b in edges]
    df = spark.createDataFrame(named, "src string, dst string")
    found = G.leader_status(df, local_edges=0, batch_edges=5_000).collect()
    assert len(found) == len(want) and {int(r.node[1:]): r.is_leader for r in found} == want
    assert len(rounds) <= 6


def test_both_directions_of_pairs_computed_once(spark):
    """The pairs are read once for both directions, repeated pairs, null ends and self loops included."""
    from corpusmill.operators import graph as G
    rows = [(1, 2), (2, 1), (1, 2), (3, 3), (2, 5), (None, 4), (6, None)]
    both = G.symmetrise(spark.createDataFrame(rows, "id1 long, id2 long"))
    assert sorted(map(tuple, both.collect())) == [(1, 2), (2, 1), (2, 5), (5, 2)]
    assert "Union" not in both._jdf.queryExecution().optimizedPlan().toString()
