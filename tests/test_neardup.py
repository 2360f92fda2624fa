import itertools
import os
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import dedup as D
from corpusmill.operators import neardup as N


def docs_df(spark, docs):
    return spark.createDataFrame([(i, toks) for i, toks in docs.items()], "id long, tokens array<string>")


def brute_pairs(docs, kt, t, minimum=20):
    keep = {i: Counter(v) for i, v in docs.items() if len(v) >= minimum}
    out = {}
    for a, b in itertools.combinations(sorted(keep), 2):
        ca, cb = keep[a], keep[b]
        inter = len(set(ca) & set(cb))
        key = inter / (len(ca) + len(cb) - inter)
        mn = sum(min(ca[x], cb[x]) for x in ca if x in cb)
        ms = mn / (sum(ca.values()) + sum(cb.values()) - mn)
        if key >= kt and ms >= t:
            out[(a, b)] = (ms, key)
    return out


def spark_pairs(spark, docs, kt=0.5, t=0.5, minimum=20):
    rows = N.near_duplicate_pairs(docs_df(spark, docs), key_threshold=kt, threshold=t, minimum=minimum).collect()
    return {(r.id1, r.id2): (r.jaccard, r.key_jaccard) for r in rows}


def random_corpus(seed, n_docs=40, vocab=30):
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(vocab)}" for _ in range(rng.randrange(15, 60))] for _ in range(8)]
    docs = {}
    for i in range(n_docs):
        src = list(rng.choice(base))
        for _ in range(rng.randrange(0, 12)):
            op = rng.random()
            if op < 0.4 and src:
                src.pop(rng.randrange(len(src)))
            elif op < 0.8:
                src.insert(rng.randrange(len(src) + 1), f"w{rng.randrange(vocab)}")
            else:
                src.append(f"x{rng.randrange(5)}")
        if rng.random() < 0.15 and docs:
            src = list(docs[rng.choice(list(docs))])  # exact copy
            rng.shuffle(src)
        docs[i] = src
    return docs


@pytest.mark.parametrize("seed,kt,t", [(1, 0.5, 0.5), (2, 0.5, 0.5), (3, 0.7, 0.4), (4, 0.3, 0.8), (5, 0.0, 0.6),
                                       (6, 1.0, 1.0)])
def test_matches_brute_force(spark, seed, kt, t):
    docs = random_corpus(seed)
    expected = brute_pairs(docs, kt, t)
    got = spark_pairs(spark, docs, kt, t)
    assert set(got) == set(expected)
    for k, (ms, key) in expected.items():
        assert got[k][0] == pytest.approx(ms) and got[k][1] == pytest.approx(key)


def test_min_tokens_19_dropped_20_kept(spark):
    a = ["t"] * 19
    b = ["t"] * 20
    c = ["t"] * 20
    got = spark_pairs(spark, {1: a, 2: b, 3: c})
    assert set(got) == {(2, 3)}


def test_exact_half_passes(spark):
    a = [f"t{i}" for i in range(20)]
    b = [f"t{i}" for i in range(10)] + [f"u{i}" for i in range(10)]
    assert spark_pairs(spark, {1: a, 2: b}) == {}  # 10 of 30 keys
    c = a + [f"v{i}" for i in range(20)]  # 20 of 40 keys and tokens: exactly 0.5
    assert spark_pairs(spark, {1: a, 3: c}) == {(1, 3): (0.5, 0.5)}


def test_identical_bags_different_order(spark):
    a = [f"t{i % 7}" for i in range(30)]
    b = list(reversed(a))
    assert spark_pairs(spark, {1: a, 2: b}) == {(1, 2): (1.0, 1.0)}


def test_key_vs_multiset(spark):
    a = ["a"] * 10 + ["b"] * 10
    b = ["a"] * 30 + ["b"] * 10
    got = spark_pairs(spark, {1: a, 2: b}, kt=0.5, t=0.0)
    assert got[(1, 2)] == (0.5, 1.0)


def chain_docs():
    base = [f"t{i}" for i in range(40)]
    a = base
    b = base[10:] + [f"u{i}" for i in range(10)]        # ~ a
    c = base[20:] + [f"u{i}" for i in range(20)]        # ~ b, not ~ a
    return {1: a, 2: b, 3: c}


def test_chain_closure_vs_leader(spark):
    docs = chain_docs()
    assert set(spark_pairs(spark, docs)) == {(1, 2), (2, 3)}
    nd = N.near_duplicates(docs_df(spark, docs))
    comp = D.clone_clusters(nd)
    removed = D.cluster_losers(comp).collect()
    assert sorted(r.id for r in removed) == [2, 3]
    leader = D.leader_assignment(nd).collect()
    assert [(r.leader, r.duplicate) for r in leader] == [(1, 2)]


def test_copy_groups_are_stars_in_edges(spark):
    a = [f"t{i}" for i in range(25)]
    docs = {i: list(a) for i in range(1, 6)}
    nd = N.near_duplicates(docs_df(spark, docs))
    edges = sorted(tuple(r) for r in nd.edges().collect())
    assert edges == [(1, 2), (1, 3), (1, 4), (1, 5)]
    assert nd.all_pairs().count() == 10
    summary = D.cluster_summary(D.clone_clusters(nd)).first()
    assert summary.clusters == 1 and summary.cloned_files == 5


def test_both_thresholds_zero_refused(spark):
    with pytest.raises(ValueError):
        N.near_duplicate_pairs(docs_df(spark, {1: ["a"] * 20}), key_threshold=0.0, threshold=0.0).collect()


def test_no_cross_join_in_plan(spark):
    nd = N.near_duplicates(docs_df(spark, random_corpus(7)))
    plan = nd.reps._jdf.queryExecution().toString()
    cands = N.candidate_pairs(nd.reps, 0.5, 0.5)
    text = cands._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert plan


def test_median_compat_and_true(spark):
    comp = spark.createDataFrame(
        [(n, c) for c, size in [(100, 2), (200, 2), (300, 3), (400, 5)] for n in range(c, c + size)],
        "node long, cluster_id long")
    s = D.cluster_summary(comp).first()
    assert s.median_factor == 2.5 and s.median_compat == 4.0 and s.clusters == 4


def test_key_and_multiset_jaccard_functions(spark):
    df = spark.createDataFrame([(["a", "b"], ["a", "b", "c"])], "a array<string>, b array<string>")
    assert df.select(N.key_jaccard("a", "b")).first()[0] == pytest.approx(2 / 3)
    m = spark.createDataFrame([({"a": 1, "b": 1}, {"a": 3, "b": 1})], "x map<string,long>, y map<string,long>")
    assert m.select(N.multiset_jaccard(F.col("x"), F.col("y"))).first()[0] == 0.5


def test_hot_prefix_keys_are_salted(spark, monkeypatch):
    monkeypatch.setattr(N, "HOT_KEY_ROWS", 3)
    orig = N._salt_hot_keys
    monkeypatch.setattr(N, "_salt_hot_keys", lambda l, s, k, hot_rows=3: orig(l, s, k, hot_rows))
    docs = random_corpus(11, n_docs=60, vocab=12)
    assert set(spark_pairs(spark, docs)) == set(brute_pairs(docs, 0.5, 0.5))
    sides = N.candidate_pairs(N.near_duplicates(docs_df(spark, docs)).reps, 0.5, 0.5)
    assert "_salt" in sides._jdf.queryExecution().optimizedPlan().toString()


def test_hot_copy_group_salting(spark, monkeypatch):
    monkeypatch.setattr(N, "HOT_KEY_ROWS", 2)
    monkeypatch.setattr(D, "hot_copy_groups", lambda reps, key="rep", hot_rows=2: N.hot_copy_groups(reps, key, hot_rows))
    orig = N.hot_copy_groups
    monkeypatch.setattr(N, "hot_copy_groups", lambda reps, key="rep", hot_rows=2: orig(reps, key, hot_rows))
    a = [f"t{i}" for i in range(30)]
    b = a[:25] + ["u"] * 5
    docs = {i: list(a) for i in range(1, 8)}
    docs.update({i: list(b) for i in range(10, 13)})
    docs[20] = [f"z{i}" for i in range(30)]
    nd = N.near_duplicates(docs_df(spark, docs))
    assert sorted(tuple(r) for r in nd.members.collect()) == sorted(
        [(i, 1) for i in range(1, 8)] + [(i, 10) for i in range(10, 13)] + [(20, 20)])
    comp = sorted(tuple(r) for r in D.clone_clusters(nd).collect())
    assert comp == sorted([(i, 1) for i in list(range(1, 8)) + [10, 11, 12]])
    leader = sorted(tuple(r) for r in D.leader_assignment(nd).collect())
    assert leader == sorted([(1, i) for i in list(range(2, 8)) + [10, 11, 12]])


def test_component_label_salting(spark, monkeypatch):
    from corpusmill.operators import graph as G
    monkeypatch.setattr(G, "HOT_LABEL_ROWS", 2)
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 30)] + [(100, 101), (101, 102)],
                                  "src long, dst long")
    comp = {r.node: r.cluster_id for r in G.connected_components(edges).collect()}
    assert all(comp[i] == 1 for i in range(1, 31))
    assert comp[101] == comp[102] == 100


def test_pairs_independent_of_partitioning(spark):
    docs = random_corpus(13, n_docs=50)
    df = docs_df(spark, docs)
    a = {tuple(r) for r in N.near_duplicate_pairs(df.repartition(1)).collect()}
    b = {tuple(r) for r in N.near_duplicate_pairs(df.repartition(7, "id")).collect()}
    assert a == b and a


def test_repeated_ids_never_merge(spark):
    from corpusmill.operators import neardup as N

    a, b = [f"a{i}" for i in range(30)], [f"b{i}" for i in range(30)]
    docs = spark.createDataFrame([("x", 1, a), ("x", 2, b), ("y", 1, a), ("z", 1, b)], "id string, ver int, tokens array<string>")
    with pytest.raises(ValueError, match="more than one document"):
        N.near_duplicates(docs)
    pairs = N.near_duplicates(docs, on_duplicate="last", order_col="ver").all_pairs().collect()
    assert [(r.id1, r.id2) for r in pairs] == [("x", "z")]


def test_hot_tokens_salted_alike(spark, monkeypatch):
    from corpusmill.operators import neardup as N

    rng = random.Random(8)
    docs = [(i, [f"t{min(rng.randrange(30), rng.randrange(30))}" for _ in range(25)]) for i in range(60)]
    docs += [(100 + i, list(docs[i % 3][1])) for i in range(30)]  # copies
    df = spark.createDataFrame(docs, "id long, tokens array<string>")
    want = sorted((r.id1, r.id2) for r in N.near_duplicate_pairs(df).collect())
    assert want == sorted(brute_pairs(dict(docs), .5, .5))
    monkeypatch.setattr(N, "HOT_KEY_ROWS", 5)
    assert want and sorted((r.id1, r.id2) for r in N.near_duplicate_pairs(df).collect()) == want


def test_pairs_by_project_are_counted_not_built(spark, monkeypatch):
    """Counts by project equal those of all pairs, copies and null projects included, without building a pair."""
    rng = random.Random(21)
    bags = [[rng.choice("abcdefghijkl") for _ in range(24)] for _ in range(12)]
    rows = [(i, rng.choice(bags) + ["x"] * rng.choice([0, 0, 3]), rng.choice(["p", "q", None])) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, tokens array<string>, project string")
    found = N.near_duplicates(df)
    project = {i: p for i, _, p in rows}
    want = {}
    for r in found.all_pairs().collect():
        scope = "within" if project[r.id1] is not None and project[r.id1] == project[r.id2] else "across"
        want[scope] = want.get(scope, 0) + 1
    monkeypatch.setattr(N.NearDuplicates, "all_pairs", None)
    assert want and {r.scope: r.pairs for r in N.pairs_by_project(found, df).collect()} == want


@pytest.mark.parametrize("kt,t,broadcast_bytes", [(0.5, 0.5, 1 << 26), (0.5, 0.5, 0), (0.0, 0.6, 1 << 26)])
def test_parity_bitmaps_bound_the_difference(spark, kt, t, broadcast_bytes):
    """No bitmap shows more differences than the records have; the filter keeps every similar pair and drops others."""
    rng = random.Random(5)
    docs = random_corpus(17) | {100 + i: [f"w{rng.randrange(400)}" for _ in range(60)] for i in range(20)}
    multiset = kt <= 0.0
    nd = N.near_duplicates(docs_df(spark, docs), key_threshold=kt, threshold=t)
    bits = {r.id: (r.s, r[2:]) for r in N.parity_sketches(nd.reps, multiset, 4).collect()}
    bags = {i: Counter(docs[i]) if multiset else Counter(set(docs[i])) for i in bits}
    for a, b in itertools.combinations(bits, 2):
        assert bits[a][0] == bags[a].total()
        true = ((bags[a] - bags[b]) + (bags[b] - bags[a])).total()
        seen = sum(bin((u ^ v) & (1 << 64) - 1).count("1") for u, v in zip(bits[a][1], bits[b][1]))
        assert seen <= true and (seen - true) % 2 == 0
    every = spark.createDataFrame([(a, b) for a, b in itertools.combinations(sorted(bits), 2)], "x long, y long")
    kept = {tuple(r) for r in N.difference_filter(every, nd.reps, kt, t, broadcast_bytes=broadcast_bytes).collect()}
    similar = {(r.id1, r.id2) for r in nd.rep_pairs.collect()}
    shuffled = N.near_duplicates(docs_df(spark, docs), key_threshold=kt, threshold=t, broadcast_bytes=0).rep_pairs
    assert "bit_count" in shuffled._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.id1, r.id2) for r in shuffled.collect()} == similar
    assert similar and similar <= kept and len(kept) < every.count() / 2


@pytest.mark.parametrize("kt,t", [(0.5, 0.5), (0.0, 0.6)])
def test_pairs_of_blocks_give_all_pairs(spark, monkeypatch, kt, t):
    """Several blocks give the brute-force pairs, each candidate once, and shuffle no row for a pair."""
    from corpusmill.operators import blocks as K
    monkeypatch.setattr(N, "PREFIX_JOIN_BYTES", 0)
    monkeypatch.setattr(K, "BLOCK_ELEMENTS", 400)
    docs = random_corpus(23, n_docs=60) | {100 + i: [f"w{i}"] * 25 for i in range(4)}
    expected = brute_pairs(docs, kt, t)
    nd = N.near_duplicates(docs_df(spark, docs), key_threshold=kt, threshold=t)
    assert expected and {(r.id1, r.id2) for r in nd.all_pairs().collect()} == set(expected)
    cands = N.block_candidates(nd.reps, kt, t)
    plan = cands._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan
    found = [frozenset(r) for r in cands.collect()]
    assert len(found) == len(set(found))


def test_tokens_of_one_hash_get_another_seed(spark, monkeypatch):
    """Two tokens that share a hash under the first seed stay two tokens."""
    orig = N.token_hash
    monkeypatch.setattr(N, "token_hash", lambda token, seed: orig(F.substring(token, 1, 1) if seed == 0 else token, seed))
    docs = {1: [f"t{i}" for i in range(20)], 2: [f"t{i}" for i in range(20, 40)]}
    assert {r.id: r.k for r in N.signatures(docs_df(spark, docs)).collect()} == {1: 20, 2: 20}
    assert spark_pairs(spark, docs) == {}


def test_rare_and_ranked_tokens_together(spark, monkeypatch):
    monkeypatch.setattr(N, "RANKED_TOKENS", 5)
    monkeypatch.setattr(N, "PREFIX_JOIN_BYTES", 0)
    docs = random_corpus(29, n_docs=50)
    assert set(spark_pairs(spark, docs)) == set(brute_pairs(docs, 0.5, 0.5))


@pytest.mark.parametrize("kt,t", [(0.5, 0.5), (0.0, 0.6)])
def test_blocks_hold_whole_bags_and_verify_pairs_in_place(spark, monkeypatch, kt, t):
    """Pairs of blocks come with exact similarities, counts beyond a byte included, and no bag is shuffled for a candidate."""
    from corpusmill.operators import blocks as K
    monkeypatch.setattr(N, "RANKED_TOKENS", 5)
    monkeypatch.setattr(N, "PREFIX_JOIN_BYTES", 0)
    monkeypatch.setattr(K, "BLOCK_ELEMENTS", 900)
    monkeypatch.setattr(N, "verify_pairs", None)
    docs = random_corpus(31, n_docs=50) | {200 + i: ["a"] * (250 + 10 * i) + ["b", "c"] * 30 for i in range(3)}
    expected = brute_pairs(docs, kt, t)
    rows = N.near_duplicates(docs_df(spark, docs), key_threshold=kt, threshold=t).all_pairs().collect()
    assert (200, 202) in expected and {(r.id1, r.id2): (r.jaccard, r.key_jaccard) for r in rows} == expected


def test_bags_of_blocks_take_three_bytes_a_frequent_token():
    """A bag goes into a block as steps of token ids and counts, and comes out whole: rare ids, high ranks and large counts too."""
    import numpy as np
    import pyarrow as pa

    from corpusmill.operators import blocks as K
    rng = np.random.default_rng(3)
    bags = [np.sort(K.HOT_TID + rng.choice(200_000, 300, replace=False)) for _ in range(20)]
    odd = [np.array([0, 1, 127, 128, K.HOT_TID - 1, K.HOT_TID, K.HOT_TID + 199_999]), np.array([K.HOT_TID - 1]), np.sort(rng.integers(0, K.HOT_TID, 50))]
    cnts = [np.ones(300, np.int64)] * 20 + [np.array([1, 127, 128, 255, 256, 1 << 40, 7]), np.array([300]), np.full(50, 2)]

    def packed(tids, cnts):
        lists = lambda values: pa.array([v.tolist() for v in values], pa.list_(pa.int64()))
        ids = pa.array(range(len(tids)), pa.int64())
        return K.compact_bags(pa.RecordBatch.from_arrays([ids, ids, lists(tids), lists(cnts)], names=["id", "s", "tids", "cnts"]))

    size = sum(len(v.as_py()) for c in K.PARTS for v in packed(bags, cnts[:20]).column(c))
    assert size <= 3.2 * 20 * 300
    rows = packed(bags + odd, cnts)
    block = K.Block(rows.column("k").to_numpy().astype("<i4").tobytes(), *[b"".join(rows.column(c).to_pylist()) for c in K.PARTS], 0.5, False)
    assert (block.tids == np.concatenate(bags + odd)).all() and (block.cnts == np.concatenate(cnts)).all()


def test_bags_are_written_small(spark):
    """The bags, the largest of the written tables, are compressed by zstd."""
    written = [f for f in N.signatures(docs_df(spark, random_corpus(41))).inputFiles() if f.endswith(".parquet")]
    assert written and all(f.endswith(".zstd.parquet") for f in written)


def shuffles_on_disk(spark) -> set[str]:
    names = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",").split(",")
    return {f.rpartition("/")[2].split("_")[1] for f in names if f.rpartition("/")[2].startswith("shuffle_")}


def left_on_disk(spark, before: set[str], seconds: float = 10) -> set[str]:
    """Shuffles not in ``before`` whose files stay; they are deleted in the background."""
    until = time.time() + seconds
    while (left := shuffles_on_disk(spark) - before) and time.time() < until:
        time.sleep(0.1)
    return left


def test_a_written_table_leaves_no_shuffle_files(spark):
    from corpusmill.session import SHUFFLE_CLEANUP, reliable_checkpoint
    setting, before = spark.conf.get(SHUFFLE_CLEANUP), shuffles_on_disk(spark)
    counts = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    table = reliable_checkpoint(counts.repartitionByRange(4, "k"))
    assert not left_on_disk(spark, before)
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting
    assert table.count() == 100 and table.agg(F.sum("count")).first()[0] == 10_000
    assert sorted(counts.collect()) == sorted(table.collect())  # the same frame again


def test_vocabulary_and_blocks_go_when_they_are_used_up(spark, monkeypatch):
    """What stays on disk are the bags, the copies and the pairs, without a shuffle file of the vocabulary or the blocks."""
    from corpusmill.session import checkpoint_dir
    monkeypatch.setattr(N, "PREFIX_JOIN_BYTES", 0)
    docs = random_corpus(31, n_docs=50)
    df = docs_df(spark, docs)
    folder = checkpoint_dir(spark).removeprefix("file:")
    tables = lambda: {t for t in os.listdir(folder) if t.startswith("table-")}
    seen = tables()
    before = shuffles_on_disk(spark)
    N.token_ranks(df)
    assert not left_on_disk(spark, before) and tables() == seen
    nd = N.near_duplicates(df)
    assert len(tables() - seen) == 3
    assert {(r.id1, r.id2) for r in nd.all_pairs().collect()} == set(brute_pairs(docs, 0.5, 0.5))
    nd.close()
    assert len(tables() - seen) == 1


def test_tokens_are_computed_once_for_the_bags(spark, monkeypatch):
    """Vocabulary and bags come from one pass over the texts, which makes no match object for a token."""
    from corpusmill.operators.tokenize import tokenize_regex
    texts = spark.createDataFrame([(i, f"alpha_{i} beta 12ab = {i % 3};\n" * 8) for i in range(30)] + [(30, None), (31, "")], "id long, content string")
    seen = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = tokenize_regex(texts.repartition(3).mapInArrow(counting, "id long, content string")).drop("content")
    assert "regexp_extract_all" not in df._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(N, "COUNTED_ENTRIES", 40)
    bags = {r.id: (r.n, r.k) for r in N.signatures(df).collect()}
    assert bags == {i: (7 * 8, len({f"alpha_{i}", "beta", "12", "ab", "=", str(i % 3), ";"})) for i in range(30)}
    assert seen.value == 32


@pytest.mark.parametrize("kt,t", [(0.5, 0.5), (0.3, 0.8), (0.8, 0.2), (1.0, 1.0), (0.0, 0.6)])
def test_prefixes_that_share_enough_lose_no_pair(spark, kt, t):
    """Blocks of every size give the brute-force pairs and similarities from prefixes that share enough elements."""
    import pyarrow as pa

    from corpusmill.operators import blocks as K
    rng = random.Random(13)
    bags = []
    for _ in range(25):
        base = [rng.randrange(1, 300) for _ in range(rng.randrange(20, 120))]
        bags += [Counter(base), Counter(base[:-rng.randrange(1, 12)] + [rng.randrange(300) for _ in range(rng.randrange(30))])]
    multiset = kt <= 0.0
    bags.sort(key=lambda b: b.total() if multiset else len(b))

    def block(some):
        lists = lambda values: pa.array(values, pa.list_(pa.int64()))
        ids = pa.array(range(len(some)), pa.int64())
        rows = K.compact_bags(pa.RecordBatch.from_arrays(
            [ids, ids, lists([sorted(b) for b in some]), lists([[b[x] for x in sorted(b)] for b in some])], names=["id", "s", "tids", "cnts"]))
        return K.Block(rows.column("k").to_numpy().astype("<i4").tobytes(), *[b"".join(rows.column(c).to_pylist()) for c in K.PARTS],
                       t if multiset else kt, multiset)

    want = {}
    for a, b in itertools.combinations(range(len(bags)), 2):
        met, every = len(bags[a].keys() & bags[b].keys()), len(bags[a].keys() | bags[b].keys())
        least = (bags[a] & bags[b]).total()
        if met / every >= kt and least / (bags[a] | bags[b]).total() >= t:
            want[b, a] = (least / (bags[a] | bags[b]).total(), met / every)
    for cut in (50, 20, 7):
        blocks = [(at, block(bags[at:at + cut])) for at in range(0, 50, cut)]
        got = {}
        for (i, small), (j, big) in itertools.combinations_with_replacement(blocks, 2):
            for x, y, sim, key_sim in K.similar_bags(small, big, i == j, kt, t):
                got |= {(int(a) + j, int(b) + i): (s, k) for a, b, s, k in zip(x, y, sim, key_sim)}
        assert got == want
    assert want or kt == 1.0


def test_a_block_ends_where_sizes_grow(spark, monkeypatch):
    """Bags of a block are of similar size, so that its prefixes stay short."""
    from corpusmill.operators import blocks as K
    docs = {i: [f"t{i}_{j}" for j in range(20 + 4 * i)] for i in range(20)}
    reps, _ = N.collapse_copies(N.signatures(docs_df(spark, docs)))
    rows = K.written_blocks(reps, 0.5, 0.5, K.block_size(10_000)).collect()
    assert sum(len(r.ids) for r in rows) == 20 and all(r.hi <= r.lo * K.SIZE_RATIO for r in rows)
    assert K.block_size(10_000) == K.LEAST_ELEMENTS and K.block_size(1 << 40) == K.BLOCK_ELEMENTS
